"""Ordered decision lists, gates and audits. Lexicons are arguments: data, not code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_of(c: Column, words: list[str]) -> Column:
    """Whether any of the words occurs in the text."""
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words], F.lit(False))


def decide(rules: list[tuple[str, Column]], default: str) -> Column:
    """The label of the first rule that holds; a null condition does not."""
    out = F.lit(default)
    for label, cond in reversed(rules):
        out = F.when(cond, F.lit(label)).otherwise(out)
    return out


def speaker_role(speaker: Column, persona: str, users: list[str]) -> Column:
    return F.when(speaker == persona, "assistant").when(speaker.isin(*users), "user").otherwise("other")


def highest_priority(label: Column, order: list[str]) -> Column:
    """An aggregate: the label of the group that comes first in ``order``, else the last of them."""
    place = F.array_position(F.array(*map(F.lit, order)), label)
    best = F.min(F.when(place > 0, place))
    return F.element_at(F.array(*map(F.lit, order)), F.coalesce(best, F.lit(len(order))).cast("int"))


def stated_age_under(c: Column, age: int, pattern: str = r"(\d{1,3})\s*(?:years old|살|세)") -> Column:
    found = F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(1)), lambda x: x.cast("int"))
    return F.exists(found, lambda x: x < age)


def problems(checks: dict[str, Column]) -> Column:
    """The names of all checks that hold, in their order; not only the first."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()]))


def audit(df: DataFrame, checks: dict[str, Column], keys: list[str]) -> DataFrame:
    """One row a check and row that it holds for: keys, check, matched. A check gives the matched text or null."""
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), c.alias("matched")) for n, c in checks.items()])
    out = df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.check", "p.matched")
    return out.where("matched is not null and matched <> ''")


def guarded(c: Column, pattern: str, needs: str | None = None, start: str = "") -> Column:
    """The first match of a pattern, which is only tried where the text ``needs`` stands, and only behind ``start``; empty without one."""
    found = F.regexp_extract(c, start + pattern, 0)
    return found if needs is None else F.when(F.contains(c, F.lit(needs)), found).otherwise("")


def samples(found: DataFrame, per: str, order: list, most: int = 5) -> DataFrame:
    """The first ``most`` rows of each check in a total order."""
    w = Window.partitionBy(per).orderBy(*order)
    return found.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most)


def gate(df: DataFrame, reason: Column, detail: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, excluded): rows without a reason, and (keys, reason, detail, preview) of the others."""
    held = df.withColumn("__r", reason)
    out = held.where("__r is not null").select(*keys, F.col("__r").alias("reason"), F.lit(detail).alias("detail"), F.substring("text", 1, 80).alias("preview"))
    return held.where("__r is null").drop("__r"), out
