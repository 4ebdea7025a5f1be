"""Manifests, votes, profiles and funnels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import sentences, speech_level


def manifest(df: DataFrame, groupings: list[str]) -> DataFrame:
    """(grouping, value, n): counts by each of several columns, in one pass."""
    sets = df.select(*[F.col(c).cast("string").alias(c) for c in groupings]).groupingSets([[c] for c in groupings], *groupings)
    out = sets.agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    width = len(groupings)
    name = reduce(lambda rest, i: F.when(F.col("g") == (2**width - 1 - 2 ** (width - 1 - i)), groupings[i]).otherwise(rest), range(width), F.lit(None))
    return out.select(name.alias("grouping"), F.coalesce(*groupings).alias("value"), "n")


def dominant(df: DataFrame, owner: str, value: str, share: float = 0.5) -> DataFrame:
    """(owner, value, n, total): the most frequent value if it has ``share`` of all rows, nulls and empties among these; ties go to the smaller. Null is an owner."""
    counts = df.groupBy(owner, value).agg(F.count("*").alias("n"))
    named = F.coalesce(F.col(value).cast("string"), F.lit("")) != ""
    best = F.min(F.when(named, F.struct((-F.col("n")).alias("less"), F.col(value).alias("v"))))
    out = counts.groupBy(owner).agg(F.sum("n").alias("total"), best.alias("b")).where("b is not null")
    return out.select(owner, F.col("b.v").alias(value), (-F.col("b.less")).alias("n"), "total").where(F.col("n") >= F.lit(share) * F.col("total"))


LEVELS = ("casual", "polite", "formal", "military", "archaic")


def _level_counts(df: DataFrame, keys: list[str], text: str, level: Column | None) -> DataFrame:
    """(keys, total, and a count for each register) over the sentences of texts."""
    each = df.select(*keys, F.explode(sentences(F.col(text))).alias("s"))
    each = each.select(*keys, (speech_level(F.col("s")) if level is None else level).alias("level"))
    return each.groupBy(*keys).agg(F.count("*").alias("total"), *[F.count_if(F.col("level") == n).alias(n) for n in LEVELS])


def _with_level(out: DataFrame, least: float, honorific: float) -> DataFrame:
    strong = F.array_compact(F.array(*[F.when(F.col(n) / F.col("total") >= least, F.struct(F.col(n).alias("n"), F.lit(-i).alias("i"), F.lit(n).alias("name"))) for i, n in enumerate(["military", "archaic", "formal"])]))
    picked = F.when(F.size(strong) > 0, F.array_max(strong)["name"]).when((F.col("total") - F.col("casual") - F.col("archaic")) / F.col("total") >= honorific, "polite").otherwise("casual")
    return out.withColumn("level", picked)


def level_profile(df: DataFrame, owner: str, text: str, least: float = 0.2, honorific: float = 0.3, level: Column | None = None) -> DataFrame:
    """(owner, total, casual, polite, formal, military, archaic, level) over the sentences of an owner's texts."""
    return _with_level(_level_counts(df, [owner], text, level), least, honorific)


def suffix_share(df: DataFrame, text: str, suffix: str, share: float = 0.5) -> DataFrame:
    """(word, suffixed, bare): words that stand with the suffix at least ``share`` times as often as without."""
    words = df.select(F.explode(F.split(F.lower(text), r"[^a-z]+")).alias("w")).where("w <> ''").groupBy("w").agg(F.count("*").alias("n"))
    ends = words.where(F.col("w").endswith(suffix) & (F.length("w") > len(suffix))).select(F.expr(f"substring(w, 1, length(w) - {len(suffix)})").alias("word"), F.col("n").alias("suffixed"))
    out = ends.join(words.select(F.col("w").alias("word"), F.col("n").alias("bare")), "word")
    return out.where(F.col("suffixed") >= F.lit(share) * F.col("bare"))


def role_vote(df: DataFrame, owner: str, yes: Column, no: Column) -> DataFrame:
    """(owner, vote): yes or no by majority of the evidence for each, unknown if even."""
    out = df.groupBy(owner).agg(F.count_if(yes).alias("y"), F.count_if(no).alias("n"))
    return out.select(owner, F.when(F.col("y") > F.col("n"), "yes").when(F.col("n") > F.col("y"), "no").otherwise("unknown").alias("vote"))


def moves(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(move, n): how many rows went from each value to each other."""
    b = before.select(key, F.col(value).alias("__b"))
    out = after.select(key, F.col(value).alias("__a")).join(b, key)
    return out.groupBy(F.concat("__b", F.lit("->"), "__a").alias("move")).agg(F.count("*").alias("n"))


def dataset_digest(df: DataFrame) -> DataFrame:
    """(n, digest): the rows, and the sum of their 60-bit hashes modulo 2^61 - 1: the same in any order of rows, with partial sums."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns]
    head = F.conv(F.substring(F.sha2(F.concat_ws("\u001f", *fields), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), (F.coalesce(F.sum(head), F.lit(0)) % F.lit(2**61 - 1)).cast("long").alias("digest"))


def funnel(steps: list[tuple[str, DataFrame]]) -> DataFrame:
    """(step, stage, n): the rows left after each stage."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "n") for i, (name, df) in enumerate(steps)]
    return reduce(DataFrame.unionByName, parts)


def style_profile(df: DataFrame, owner: str, text: str, addresses: list[str], first_persons: dict[str, str], second: str, level: Column | None = None, least_addressed: int = 5, address: str = "", plain: str = "", polite: str = "") -> DataFrame:
    """``level_profile`` with how an owner speaks of itself and to others: address, first_person, uses_second_person, addressed.

    Levels are those of sentences in texts with an address where there are ``least_addressed`` of them
    (``addressed``), else of all. Addresses are counted in their order, each in what the ones before have
    left; first persons by patterns. Of equal counts the earlier in its list wins. ``address``,
    ``plain`` and ``polite`` stand where none occurs; registers other than casual and archaic take no ``plain`` first person.
    """
    any_ = F.lit(False)
    for a in addresses:
        any_ = any_ | F.contains(F.col(text), F.lit(a))
    marked = df.where(F.col(owner).isNotNull()).select(owner, text, F.coalesce(any_, F.lit(False)).alias("__addressed"))
    counts, rest = [], F.coalesce(F.col(text), F.lit(""))
    for i, a in enumerate(addresses):
        without = F.replace(rest, F.lit(a), F.lit(""))
        counts.append(F.sum((F.length(rest) - F.length(without)) / len(a)).cast("long").alias(f"__a{i}"))
        rest = F.replace(rest, F.lit(a), F.lit(" "))
    found = lambda p: F.size(F.split(F.coalesce(F.col(text), F.lit("")), p)) - 1  # noqa: E731  the number of matches
    firsts = [F.sum(found(p)).alias(f"__f{i}") for i, p in enumerate(first_persons.values())]
    said = marked.groupBy(F.col(owner).alias("__o")).agg(*counts, *firsts, F.sum(found(second)).alias("__second"))
    names = ("total", *LEVELS)
    each = _level_counts(marked, [owner, "__addressed"], text, level).groupBy(owner).agg(*[F.struct(F.sum(n).alias("every"), F.coalesce(F.sum(F.when(F.col("__addressed"), F.col(n))), F.lit(0)).alias("some")).alias(n) for n in names])
    few = F.col("total.some") >= least_addressed
    levels = _with_level(each.select(owner, few.alias("addressed"), *[F.when(few, F.col(f"{n}.some")).otherwise(F.col(f"{n}.every")).alias(n) for n in names]), 0.2, 0.3)
    out = levels.join(said, F.col(owner) == F.col("__o"))

    def most(names: list[str], column: str) -> Column:
        """(count, name) of the most frequent; null if none occurs."""
        each = [F.when(F.col(f"{column}{i}") > 0, F.struct(F.col(f"{column}{i}").alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("name"))) for i, name in enumerate(names)]
        return F.array_max(F.array_compact(F.array(*each))) if each else F.lit(None).cast("struct<n:bigint,i:int,name:string>")

    terms = list(first_persons)
    formal = F.array_max(F.array_compact(F.array(*[F.when(F.col(f"__f{i}") > 0, F.struct(F.col(f"__f{i}").alias("n"), F.lit(-i).alias("i"), F.lit(t).alias("name"))) for i, t in enumerate(terms) if t != plain]))) if any(t != plain for t in terms) else F.lit(None).cast("struct<n:bigint,i:int,name:string>")
    best = most(addresses, "__a")
    familiar = F.col("level").isin("casual", "archaic")
    person = F.when(familiar, F.coalesce(most(terms, "__f")["name"], F.lit(plain))).otherwise(F.coalesce(formal["name"], F.lit(polite)))
    return out.select(*levels.columns, F.coalesce(best["name"], F.lit(address)).alias("address"), person.alias("first_person"), (F.col("__second") > F.coalesce(best["n"], F.lit(0))).alias("uses_second_person"))
