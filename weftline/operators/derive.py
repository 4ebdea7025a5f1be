"""Records from rows: prompts, labels, facts and lanes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def render_prompt(system: Column, history: Column, user: Column) -> Column:
    """The system message, the turns before, and the user's."""
    return F.concat(F.array(message("system", system)), history, F.array(message("user", user)))


def prompt_text(messages: Column) -> Column:
    """Messages as lines ``role: content``."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def behaviour_label(**fields: Column) -> Column:
    """Compact JSON of the fields in their order."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def unpivot_columns(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, name, value): a row for each column that is neither null nor 0."""
    return df.unpivot([key], columns, "name", "value").where("value is not null and value <> 0")


def profile_lines(df: DataFrame, key: str, fields: list[tuple[str, str]]) -> DataFrame:
    """(key, field_no, item_no, line): labelled fields in order, comma lists one by one."""
    made = F.array(*[F.struct(F.lit(i).alias("field_no"), F.lit(label).alias("label"), F.col(c).cast("string").alias("v")) for i, (label, c) in enumerate(fields)])
    each = df.select(key, F.explode(made).alias("f")).where("f.v is not null and f.v <> ''")
    items = each.select(key, "f.field_no", "f.label", F.posexplode(F.split("f.v", r"\s*,\s*")).alias("item_no", "item")).where("item <> ''")
    return items.select(key, "field_no", "item_no", F.concat("label", F.lit(": "), "item").alias("line"))


def other_owner_facts(facts: DataFrame, owner: str, group: str, fact: str) -> DataFrame:
    """(owner, other, fact): the facts of every other owner in the same group: an equi-join on the group, less the owner's own."""
    a = facts.select(F.col(owner).alias("owner"), F.col(group).alias("__g"))
    b = facts.select(F.col(owner).alias("other"), F.col(group).alias("__h"), F.col(fact).alias("fact"))
    return a.join(b, F.col("__g") == F.col("__h")).where("owner <> other").select("owner", "other", "fact")


def composed_memory(core: Column, target: Column, level_line: Column) -> Column:
    """Distinct core lines in their order without the target line, and the line of the level."""
    return F.concat(F.array_distinct(F.filter(core, lambda x: x != target)), F.array(level_line))


def clamped_level(c: Column, low: int = 1, high: int = 40) -> Column:
    """Null and 0 are the lowest level; null beyond the range, for the caller to reject."""
    v = F.coalesce(F.nullif(c, F.lit(0)), F.lit(low))
    return F.when(v.between(low, high), v)


def context_item(kind: Column, speaker: Column, text: Column) -> Column:
    """Narration in brackets, gifts labelled, others with their name."""
    return F.when(kind == "narration", F.concat(F.lit("("), text, F.lit(")"))).when(kind == "gift", F.concat(F.lit("gift: "), text)).otherwise(F.concat(speaker, F.lit(": "), text))
