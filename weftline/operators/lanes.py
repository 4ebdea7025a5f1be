"""Lanes: readers whose records need a situation, found by key in several sources, or are skipped with a reason.

All lanes are one table with the lookups of each record in order. One shuffle by (source, key) brings
the lookups of every lane and the rows of every source together; the first lookup that resolves gives
the situation, and each one before it the reason of its miss.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import materialize

#: Reasons of a miss: the record has no key, the source has no such row, the row has no value.
NO_KEY, NO_ROW, NO_VALUE = "no_key", "no_row", "no_value"
UNVERIFIED = "unverified_trigger"
_MISS = "array<struct<source:string,reason:string>>"


@dataclass(frozen=True)
class Lookup:
    """A key in a source; what it finds stands for {value} in the template."""

    source: str
    key: Column
    template: str = "{value}"


@dataclass(frozen=True)
class Lane:
    """Records (id, text and what the columns below use) with ordered checks, each (reason, condition), ordered lookups, and a situation where none resolves."""

    name: str
    records: DataFrame
    id: Column
    text: Column
    checks: list[tuple[str, Column]] = field(default_factory=list)
    lookups: list[Lookup] = field(default_factory=list)
    default: Column | None = None


def _rows(lane: Lane, number: int) -> DataFrame:
    reason = F.lit(None).cast("string")
    for name, holds in reversed(lane.checks):
        reason = F.when(holds, F.lit(name)).otherwise(reason)
    ways = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(x.source).alias("source"), x.key.cast("string").alias("key"), F.lit(x.template).alias("template")) for i, x in enumerate(lane.lookups)])
    default = F.lit(None) if lane.default is None else lane.default
    return lane.records.select(
        F.lit(lane.name).alias("lane"), F.lit(number).alias("lane_no"), lane.id.cast("string").alias("record_id"), lane.text.alias("text"), reason.alias("reason"),
        ways.cast("array<struct<at:int,source:string,key:string,template:string>>").alias("ways"), default.cast("string").alias("default"),
    )


def read_lanes(lanes: list[Lane], sources: dict[str, DataFrame]) -> DataFrame:
    """One row a record: lane, lane_no, record_id, text, situation, source, reason and misses (source, reason).

    ``sources``: tables (key, value) with an optional ``reason`` for which a row cannot be used; of
    several rows with one key the least usable value counts. A record with a reason is skipped: the first
    check that holds, or ``unverified_trigger`` where no lookup resolves and there is no default. Others
    are accepted. Every record gives one row, repeated ones too; an empty value is no value. Keys are
    compared as strings. Hot keys meet in a join that Spark can split.
    """
    union = None
    for i, lane in enumerate(lanes):
        one = _rows(lane, i)
        union = one if union is None else union.unionByName(one)
    rows = materialize(union.withColumn("__row", F.monotonically_increasing_id()), "lanes")
    tagged = None
    for name, df in sources.items():
        given = F.col("reason").cast("string") if "reason" in df.columns else F.lit(None).cast("string")
        one = df.select(F.lit(name).alias("__source"), F.col("key").cast("string").alias("__key"), F.col("value").cast("string").alias("value"), given.alias("given"))
        tagged = one if tagged is None else tagged.unionByName(one)
    if tagged is None:
        tagged = rows.select(F.lit("").alias("__source"), F.lit("").alias("__key"), F.col("text").alias("value"), F.col("text").alias("given")).limit(0)
    why = F.coalesce("given", F.when(F.coalesce("value", F.lit("")) == "", F.lit(NO_VALUE)))
    tagged = tagged.where("__key is not null").select("__source", "__key", "value", why.alias("why")).groupBy("__source", "__key").agg(F.min(F.struct(F.col("why").isNotNull().alias("unusable"), "value", "why")).alias("got"))
    asked = rows.where("reason is null").select("__row", F.explode("ways").alias("w")).select("__row", "w.*")
    met = asked.join(tagged, (F.col("source") == F.col("__source")) & (F.col("key") == F.col("__key")), "left")
    miss = F.when(F.col("key").isNull(), NO_KEY).when(F.col("got").isNull(), NO_ROW).otherwise(F.col("got.why"))
    told = met.select("__row", "at", "source", miss.alias("why"), F.replace("template", F.lit("{value}"), F.coalesce("got.value", F.lit(""))).alias("made"))
    found = told.groupBy("__row").agg(F.min(F.when(F.col("why").isNull(), F.struct("at", "source", "made"))).alias("hit"), F.array_sort(F.collect_list(F.when(F.col("why").isNotNull(), F.struct("at", "source", "why")))).alias("missed"))
    out = rows.join(found, "__row", "left")
    before = F.filter(F.coalesce("missed", F.array()), lambda m: F.col("hit").isNull() | (m["at"] < F.col("hit.at")))
    misses = F.transform(before, lambda m: F.struct(m["source"].alias("source"), m["why"].alias("reason"))).cast(_MISS)
    situation = F.coalesce("hit.made", "default")
    reason = F.coalesce("reason", F.when(situation.isNull(), F.lit(UNVERIFIED)))
    return out.select("lane", "lane_no", "record_id", "text", F.when(reason.isNull(), situation).alias("situation"), F.when(reason.isNull(), F.col("hit.source")).alias("source"), reason.alias("reason"), misses.alias("misses"))


def accepted(read: DataFrame) -> DataFrame:
    return read.where("reason is null").drop("reason")


def skipped(read: DataFrame) -> DataFrame:
    return read.where("reason is not null").drop("situation", "source")
