"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries find the digests that can hold more than 1/k of all rows. Their exact counts
and survivors (at most k rows) are broadcast, so copies of those texts are settled map-side; all
other digests are grouped by an ordinary shuffle of (digest, id) rows. Texts are never shuffled.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import join_checked, materialize

#: Counters of a summary: every digest with more than rows / COUNTERS copies is found, and at most so many are broadcast.
COUNTERS = 1024


def misra_gries(counts: dict, k: int) -> dict:
    """Cut a mergeable summary to ``k`` counters: take the (k+1)-th largest count off every one."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {x: n - cut for x, n in counts.items() if n > cut}


def _summaries(k: int):
    def run(batches):
        held: dict = {}
        for batch in batches:
            for x in batch.column(0).value_counts().to_pylist():
                held[x["values"]] = held.get(x["values"], 0) + x["counts"]
            held = misra_gries(held, k)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["digest", "n"])

    return run


def heavy_digests(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """(digest) of at most k values, among them every one with more than 2 rows / k copies.

    A task that reads r rows undercounts by less than r / k, so the summed counts of such a digest
    stay above rows / k, and no more than k digests can have that. The k largest sums are counted
    exactly, and those above rows / k are kept.
    """
    rows = digests.count()
    if rows <= k:
        return digests.select("digest").limit(0)
    found = digests.select("digest").mapInArrow(_summaries(k), "digest string, n long")
    likely = found.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(k)
    likely = materialize(likely.select("digest"), "likely")
    exact = digests.join(F.broadcast(likely), "digest").groupBy("digest").agg(F.count("*").alias("n"))
    return materialize(exact.where(F.col("n") > rows / k).select("digest"), "heavy")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = COUNTERS) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (null counts as empty, nothing is normalised) the row with the largest id stays.
    A null id loses to any other; if all ids of a group are null, keep_id is null and all stay, for
    nothing tells which to name. Rows that repeat an id and its text share one verdict. Empty tables
    give no rows; further columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = materialize(docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("digest")), "digests")
    heavy = heavy_digests(digests, k)
    kept = [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    won = materialize(digests.join(F.broadcast(heavy), "digest", "left_semi").groupBy("digest").agg(*kept), "winners")
    some = digests.join(F.broadcast(won), "digest")
    rest = digests.join(F.broadcast(heavy), "digest", "left_anti")
    several = materialize(rest.groupBy("digest").agg(*kept).where("group_size > 1"), "several")
    rest = rest.join(several, "digest", "left").select(
        "digest", "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size")
    )
    out = some.select(*rest.columns).unionByName(rest)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = COUNTERS, single: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only groups of two or more matter here: their (digest, survivor) table is broadcast while it has
    few rows and shuffled beyond that. Survivors that repeat id and text (or all have a null id) all
    stay; with ``single`` one of them does.
    """
    groups = exact_groups(docs, id_col, text_col, k).where("group_size > 1").groupBy("text_sha256").agg(F.max("keep_id").alias("keep_id"), F.count_if("kept").alias("n_kept"))
    groups = materialize(groups.select(F.col("text_sha256").alias("__digest"), F.col("keep_id").alias("__keep"), (F.col("n_kept") > 1).alias("__several")), "copies")
    marked = docs.withColumn("__digest", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    stay = join_checked(marked, groups, "__digest", "left").where(F.col("__keep").isNull() | (F.col(id_col) == F.col("__keep")))
    if single and groups.where("__several").take(1):
        several = F.coalesce("__several", F.lit(False))
        stay = stay.where(~several).unionByName(stay.where(several).dropDuplicates(["__digest"]))
    return stay.select(*docs.columns)
