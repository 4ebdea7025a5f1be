"""Selection and batching: samples, pools by length, token offsets, padding; greedy micro-batches are in ``batches``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.hashing import seeded_order
from weftline.plans.shared import join_checked, materialize, ranged_total, running_total


def _seeded(df: DataFrame, owner: str, id_col: str, seed: int) -> DataFrame:
    """``df`` with ``__owner`` and ``__before``, the owner's rows ahead in a seeded order; the order's first digits are the cells, so no task holds an owner."""
    key = seeded_order(seed, F.col(id_col))
    cell = F.coalesce(F.conv(F.substring(key, 1, 4), 16, 10).cast("int"), F.lit(-1))
    return running_total(df.withColumn("__owner", F.struct(owner)), "__owner", cell, [key, F.col(id_col)], F.lit(1), "__before")


def sample_per_owner(df: DataFrame, owner: str, id_col: str, count: Column, seed: int = 42) -> DataFrame:
    """The first ``count`` rows of each owner in a seeded order; ``count`` may use ``available``, the owner's rows. Null is an owner."""
    sizes = materialize(df.groupBy(F.struct(owner).alias("__o")).agg(F.count("*").alias("available")), "owners")
    out = join_checked(_seeded(df, owner, id_col, seed), sizes, F.col("__owner") == F.col("__o"), "inner")
    return out.where(F.col("__before") < count).drop("__owner", "__o", "__before")


def length_batches(df: DataFrame, owner: str, id_col: str, length: str, batch: int = 8, pool_batches: int = 16, seed: int = 42) -> DataFrame:
    """``df`` with ``pool`` and ``batch``: rows of an owner in a seeded order, pools of 16 batches, sorted by length within each."""
    out = _seeded(df, owner, id_col, seed)
    out = out.withColumn("pool", F.floor(F.col("__before") / (batch * pool_batches))).drop("__owner", "__before")
    v = Window.partitionBy(owner, "pool").orderBy(length, id_col)
    return out.withColumn("batch", F.floor((F.row_number().over(v) - 1) / batch))


def shuffled_batches(batches: DataFrame, owner: str, seed: int = 42) -> DataFrame:
    """``batches`` (owner, pool, batch) with ``step``: the place of each batch among its owner's, from 0, in a seeded order, whatever its pool."""
    units = batches.select(owner, "pool", "batch").distinct().withColumn("__unit", F.concat_ws("|", F.coalesce(F.col(owner).cast("string"), F.lit("")), F.col("pool").cast("string"), F.col("batch").cast("string")))
    placed = _seeded(units, owner, "__unit", seed).select(F.col(owner).alias("__b_owner"), F.col("pool").alias("__b_pool"), F.col("batch").alias("__b_batch"), F.col("__before").alias("step"))
    on = F.col(owner).eqNullSafe(F.col("__b_owner")) & (F.col("pool") == F.col("__b_pool")) & (F.col("batch") == F.col("__b_batch"))
    return join_checked(batches, materialize(placed, "steps"), on, "inner").drop("__b_owner", "__b_pool", "__b_batch")


def token_offsets(df: DataFrame, owner: str, id_col: str, size: str) -> DataFrame:
    """``df`` with ``offset``: the tokens before each row in its owner's flat store; a null size counts as none."""
    return ranged_total(df, owner, [id_col], F.coalesce(F.col(size), F.lit(0)), "offset")


def pad(ids: Column, width: Column, fill: int = 0) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(fill).cast("int"), F.greatest(width - F.size(ids), F.lit(0)).cast("int")))


def label_mask(prompt_tokens: Column, ids: Column, ignore: int = -100) -> Column:
    """Labels of a token sequence: the prompt's places are ignored."""
    return F.transform(ids, lambda x, i: F.when(i < prompt_tokens, F.lit(ignore)).otherwise(x))
