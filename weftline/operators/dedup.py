"""Duplicates by key, with a stated survivor."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import join_checked, materialize


def first_seen(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``kept``: the first row of each key in the order of the columns given, which must tell its rows apart.

    Only keys with several rows are joined back, with the first of each, so that a key with many rows is
    no task of its own. Nulls are one key.
    """
    best = df.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.min(F.struct(*order)).alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key])
    out = join_checked(df, materialize(best, "several"), same, "left")
    return out.withColumn("kept", F.col("__first").isNull() | F.struct(*order).eqNullSafe(F.col("__first"))).select(*df.columns, "kept")


def first_rows(df: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """``columns`` of the first row of each key, where the other rows are not asked for: one aggregate."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("__r")).select("__r.*")


def focus_dedup(df: DataFrame, key: str, focus: Column, order: str) -> DataFrame:
    """One row a key: the last that is in focus, or else the first. An aggregate: rows of a key are reduced before they are shuffled."""
    f = F.coalesce(focus, F.lit(False))
    rank = F.struct((~f).alias("a"), F.when(f, -F.col(order)).otherwise(F.col(order)).alias("b"))
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), rank).alias("__r")).select("__r.*")
