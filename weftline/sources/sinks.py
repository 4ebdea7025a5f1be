"""Writers. Spark's committer makes each of them all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus(df: DataFrame, path: str, by: list[str], level: int = 9) -> DataFrame:
    """Write Parquet with zstd and return the counts by source, language and split of what was written."""
    df.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).parquet(path)
    return df.sparkSession.read.parquet(path).groupBy(*by).agg(F.count("*").alias("n"))


def json_lines(df: DataFrame, path: str) -> None:
    """One object a line, non-ASCII text as it is."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def fan_out(df: DataFrame, path: str, by: tuple[str, ...] = ("owner", "split")) -> None:
    """A folder for each owner and split. Rows are dealt by these keys and by hash, so that a large owner is written by several tasks."""
    some = F.pmod(F.xxhash64(*[c for c in df.columns if c not in by]), F.lit(8))
    df.withColumn("__s", some).repartition(*by, "__s").drop("__s").write.mode("overwrite").partitionBy(*by).json(path)


def report(df: DataFrame, path: str) -> None:
    """A small table as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
