"""Tables written to the shared folder, and joins whose broadcast is checked."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where that is unset and Spark runs in this one process (tests)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    own = sc._jsc.sc().getCheckpointDir()
    if own.isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weftline-"))
        own = sc._jsc.sc().getCheckpointDir()
    return own.get().rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception:  # the session has ended: the folder goes with the cluster's own cleaning
        pass


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh shared path, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/weftline/{tag}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def materialize(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage, survives lost executors and gives the planner real sizes, so that it
    broadcasts a side only when that side is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's own switch for removing a statement's shuffle files at its end instead of when the driver's garbage is collected.
_SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_alone(df: DataFrame, tag: str = "t") -> DataFrame:
    """``materialize`` whose shuffle files are gone when it returns, for large shuffles one after the other."""
    conf = df.sparkSession.conf
    before = conf.get(_SHUFFLES_END, None)
    conf.set(_SHUFFLES_END, "true")
    try:
        return materialize(df, tag)
    finally:
        conf.unset(_SHUFFLES_END) if before is None else conf.set(_SHUFFLES_END, before)


def release(df: DataFrame) -> None:
    """Delete a materialized table that no later plan reads."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, path)


#: Rows up to which a narrow, materialized side is broadcast.
BROADCAST_ROWS = 50_000


def join_checked(left: DataFrame, right: DataFrame, on, how: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a materialized ``right`` that is broadcast if it has at most ``rows`` rows, else shuffled."""
    if len(right.limit(rows + 1).groupBy().count().where(F.col("count") <= rows).take(1)):
        right = F.broadcast(right)
    return left.join(right, on, how)


def ranged_total(df: DataFrame, group: str, order: list[str], weight, name: str) -> DataFrame:
    """``running_total`` in the order of columns: ranges of (group, order) are the cells, even whatever the values are. Nulls are a group."""
    rows = df.withColumn("__group", F.struct(group)).repartitionByRange(group, *order)
    rows = materialize(rows.withColumn("__range", F.spark_partition_id()), "ranges")
    return running_total(rows, "__group", F.col("__range"), order, weight, name).drop("__group", "__range")


def running_total(df: DataFrame, group: str, bucket, order: list, weight, name: str) -> DataFrame:
    """Running sum of ``weight`` before each row of a group, over (bucket, order); no task holds a whole group."""
    df = df.withColumn("__b", bucket)
    cells = df.groupBy(group, "__b").agg(F.sum(weight).alias("__n"))
    ahead = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col(group).alias("__g"), F.col("__b").alias("__c"), F.coalesce(F.sum("__n").over(ahead), F.lit(0)).cast("long").alias("__ahead"))
    cells = materialize(cells, "cells")
    within = Window.partitionBy(group, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("__in", F.coalesce(F.sum(weight).over(within), F.lit(0)).cast("long"))
    df = df.join(cells, (F.col(group) == F.col("__g")) & (F.col("__b") == F.col("__c")))
    return df.withColumn(name, F.col("__ahead") + F.col("__in")).drop("__b", "__g", "__c", "__ahead", "__in")
