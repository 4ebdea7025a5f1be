"""Digests of files and folders; files that a table of digests knows unchanged are not read."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a chunk, and of the range of a file that a task reads at a time, chunk by chunk; tasks at most.
CHUNK, RANGE, TASKS = 1 << 20, 32 << 20, 10_000
KNOWN = "path string, length long, modified timestamp, digest string"


def tree_digest(content: Column, chunk: int = CHUNK) -> Column:
    """SHA-256 over the SHA-256 of each chunk of a binary value, in order; an empty value has one empty chunk."""
    n = F.greatest(F.ceil(F.octet_length(content) / chunk), F.lit(1)).cast("int")
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.sha2(F.substring(content, i * chunk + 1, F.lit(chunk)), 256))
    return F.sha2(F.array_join(each, ""), 256)


def changed_files(spark: SparkSession, path: str, known: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """(files with the digests that are known, paths of the others). Listing reads no contents; a file is known by path, length and time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    known = spark.createDataFrame([], KNOWN) if known is None else known.select("path", "length", "modified", "digest").dropDuplicates(["path", "length", "modified"])
    met = files.join(known, ["path", "length", "modified"], "left")
    return met, [r["path"] for r in met.where("digest is null").select("path").collect()]


def _range_digests(chunk: int, span: int):
    """Over (path, length, modified, k) of files that every executor can open: the digests of the chunks of range ``k`` of each, joined."""

    def joined(path: str, length: int, k: int) -> str:
        found, left = [], min(span, length - k * span)
        with open("/" + path.removeprefix("file:").lstrip("/"), "rb") as f:
            f.seek(k * span)
            while left > 0:
                data = f.read(min(chunk, left))
                if len(data) < min(chunk, left):
                    raise OSError(f"{path} became shorter while it was read")
                found.append(hashlib.sha256(data).hexdigest())
                left -= len(data)
        return "".join(found)

    def run(batches):
        for batch in batches:
            paths, lengths, _, ks = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):  # a row at a time: its digest is all that is held
                d = joined(paths[i].as_py(), lengths[i].as_py(), ks[i].as_py())
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, pa.array([d], pa.string())], names=["path", "length", "modified", "k", "d"])

    return run


def _by_ranges(files: DataFrame, chunk: int, sizes: list[int]) -> DataFrame:
    """(path, length, modified, digest) of files of ``sizes``, each read in ranges that are dealt over tasks: no task holds more than a chunk."""
    span = chunk * max(1, RANGE // chunk)
    n = sum(-(-size // span) for size in sizes)
    ranges = files.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {span}")))).repartition(max(1, min(n, TASKS)))
    parts = ranges.mapInArrow(_range_digests(chunk, span), "path string, length long, modified timestamp, k long, d string")
    each = F.transform(F.array_sort(F.collect_list(F.struct("k", "d"))), lambda x: x["d"])
    return parts.groupBy("path", "length", "modified").agg(F.sha2(F.array_join(each, ""), 256).alias("digest"))


def file_digests(spark: SparkSession, path: str, known: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """(path, length, modified, digest, was_read) of all files under ``path``, which may be given as ``known`` the next time.

    Only files that are new or changed are read. The driver lists files, as it does for any scan. Files
    of ``file:`` paths, of any size, are read in ranges. Those in other stores, which Spark alone opens,
    are read as a whole by its source of whole files, which takes none of 2 GB and more and holds each in
    memory. Empty files are left out.
    """
    met, paths = changed_files(spark, path, known)
    out = met.where("digest is not null").withColumn("was_read", F.lit(False))
    far = [p for p in paths if not p.startswith("file:")]
    if len(far) < len(paths):
        near = met.where(F.col("digest").isNull() & F.col("path").startswith("file:")).select("path", "length", "modified")
        fresh = _by_ranges(near, chunk, [r["length"] for r in near.select("length").collect()])
        out = out.unionByName(fresh.withColumn("was_read", F.lit(True)))
    if far:
        src = spark.read.format("binaryFile").load([p.replace("{", "\\{").replace("[", "\\[").replace("*", "\\*").replace("?", "\\?") for p in far])
        fresh = src.select("path", "length", F.col("modificationTime").alias("modified"), tree_digest(F.col("content"), chunk).alias("digest"))
        out = out.unionByName(fresh.withColumn("was_read", F.lit(True)))
    return out


def folder_digest(digests: DataFrame, root: str) -> DataFrame:
    """One row: files, bytes and the digest of a folder, from names below ``root`` and digests in order; 256 buckets of names come first, so that no task holds all names."""
    name = F.regexp_replace("path", "^.*?" + r"\Q" + root.rstrip("/") + r"/\E", "")
    rows = digests.select(name.alias("name"), "digest", "length").withColumn("bucket", F.substring(F.sha2("name", 256), 1, 2))
    parts = rows.groupBy("bucket").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "name", "digest"))), "\n"), 256).alias("d"), F.count("*").alias("n"), F.sum("length").alias("bytes"))
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "bucket", "d"))), "\n"), 256).alias("digest"))
