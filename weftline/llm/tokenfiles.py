"""Token ids of a corpus in ORC files.

Documents are put in the order of their ids and encoded where they are written. Spark's ORC writer
stores the ids in stripes with integer run-length encoding, row indexes and a Bloom filter on the
document id. A scan is split by stripes, and a lookup by id leaves out stripes and row groups by their
metadata. Each row knows its file's place and its own place there, so that the place in the whole
corpus needs the files' totals only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.plans.shared import join_checked, materialize, new_path

from .packing import TokenMemo
from .textkernel import STEP, steps

#: Rows of a row group of the index, bytes of a stripe, and share of false hits of the Bloom filter.
ROW_GROUP, STRIPE, FALSE_HITS = 1000, 64 << 20, 0.01
END = 2
ROW = "doc_id long, part int, at long, n_tokens int, ids array<int>"


def _encoded(path: str, end: int):
    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        memo, part, at = TokenMemo(path), TaskContext.get().partitionId(), 0
        close = np.uint32(end).tobytes()
        for batch in batches:
            docs, texts = batch.column(0), batch.column(1).fill_null("")
            sizes = np.zeros(len(texts) + 1, np.int64)
            np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False), out=sizes[1:])
            for a, b in steps(sizes, STEP):
                ids = [i + close for i in memo.ids(texts.slice(a, b - a).to_pylist())]
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
                cols = [docs.slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(at + ends[:-1]), pa.array(np.diff(ends), pa.int32()), lists]
                at += int(ends[-1])
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "part", "at", "n_tokens", "ids"])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, stripe: int = STRIPE, row_group: int = ROW_GROUP) -> None:
    """Write the ids of every document, in ascending order of document ids, to ORC files under ``path``.

    A null text is empty: its end id alone. Null document ids come first. Rows of one id are ordered
    by a hash of their texts and then by their place in the table, so that they may fill several files.
    An empty table gives files without rows.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    src = src.withColumns({"__tie": F.xxhash64("text"), "__place": F.monotonically_increasing_id()})
    order = ["doc_id", "__tie", "__place"]
    src = src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = src.mapInArrow(_encoded(tokenizer, end), ROW)
    options = {"orc.compress": "ZSTD", "orc.stripe.size": stripe, "orc.create.index": "true", "orc.row.index.stride": row_group, "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_HITS}
    rows.write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files: doc_id, part, at, n_tokens, ids. Filters on doc_id reach the files' metadata."""
    return spark.read.schema(ROW).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """The rows of some documents; stripes and row groups whose ranges or Bloom filters exclude all of them are not read."""
    return read_tokens(spark, path).where(F.col("doc_id").isin([int(i) for i in doc_ids]))


def file_starts(rows: DataFrame) -> DataFrame:
    """(part, base): ids in all files before each, from narrow columns alone; one row a file."""
    totals = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base"))


def _checksums(batches):
    for batch in batches:
        lists = batch.column(0)
        ends = lists.offsets.to_numpy().astype(np.int64)
        flat = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
        sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), pa.array(np.diff(ends)), pa.array(sums, pa.int64())], names=["doc_id", "part", "at", "n_tokens", "ids_crc32"])


def document_offsets(spark: SparkSession, path: str) -> DataFrame:
    """One row a document, from the files: doc_id, start, n_tokens, ids_crc32."""
    rows = read_tokens(spark, path)
    bases = materialize(file_starts(rows), "filestarts")
    read = rows.select("ids", "doc_id", "part", "at").mapInArrow(_checksums, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    return join_checked(read, bases, "part", "left").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encoded_documents(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` to ORC files in the shared folder (or ``path``) and return what the files say of each document.

    Repeated rows are documents of their own; further columns are not read.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return document_offsets(spark, path)
