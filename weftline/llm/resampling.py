"""Importance resampling of documents towards a target distribution, over hashed n-grams.

A dictionary of distinct features is built first. Tasks count words and pairs of words and send them
sorted, many to a line, by ranges of features that a small sample balances. There equal strings are
added up, each distinct string is hashed once, and buckets are summed: a table of fixed size. Its gains
then meet the features of each document, where a task keeps the gain of every string that it has met.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import materialize, ranged_total

from .textkernel import STEP, steps

#: What a byte becomes. Words are of digits, letters and all that is not ASCII; A-Z become lower case, every other byte a space.
BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Features that a task counts before it sends them, strings whose gain it remembers, and features of one line.
HELD, MEMO, LINE = 1_500_000, 1_000_000, 1024
#: Rows, features a row and bytes a feature of the sample that balances ranges of features. It decides where strings meet, never what is counted.
SAMPLE_ROWS, SAMPLE_FEATURES, CUT = 2000, 64, 64


@dataclass(frozen=True)
class Resampling:
    """Buckets, seed, least words of a document that may be drawn, percent drawn."""

    buckets: int = 10_000
    seed: int = 7
    least_words: int = 20
    percent: int = 25


def words(text: bytes) -> list[bytes]:
    return text.translate(BYTES).split()


def _texts(column):
    """Lists of texts in UTF-8, each list of about STEP bytes; a null is an empty text."""
    texts = column.fill_null("").cast(pa.binary())
    sizes = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False), out=sizes[1:])
    for a, b in steps(sizes, STEP):
        yield a, b, texts.slice(a, b - a).to_pylist()


def _lines(counts: dict[bytes, int], cuts: list[bytes]):
    """(part, once, line of features in order): those that were met once as they are, the others with their counts."""
    several = sorted([f for f, n in counts.items() if n > 1])
    for once, order in ((True, sorted([f for f, n in counts.items() if n == 1])), (False, several)):
        ends = [0, *(bisect_left(order, c) for c in cuts), len(order)]
        for part, (a, b) in enumerate(zip(ends, ends[1:])):
            for i in range(a, b, LINE):
                some = order[i : min(b, i + LINE)]
                yield part, once, b"\n".join(some if once else [b"%b:%d" % (f, counts[f]) for f in some])


def _counted(cuts: list[bytes]):
    def sent(counts):
        rows = _lines(counts, cuts)
        while some := list(islice(rows, 64)):
            part, once, line = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(once), pa.array(line).cast(pa.string())], names=["part", "once", "line"])

    def run(batches):
        counts = Counter()
        for batch in batches:
            for _, _, texts in _texts(batch.column(0)):
                for text in texts:
                    found = words(text)
                    counts.update(found)
                    counts.update(map(b" ".join, pairwise(found)))
                if len(counts) > HELD:
                    yield from sent(counts)
                    counts = Counter()
        yield from sent(counts)

    return run


def _sampled(batches):
    for batch in batches:
        out = []
        for text in batch.column(0).fill_null("").cast(pa.binary()).to_pylist():
            found = words(text)
            pairs = sorted({*found, *map(b" ".join, pairwise(found))})
            out += [f[:CUT] for f in pairs[:: -(-len(pairs) // SAMPLE_FEATURES)]] if pairs else []
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["feature"])


def feature_cuts(texts: DataFrame, parts: int) -> list[bytes]:
    """Features at which the dictionary is cut into ``parts`` ranges of about equal size, from a sample of bounded size."""
    rows = texts.count()
    if not rows or parts < 2:
        return []
    some = texts.sample(min(1.0, SAMPLE_ROWS / rows), seed=1)
    found = sorted(bytes(r["feature"]) for r in some.mapInArrow(_sampled, "feature binary").collect())
    return sorted({found[k * len(found) // parts] for k in range(1, parts)}) if found else []


def distinct_features(sides: dict[str, DataFrame], parts: int) -> DataFrame:
    """The dictionary: feature and how often each side (name -> texts) has it, one row a distinct string."""
    cuts = feature_cuts(next(iter(sides.values())), parts)
    tables = [t.mapInArrow(_counted(cuts), "part int, once boolean, line string").withColumn("side", F.lit(k)) for k, t in enumerate(sides.values())]
    lines = tables[0]
    for t in tables[1:]:
        lines = lines.unionByName(t)
    each = lines.repartitionById(len(cuts) + 1, "part").select("part", "side", "once", F.explode(F.split("line", "\n")).alias("f"))
    feature = F.when(F.col("once"), F.col("f")).otherwise(F.substring_index("f", ":", 1))
    each = each.select("part", "side", feature.alias("feature"), F.when(F.col("once"), 1).otherwise(F.substring_index("f", ":", -1).cast("long")).alias("n"))
    # Rows of a range are together already: no further exchange for (part, feature).
    sums = [F.sum(F.when(F.col("side") == k, F.col("n")).otherwise(0)).alias(name) for k, name in enumerate(sides)]
    return each.groupBy("part", "feature").agg(*sums).drop("part")


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str, how: Resampling, parts: int | None = None) -> list[int]:
    """Gain of each bucket: floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))). Nulls are texts without words."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.col(text_col).alias("text")
    features = distinct_features({"s": docs.select(text), "t": target.select(text)}, parts)
    bucket = F.crc32(F.col("feature").cast("binary")) % how.buckets
    sums = materialize(features.groupBy(bucket.alias("bucket")).agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "buckets")
    counts = {r["bucket"]: (r["s"], r["t"]) for r in sums.collect()}  # at most one row a bucket
    all_s, all_t = (sum(c[k] for c in counts.values()) for k in (0, 1))
    odds = ((float(t + 1) * (all_s + how.buckets)) / (float(s + 1) * (all_t + how.buckets)) for s, t in (counts.get(b, (0, 0)) for b in range(how.buckets)))
    return [math.floor(1000 * math.log(x)) for x in odds]


class Gains(dict):
    """Gain by feature: a string that is met for the first time is hashed, and its bucket's gain kept."""

    def __init__(self, gains: list[int]):
        super().__init__()
        self.gains = gains

    def __missing__(self, feature: bytes) -> int:
        out = self[feature] = self.gains[zlib.crc32(feature) % len(self.gains)]
        return out


def _weighed(gains: list[int]):
    def run(batches):
        memo = Gains(gains)
        gain = memo.__getitem__
        for batch in batches:
            for a, b, texts in _texts(batch.column(1)):
                n_words, n_features, weight = [], [], []
                for text in texts:
                    found = words(text)
                    n = max(2 * len(found) - 1, 0)
                    total = sum(map(gain, found)) + sum(map(gain, map(b" ".join, pairwise(found))))
                    n_words.append(len(found))
                    n_features.append(n)
                    weight.append(total // n if n else 0)
                    if len(memo) > MEMO:
                        memo.clear()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return run


def weighted(docs: DataFrame, gains: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean of a document's gains (0 without features)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(_weighed(gains), "doc_id long, n_words long, n_features long, weight long")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", how: Resampling = Resampling()) -> DataFrame:
    """One row a document: doc_id, n_features, weight, score, rank (null unless drawn).

    Scores add Gumbel noise from a hash of the id, so that the highest are a weighted draw without
    replacement, and reruns agree. Rows without an id have no score, count for no quota and are never
    drawn; repeated rows are documents of their own and are told apart by the order of ties (score,
    then id, then n_features). Empty tables give no rows, an empty target equal gains; other columns are not read.
    """
    gains = bucket_gains(docs.withColumnRenamed(text_col, "__text"), target.withColumnRenamed(target_col, "__text"), "__text", how)
    rows = weighted(docs, gains, id_col, text_col)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = materialize(rows.withColumn("score", F.col("weight") + noise), "weighed")
    able = (F.col("n_words") >= how.least_words) & F.col("doc_id").isNotNull()
    quota = rows.where(able).count() * how.percent // 100
    ranked = ranged_total(rows.where(able).withColumns({"__all": F.lit(0), "__last": -F.col("score")}), "__all", ["__last", "doc_id", "n_features"], F.lit(1), "__before")
    ranked = ranked.withColumn("rank", F.when(F.col("__before") < quota, F.col("__before") + 1))
    rest = rows.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """The rows of ``docs`` that the draw takes, with all their columns; ids must be unique."""
    keys = resampled(docs, target, how=how).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__id"))
    return docs.join(keys, F.col("doc_id") == F.col("__id"), "left_semi")
