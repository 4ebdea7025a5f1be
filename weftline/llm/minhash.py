"""MinHash near-dedup with tensored banding.

Two collections A and B of m entries, each entry two minhashes; table (i, j) is keyed by A[i] and
B[j]. So m * m tables of four minhashes need 4 m minhashes and not 4 m * m. A pair of similarity t
meets in no table with a probability under 2 (1 - t^2)^m; m is set so that this is under ``MISS``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.graph import connected_components
from weftline.plans.shared import join_checked, materialize, release

from .textkernel import U64, list_array, mix, shingles, steps, utf8, words

MISS = 1e-4
#: Words of 64 bits in a set's bitmap.
WORDS = 16
BITS = [f"b{w}" for w in range(WORDS)]
SIGNED = "doc_id long, n long, f1 long, f2 long, a array<long>, b array<long>"


def entries(percent: int, miss: float = MISS) -> int:
    """Entries of a collection: the least m with 2 (1 - t^2)^m <= miss."""
    t = percent / 100
    return 1 if t >= 1 else max(1, math.ceil(math.log(miss / 2) / math.log(1 - t * t)))


def _constants(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) + (U64(seed) << U64(32))) | U64(1)


def collections(sets: list[np.ndarray], m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(A, B), each of shape (texts, m): hashes of pairs of minhashes; ``sets`` must not be empty."""
    flat, heads = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    low = []
    for c, x in zip(_constants(seed, 4 * m), _constants(seed + 1, 4 * m), strict=True):
        v = (flat ^ x) * c
        v ^= v >> U64(29)
        v *= c
        low.append(np.minimum.reduceat(v, heads))
    pairs = [mix(low[2 * i] * U64(0x9E3779B97F4A7C15) + low[2 * i + 1] + U64(i)) for i in range(2 * m)]
    return np.stack(pairs[:m], 1), np.stack(pairs[m:], 1)


def _signed(k: int, m: int, seed: int):
    def run(batches):
        for batch in batches:
            data, offs = utf8(batch.column(1))
            for a, b in steps(offs):
                word, at, _ = words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                sets = shingles(word, at, k)
                full = [i for i, s in enumerate(sets) if len(s)]
                none = np.zeros(0, np.int64)
                left, right, f1, f2 = [none] * len(sets), [none] * len(sets), np.zeros(len(sets), U64), np.zeros(len(sets), U64)
                if full:
                    own = [sets[i] for i in full]
                    x, y = collections(own, m, seed)
                    for r, i in enumerate(full):
                        left[i], right[i] = x[r].view(np.int64), y[r].view(np.int64)
                    flat, heads = np.concatenate(own), np.cumsum([0] + [len(s) for s in own[:-1]])
                    f1[full] = np.add.reduceat(mix(flat ^ U64(0x5851F42D4C957F2D)), heads)
                    f2[full] = np.add.reduceat(mix(flat ^ U64(0x14057B7EF767814F)), heads)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), list_array(left), list_array(right)],
                    names=["doc_id", "n", "f1", "f2", "a", "b"],
                )

    return run


def bitmaps(sets: list[np.ndarray]) -> list[np.ndarray]:
    """WORDS columns of 64 bits: a set's bit is how many of its elements have that number, modulo 2.

    An element in which two sets differ changes one bit, so they differ in as many elements as bits at least.
    """
    out = [np.zeros(len(sets), U64) for _ in range(WORDS)]
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat, heads = np.concatenate([sets[i] for i in full]), np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        bit, word = U64(1) << (flat & U64(63)), (flat >> U64(6)) % U64(WORDS)
        for w in range(WORDS):
            out[w][full] = np.bitwise_xor.reduceat(np.where(word == U64(w), bit, U64(0)), heads)
    return out


def _sets(k: int):
    def run(batches):
        for batch in batches:
            data, offs = utf8(batch.column(1))
            for a, b in steps(offs):
                word, at, _ = words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                sets = shingles(word, at, k)
                bits = [pa.array(c.view(np.int64)) for c in bitmaps(sets)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), list_array(sets), *bits], names=["id", "shingles", *BITS])

    return run


def _sets_of(ids: DataFrame, src: DataFrame, k: int) -> DataFrame:
    """(id, shingles, bitmap) of the documents in ``ids`` (id), computed anew from their texts."""
    who = materialize(ids.distinct(), "who")
    texts = join_checked(src, who.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi", 200_000)
    return materialize(texts.mapInArrow(_sets(k), "id long, shingles array<long>, " + ", ".join(f"{b} long" for b in BITS)), "sets")


def _beside(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (x, y, ...) with the full shingle sets sx and sy, and the bitmap of x."""
    both = pairs.join(sets.select(F.col("id").alias("x"), F.col("shingles").alias("sx"), *BITS), "x")
    return both.join(sets.select(F.col("id").alias("y"), F.col("shingles").alias("sy")), "y")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the distinct ``pairs`` (x, y) those whose full shingle sets are similar enough."""
    common = F.size(F.array_intersect("sx", "sy"))
    union = F.size("sx") + F.size("sy") - common
    return materialize(_beside(pairs, sets).where(100 * common >= percent * union).select("x", "y"), "links")


def _candidates(diffs: DataFrame, percent: int) -> DataFrame:
    """Pairs (pivot, x, z) of rows (pivot, x, n, grp, d, bitmap) of different groups that may be linked.

    Elements that the same rows of a pivot hold are one piece, which counts as often as it has elements:
    near copies share long runs, and meet once a piece, not once an element. Pieces come in one order,
    those of few rows first, elements of a single row before all. What all rows have in common, as
    all that the pivot alone has or lacks, comes last. Let ``at`` elements of x and ``zat`` of z stand
    before the first piece that both have: then as many differ, at + zat in all, and at most half of
    what may differ is in the lesser of d(x) and d(z). So the lesser is joined by the pieces that begin within
    n (100 - percent) / (2 percent), the other by those within twice that; then positional and bitmap
    filters bound the overlap.
    """
    words = [c for c in diffs.columns if c in BITS]
    row = F.xxhash64("pivot", "x", "n", "grp", *words)
    size = F.size("d").cast("long").alias("size")
    about = diffs.select(row.alias("row"), "pivot", "x", "n", "grp", *words, size)
    by = Window.partitionBy("token")
    held = diffs.select(row.alias("row"), F.explode("d").alias("token"), "pivot").select("row", F.xxhash64("pivot", "token").alias("token"))
    held = held.select("row", F.count("*").over(by).alias("c"), F.bit_xor("row").over(by).alias("h1"), F.sum(F.shiftright("row", 32)).over(by).alias("h2")).where("c > 1")
    pieces = held.groupBy("row", "c", F.xxhash64("c", "h1", "h2").alias("piece")).agg(F.count("*").alias("w"))
    own = Window.partitionBy("row")
    upto = own.orderBy("c", "piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.select("row", "piece", (F.sum("w").over(upto) - F.col("w") - F.sum("w").over(own)).alias("back"))
    spread = pieces.join(about, "row").withColumn("at", F.col("size") + F.col("back")).where(F.col("at") * percent <= F.col("n") * (100 - percent))
    spread = materialize(spread.drop("back", "row"), "pieces")
    near = [("x", "z"), ("n", "zn"), ("grp", "zgrp"), ("size", "zsize"), ("at", "zat"), *[(b, f"z{b}") for b in words]]
    other = spread.select("pivot", "piece", *[F.col(a).alias(b) for a, b in near])
    lesser = spread.where(2 * F.col("at") * percent <= F.col("n") * (100 - percent))
    most = F.least(F.col("size") - F.col("at"), F.col("zsize") - F.col("zat"))
    slack = (F.col("n") + F.col("zn")) * (100 - percent)
    able = (2 * most * (100 + percent) >= (F.col("size") + F.col("zsize")) * (100 + percent) - slack) & (F.abs(F.col("size") - F.col("zsize")) * (100 + percent) <= slack)
    able &= ((F.col("at") + F.col("zat")) * (100 + percent) <= slack) & (2 * F.col("at") * (100 + percent) <= slack)
    alike = 100 * F.least("n", "zn") >= percent * F.greatest("n", "zn")
    bits = sum(F.bit_count(F.col(b).bitwiseXOR(F.col(f"z{b}"))) for b in words)
    able &= bits * (100 + percent) <= slack
    first = (F.col("size") < F.col("zsize")) | ((F.col("size") == F.col("zsize")) & (F.col("x") < F.col("z")))
    cand = lesser.join(other, ["pivot", "piece"]).where(first & (F.col("x") != F.col("z")) & (F.col("grp") != F.col("zgrp")) & able & alike)
    return cand.select("pivot", F.least("x", "z").alias("x"), F.greatest("x", "z").alias("z"))


def _across(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) between rows (x, y = its pivot, grp) and their pivots (grp = y) or others of the pivot, of different groups.

    With d(x) the symmetric difference of x and the pivot, that of x and z is that of d(x) and d(z).
    So a link needs |d(x) and d(z) differ| <= (n(x) + n(z)) (100 - percent) / (100 + percent), and two
    rows of which one at least is not linked with the pivot then share an element (``_candidates``).
    Rows that are linked with the pivot are of its group from then on. The pairs left are verified exactly.
    """
    gone = F.concat(F.array_except("sx", "sy"), F.array_except("sy", "sx"))
    # the pivot's set is part of its key, for rows that share an id may have several sets
    diffs = _beside(rows, sets).select("x", "y", F.xxhash64("y", "sy").alias("pivot"), F.size("sx").cast("long").alias("n"), F.size("sy").cast("long").alias("pn"), "grp", gone.alias("d"), *BITS)
    linked = F.size("d") * (100 + percent) <= (F.col("n") + F.col("pn")) * (100 - percent)
    diffs = diffs.withColumn("first", linked & (F.col("grp") != F.col("y"))).withColumn("grp", F.when(linked, F.col("y")).otherwise(F.col("grp")))
    diffs = materialize(diffs.where((F.size("d") > 0) | F.col("first")), "diffs")
    cand = _candidates(diffs.where(F.size("d") > 0).drop("y", "pn", "first"), percent)
    cand = materialize(cand.groupBy("x", "z").agg(F.min("pivot").alias("pivot")), "cand")
    one = cand.join(diffs.select("pivot", "x", "n", F.col("d").alias("dx")), ["pivot", "x"])
    two = one.join(diffs.select("pivot", F.col("x").alias("z"), F.col("n").alias("zn"), F.col("d").alias("dz")), ["pivot", "z"])
    apart = F.size("dx") + F.size("dz") - 2 * F.size(F.array_intersect("dx", "dz"))
    two = two.where(apart * (100 + percent) <= (F.col("n") + F.col("zn")) * (100 - percent)).select("x", F.col("z").alias("y"))
    links = materialize(two.unionByName(diffs.where("first").select("x", "y")).distinct(), "more")
    release(diffs)
    return links


def common_sizes(sets: list[np.ndarray], chunk: int = 8192) -> np.ndarray:
    """Sizes of all intersections of a block of sorted distinct sets, by products of 0/1 columns, ``chunk`` of them at a time."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)))
    for a in range(0, int(shared.sum()), chunk):
        i, j = np.searchsorted(column, [a, a + chunk])
        x = np.zeros((len(sets), chunk), np.float32)
        x[row[i:j], column[i:j] - a] = 1
        out += x @ x.T
    return out


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 85, seed: int = 11) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept.

    Words are the runs of bytes other than 0x20 and 0x09-0x0D, A-Z in lower case. A document's set
    holds its distinct shingles of ``k`` words; with fewer words its whole sequence; without words or
    text it is empty and linked with nothing. Documents with intersection / union >= percent / 100 are
    linked, on full sets; component_id is the smallest id reachable. Documents of equal sets are one
    class from the start. Rows that share an id are one node; those without an id are linked with
    nothing, have no component and are kept. Empty tables give no rows.

    In each table every class first meets its bucket's pivot, the one with the least id. In buckets that
    the links so far leave in several groups, classes of different groups are then compared by their
    differences to the pivot (``_across``), so that nothing that shares a bucket goes unverified unless
    it is already connected. A pair in many buckets is compared once, and what is shuffled is in
    proportion to the classes, however large a bucket is.
    """
    m = entries(percent)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(src.mapInArrow(_signed(k, m, seed), SIGNED), "signed")
    full = signed.where("n > 0 and doc_id is not null")
    classes = full.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members"), F.first("a").alias("a"), F.first("b").alias("b"))
    classes = materialize(classes, "classes")

    key = F.explode(F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y)))))
    keyed = classes.select(key.alias("key"), "rep", "n")
    pivots = keyed.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("p"), F.count("*").alias("c")).where("c > 1")
    pivots = materialize(pivots.select("key", F.col("p.rep").alias("p"), F.col("p.n").alias("pn"), "c"), "pivots")
    met = materialize(keyed.join(pivots, "key").where(F.col("rep") != F.col("p")), "met")
    release(pivots)
    near = 100 * F.least("n", "pn") >= percent * F.greatest("n", "pn")
    cand = met.groupBy(F.col("rep").alias("x"), F.col("p").alias("y")).agg(F.max(near).alias("near"), F.max(F.col("c") > 2).alias("several"))
    cand = materialize(cand.where("near or several"), "cand")
    sets = _sets_of(cand.select(F.explode(F.array("x", "y")).alias("id")), src, k)
    links = _verified(cand.where("near").select("x", "y"), sets, percent)
    comp = materialize(connected_components(links, "x", "y"), "comp")

    # buckets of three or more classes in several groups; pivots of one group are one, the least of the group
    of = comp.select(F.col("id").alias("rep"), "component")
    rows = met.where("c > 2").join(of, "rep", "left").withColumn("grp", F.coalesce("component", "rep")).drop("component")
    rows = rows.join(of.withColumnRenamed("rep", "p"), "p", "left").withColumn("p", F.coalesce("component", "p"))
    split = rows.groupBy("key").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo <> hi").select("key")
    rows = rows.join(materialize(split, "several"), "key", "left_semi")
    rows = materialize(rows.select(F.col("rep").alias("x"), F.col("p").alias("y"), "grp").distinct(), "rows")
    # a pivot that has met a lesser one gives its rows to it: families meet under few pivots, a pair is compared under few
    least = rows.groupBy(F.col("x").alias("y")).agg(F.min("y").alias("least"))
    rows = rows.join(least, "y", "left").select("x", F.least("y", "least").alias("y"), "grp").where("x <> y").distinct()
    rows = materialize(rows, "fewer")
    release(met)
    if rows.take(1):
        links = links.unionByName(_across(rows, sets, percent))
        comp = materialize(connected_components(links, "x", "y"), "comp")
    release(sets)

    named = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = materialize(named.where("members > 1 or component <> rep").select("f1", "f2", "n", "component"), "named")
    out = signed.join(named, ["f1", "f2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the document with the smallest id."""
    gone = near_groups(docs, id_col, text_col, k, percent).where("not kept").select(F.col("doc_id").alias("__id")).distinct()
    gone = materialize(gone, "gone")
    return join_checked(docs, gone, F.col(id_col) == F.col("__id"), "left_anti", 1_000_000).select(*docs.columns)  # ids alone: 8 MB at most
