"""Embedding near-dedup by cross-polytope hashing.

A hash rotates a unit vector by three rounds of random signs and a fast Hadamard transform and takes
the nearest signed axis. A table's bucket joins two such hashes; a vector is stored in its own bucket
and also looks into the next likeliest ones. Pairs that share a bucket are verified by cosine in
double precision inside blocks of bounded size. A pair counts in the first bucket where it meets, so
links are counted without a row for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.graph import connected_components
from weftline.plans.shared import materialize

#: Tables, buckets a vector looks into in each (its own first), hashes of a bucket, and rows of a block.
TABLES, PROBES, HASHES, BLOCK = 6, 4, 2, 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of the rows of ``x``; their length is a power of two."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        v = x.reshape(len(x), -1, 2, h)
        a, b = v[:, :, 0] + v[:, :, 1], v[:, :, 0] - v[:, :, 1]
        v[:, :, 0], v[:, :, 1] = a, b
        h *= 2
    return x / np.sqrt(n)


def codes(unit: np.ndarray, tables: int, probes: int, hashes: int, seed: int) -> np.ndarray:
    """Bucket numbers, shape (vectors, tables, probes); the first probe is a vector's own bucket.

    Probes are in the order of how far the vector is from changing to their axes.
    """
    n, dim = unit.shape
    d = 1 << max(0, (dim - 1).bit_length())
    x = np.zeros((n, d))
    x[:, :dim] = unit
    g = np.random.default_rng(seed + d)
    out = np.zeros((n, tables, probes), np.int64)
    m = min(d, 4)
    for t in range(tables):
        loss, code = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
        for _ in range(hashes):
            z = x
            for _ in range(3):
                z = hadamard(z * g.choice([-1.0, 1.0], d))
            mag = np.abs(z)
            axis = np.argsort(-mag, axis=1, kind="stable")[:, :m]
            far = np.take_along_axis(mag, axis, 1)
            sign = np.take_along_axis(z, axis, 1) < 0
            step = (far[:, :1] - far) ** 2
            loss = (loss[:, :, None] + step[:, None, :]).reshape(n, -1)
            code = (code[:, :, None] * (2 * d) + (2 * axis + sign)[:, None, :]).reshape(n, -1)
        pick = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        got = np.take_along_axis(code, pick, 1)
        out[:, t, : got.shape[1]] = got
        out[:, t, got.shape[1] :] = -1  # very short vectors have fewer buckets
    return out


def _hashed(tables: int, probes: int, hashes: int, seed: int):
    def run(batches):
        for batch in batches:
            vec = batch.column(1)
            lens = np.array([len(v) for v in vec], int)
            found = [None] * len(lens)
            for dim in np.unique(lens):
                at = np.flatnonzero(lens == dim)
                x = np.stack([np.asarray(vec[int(i)].values, np.float64) for i in at])
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                for i, c in zip(at, codes(x, tables, probes, hashes, seed).reshape(len(at), -1), strict=True):
                    found[i] = c
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(found, pa.list_(pa.int64()))], names=["rep", "vec", "members", "label", "codes"])

    return run


def _links(least: float, tables: int, probes: int):
    """Over rows in the order of their block: (rep, null, links of its vector) and (rep, root, null) of a spanning star."""

    def block(rep, members, vec, code, table, own, bucket, part, split):
        x = np.stack([np.frombuffer(v, np.float64) for v in vec])
        c = np.stack([np.frombuffer(v, np.int64) for v in code]).reshape(len(x), tables, probes)
        ok = x @ x.T >= least
        ok &= own[:, None] | own[None, :]
        if split:  # a block of two parts holds the pairs across them
            ok &= part[:, None] != part[None, :]
        i, j = np.nonzero(np.triu(ok, 1))
        keep = rep[i] != rep[j]
        i, j = i[keep], j[keep]
        for t in range(table):  # met in an earlier table
            met = (c[i, t, :1] == c[j, t]).any(1) | (c[j, t, :1] == c[i, t]).any(1)
            i, j = i[~met], j[~met]
        # of two buckets of this table in which they meet, the lower counts
        a, b = c[i, table, 0], c[j, table, 0]
        also = np.where(b == bucket, np.where((c[j, table] == a[:, None]).any(1), a, bucket), np.where((c[i, table] == b[:, None]).any(1), b, bucket))
        keep = also >= bucket
        i, j = i[keep], j[keep]
        if not len(i):
            return None
        n = np.bincount(i, members[j], len(x)) + np.bincount(j, members[i], len(x))
        root = np.arange(len(x))
        while True:
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            new = new[new]
            if (new == root).all():
                break
            root = new
        hit, far = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(x)))
        return np.concatenate([rep[hit], rep[far]]), [*([None] * len(hit)), *rep[root[far]].tolist()], [*n[hit].astype(int).tolist(), *([None] * len(far))]

    def run(batches):
        held = None
        out: list = []

        def done(rows: pa.Table):
            key = rows["block"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            cols = {n: rows[n].to_numpy() for n in ("rep", "members", "t", "own", "bucket", "part", "split")}
            vec, code = rows["vec"].combine_chunks(), rows["codes"].combine_chunks()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a < 2 or not cols["own"][a:b].any():
                    continue
                got = block(cols["rep"][a:b], cols["members"][a:b], vec[a:b].to_pylist(), code[a:b].to_pylist(), int(cols["t"][a]), cols["own"][a:b].astype(bool), int(cols["bucket"][a]), cols["part"][a:b], bool(cols["split"][a]))
                if got:
                    out.append(got)

        def flush():
            ids = np.concatenate([o[0] for o in out]) if out else np.zeros(0, np.int64)
            batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([v for o in out for v in o[1]], pa.int64()), pa.array([v for o in out for v in o[2]], pa.int64())], names=["rep", "root", "n"])
            out.clear()
            return batch

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            key = rows["block"].to_numpy()
            last = int(np.searchsorted(key, key[-1]))
            held = rows.slice(last)
            done(rows.slice(0, last))
            yield flush()
        if held is not None:
            done(held)
            yield flush()

    return run


def _packed(batches):
    """Unit vectors and codes as bytes."""
    for batch in batches:
        vec = [np.asarray(v.values, np.float64) for v in batch.column(1)]
        unit = [(v / np.linalg.norm(v)).tobytes() for v in vec]
        codes_ = [np.asarray(v.values, np.int64).tobytes() for v in batch.column(3)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(unit, pa.binary()), pa.array(codes_, pa.binary())], names=["rep", "members", "vec", "codes"])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = 0.93, tables: int = TABLES, probes: int = PROBES, hashes: int = HASHES, block: int = BLOCK, seed: int = 3) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Vectors of one length with equal, non-null labels are linked at a cosine of ``least`` or more. Those
    that are null, empty or zero, or hold null or non-finite components, and rows without an id, are
    linked with nothing; without an id there is no component, and the row is kept. Equal vectors are
    one class, whose members count in n_links without being paired. Rows that share an id are one node.
    A pair at the threshold is missed with a probability of about 0.0005 (six tables, four probes).
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & fine)
    classes = good.distinct().groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("members"))
    hashed = classes.select("rep", "vec", "members", F.xxhash64("label", F.size("vec")).alias("label"))
    hashed = materialize(hashed.mapInArrow(_hashed(tables, probes, hashes, seed), "rep long, vec array<double>, members long, label long, codes array<long>"), "hashed")

    at = F.posexplode("codes").alias("at", "bucket")
    keyed = hashed.select("rep", "label", at).withColumn("t", F.floor(F.col("at") / probes).cast("int")).withColumn("own", F.col("at") % probes == 0).where("bucket >= 0")
    keyed = keyed.select("rep", "t", "own", "bucket", F.xxhash64("label", "t", "bucket").alias("key"))
    busy = keyed.groupBy("key").agg(F.count("*").alias("c"), F.max("own").alias("any_own")).where("c > 1 and any_own")
    busy = materialize(busy.select("key", F.ceil(F.col("c") / block).cast("int").alias("parts")), "busy")
    met = keyed.join(busy, "key").withColumn("part", F.pmod(F.xxhash64("rep", F.lit(seed)), F.col("parts")).cast("int"))
    # a bucket over one block: each pair of its parts is a block, and each part alone
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.withColumn("split", F.col("with") != F.col("part"))
    met = met.withColumn("block", F.xxhash64("key", F.least("part", "with"), F.greatest("part", "with")))
    met = met.select("rep", "t", "own", "bucket", "part", "split", "block")
    packed = materialize(hashed.select("rep", "vec", "members", "codes").mapInArrow(_packed, "rep long, members long, vec binary, codes binary"), "packed")
    blocks = met.join(packed, "rep").repartition("block").sortWithinPartitions("block")
    found = materialize(blocks.mapInArrow(_links(least, tables, probes), "rep long, root long, n long"), "found")

    counts = found.where("n is not null").groupBy("rep").agg(F.sum("n").alias("n"))
    comp = materialize(connected_components(found.where("root is not null"), "rep", "root"), "comp").withColumnRenamed("id", "rep")
    # rows of classes that have several members or links
    known = classes.join(counts, "rep", "left").join(comp, "rep", "left").where("members > 1 or n > 0")
    known = known.select("label", "vec", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = rows.join(materialize(known, "known"), ["label", "vec"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
