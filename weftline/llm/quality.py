"""A byte-level convolutional network in numpy that scores whole documents.

Bytes are embedded and met by learned filters at every position. Responses are max-pooled over
overlapping chunks (two segments each, half shared with the next chunk), each chunk gets a logit from
a small hidden layer, and a document's logit is the mean over its chunks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernel import steps, utf8

SEGMENT, WIDTH, DIM, FILTERS, HIDDEN = 128, 8, 4, 32, 16
#: Labelled rows of each class that a fit takes, chunks of a row in one step, and passes over the rows.
ROWS_PER_CLASS, CHUNKS_PER_ROW, EPOCHS = 2000, 8, 12
CHUNK = 2 * SEGMENT + WIDTH - 1


@dataclass
class Net:
    emb: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    hid: np.ndarray
    hbias: np.ndarray
    out: np.ndarray
    obias: np.ndarray

    @classmethod
    def fresh(cls, seed: int) -> Net:
        g = np.random.default_rng(seed)
        n = lambda *s, scale: (g.standard_normal(s) * scale).astype(np.float32)
        return cls(n(256, DIM, scale=0.5), n(WIDTH * DIM, FILTERS, scale=(WIDTH * DIM) ** -0.5), np.zeros(FILTERS, np.float32), n(FILTERS, HIDDEN, scale=FILTERS**-0.5), np.zeros(HIDDEN, np.float32), n(HIDDEN, scale=HIDDEN**-0.5), np.zeros(1, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.emb, self.conv, self.bias, self.hid, self.hbias, self.out, self.obias]

    def responses(self, codes: np.ndarray) -> np.ndarray:
        """Filter responses at every window of a run of bytes: (len(codes) - WIDTH + 1, FILTERS)."""
        x = np.ascontiguousarray(self.emb[codes]).reshape(-1)
        rows = len(codes) - WIDTH + 1
        view = np.lib.stride_tricks.as_strided(x, (rows, WIDTH * DIM), (DIM * x.itemsize, x.itemsize), writeable=False)
        return np.ascontiguousarray(view) @ self.conv

    def chunk_logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(np.maximum(pooled + self.bias, 0) @ self.hid + self.hbias, 0) @ self.out + self.obias


def fit(bags: list[tuple[list[bytes], int]], epochs: int = EPOCHS, seed: int = 5, rate: float = 4e-3, least_steps: int = 800) -> Net:
    """Train on (chunks, label) rows with Adam, ``epochs`` times or more for ``least_steps`` steps; the pooled maximum passes its gradient to one window.

    A row with more than CHUNKS_PER_ROW chunks shows the next so many of them in each epoch.
    """
    epochs = max(epochs, -(-least_steps * 32 // len(bags)))
    net, g = Net.fresh(seed), np.random.default_rng(seed)
    m1, m2, t = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()], 0
    weight = np.array([0.5 / max(1, sum(y == c for _, y in bags)) for c in (0, 1)]) * len(bags)
    codes = [np.frombuffer(b"".join(c[:CHUNK].ljust(CHUNK, b"\0") for c in chunks), np.uint8).reshape(-1, CHUNK) for chunks, _ in bags]
    labels = np.array([y for _, y in bags])
    for epoch in range(epochs):
        order = g.permutation(len(bags))
        for i in range(0, len(order), 32):
            pick = order[i : i + 32]
            turn = [codes[j][(epoch * CHUNKS_PER_ROW + np.arange(min(CHUNKS_PER_ROW, len(codes[j])))) % len(codes[j])] for j in pick]
            own = np.repeat(np.arange(len(pick)), [len(c) for c in turn])
            x = np.concatenate(turn)
            n, windows = len(x), CHUNK - WIDTH + 1
            e = net.emb[x].reshape(n, -1)
            view = np.lib.stride_tricks.as_strided(e, (n, windows, WIDTH * DIM), (e.strides[0], DIM * e.itemsize, e.itemsize), writeable=False)
            z = view.reshape(-1, WIDTH * DIM) @ net.conv
            z = z.reshape(n, windows, FILTERS)
            top = z.argmax(1)
            pooled = np.take_along_axis(z, top[:, None], 1)[:, 0] + net.bias
            act = np.maximum(pooled, 0)
            h = act @ net.hid + net.hbias
            ha = np.maximum(h, 0)
            logit = ha @ net.out + net.obias
            per = np.bincount(own, minlength=len(pick))
            doc = np.bincount(own, logit, len(pick)) / per
            y = labels[pick]
            d_doc = (1 / (1 + np.exp(-doc)) - y) * weight[y] / len(pick)
            d = (d_doc / per)[own].astype(np.float32)
            dh = d[:, None] * net.out * (h > 0)
            da = (dh @ net.hid.T) * (pooled > 0)
            rows = view[np.arange(n)[:, None], top]  # n, FILTERS, WIDTH * DIM
            g_conv = np.einsum("nfk,nf->kf", rows, da, optimize=True)
            d_in = da[:, :, None] * net.conv.T[None]
            at = top[:, :, None] + np.arange(WIDTH)
            byte = np.take_along_axis(x, at.reshape(n, -1), 1).reshape(-1)
            g_emb = np.stack([np.bincount(byte, d_in.reshape(-1, DIM)[:, c], 256) for c in range(DIM)], 1)
            grads = [g_emb, g_conv, da.sum(0), act.T @ dh, dh.sum(0), ha.T @ d, d.sum(keepdims=True)]
            t += 1
            step = rate * (1 - epoch / epochs)
            for p, q, a, b in zip(net.parts(), grads, m1, m2, strict=True):
                a += 0.1 * (q - a)
                b += 0.01 * (q * q - b)
                p -= step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)
    return net


def logits(net: Net, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The logit of each whole text; texts are laid out on whole segments, so that pooling is a reshape."""
    lens = np.diff(offsets)
    segs = np.maximum(1, -(-lens // SEGMENT))
    first = np.cumsum(segs) - segs
    codes = np.zeros(int(segs.sum()) * SEGMENT + WIDTH - 1, np.uint8)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lens) + np.repeat(first * SEGMENT, lens)
    codes[place] = data
    pooled = np.empty((int(segs.sum()), FILTERS), np.float32)
    ends = first * SEGMENT + lens
    for a in range(0, len(pooled), 256):
        b = min(a + 256, len(pooled))
        z = net.responses(codes[a * SEGMENT : b * SEGMENT + WIDTH - 1]).reshape(b - a, SEGMENT, FILTERS)
        pooled[a:b] = z.max(1)
    # a text's last segment is pooled anew over its own windows: those that would reach into the next text see zeros
    for d in range(len(lens)):
        s = int(first[d] + segs[d] - 1)
        own = codes[s * SEGMENT : int(ends[d])]
        pad = np.zeros(max(1, len(own)) + WIDTH - 1, np.uint8)
        pad[: len(own)] = own
        pooled[s] = net.responses(pad).max(0)
    # windows of a full last but one segment may look into the last one, which is the same text
    chunks = np.maximum(1, segs - 1)
    doc = np.repeat(np.arange(len(lens)), chunks)
    start = np.arange(int(chunks.sum())) - np.repeat(np.cumsum(chunks) - chunks, chunks) + np.repeat(first, chunks)
    last = np.repeat(first + segs - 1, chunks)
    both = np.maximum(pooled[start], pooled[np.minimum(start + 1, last)])
    return np.bincount(doc, net.chunk_logits(both), len(lens)) / chunks


def _bags(batches):
    """(label, chunks of the text): those that scoring pools, over the whole text, dealt in an order of their own.

    A text with more than EPOCHS * CHUNKS_PER_ROW chunks gives so many: a fit shows no more of one row,
    and they are drawn evenly from all.
    """
    for batch in batches:
        out = []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = (text or "").encode()
            order = np.random.default_rng(len(raw)).permutation(max(1, -(-len(raw) // SEGMENT) - 1))[: EPOCHS * CHUNKS_PER_ROW]
            out.append((label, [raw[a : a + CHUNK] for a in (order * SEGMENT).tolist()]))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.list_(pa.binary()))], names=["label", "chunks"])


def held_out(id_col) -> F.Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(id_col.cast("string")) % 5 == 0


def training_rows(labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> tuple[DataFrame, dict[int, int]]:
    """At most ``rows`` ids of each class, by hash, none held out; and how many there are of each."""
    own = labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)")
    own = own.where(~held_out(F.col("__id"))).groupBy("__id").agg(F.max("__y").alias("__y"))
    there = {r["__y"]: r["count"] for r in own.groupBy("__y").count().collect()}
    part = lambda y: own.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(rows)
    return F.broadcast(part(0).unionByName(part(1))), there


@dataclass
class Model:
    net: Net | None
    shift: float


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS_PER_CLASS, label: str = "quality") -> Model:
    """Fit on at most ``rows`` labelled documents of each class, on chunks of their whole texts.

    The classes weigh the same in the fit; the shift gives scores the share of class 1 among all
    labelled rows. With fewer than two classes the score is that share, 0.5 if nothing is labelled.
    Null ids and labels teach nothing; an id with several labels counts as the largest.
    """
    pick, there = training_rows(labels, label, rows)
    n0, n1 = there.get(0, 0), there.get(1, 0)
    shift = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    if not (n0 and n1):
        return Model(None, shift)
    chosen = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(pick, "__id").select(F.col("__y").alias("label"), "__t", F.xxhash64("__id").alias("__h"), "__id")
    bags = chosen.mapInArrow(_sorted_bags, "h long, label int, chunks array<binary>").collect()  # at most 2 rows * 96 chunks of 263 bytes: 101 MB
    bags = sorted(((r.h, [bytes(c) for c in r.chunks], r.label) for r in bags), key=lambda r: (r[0], r[1]))
    if len({y for *_, y in bags}) < 2:
        return Model(None, shift)
    return Model(fit([(c, y) for _, c, y in bags]), shift)


def _sorted_bags(batches):
    for batch in batches:
        for out in _bags([batch.select([0, 1])]):
            yield pa.RecordBatch.from_arrays([batch.column(2), out.column(0), out.column(1)], names=["h", "label", "chunks"])


def _scores(model: Model, keep: float | None):
    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("__text"))
            data, offs = utf8(column)
            got = np.zeros(len(column))
            if model.net is not None:
                for a, b in steps(offs):
                    got[a:b] = logits(model.net, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            p = 1 / (1 + np.exp(-np.clip(got + model.shift, -60, 60)))
            if keep is None:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])
            else:
                rest = batch.select([n for n in batch.schema.names if n != "__text"])
                yield rest.filter(pa.array(p >= keep))

    return run


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted.

    Null and empty texts are scored as no bytes; repeated rows are scored alike; a null id stays null
    and so is its held_out; an empty table gives no row, and other columns are not read.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))
    out = src.mapInArrow(_scores(model, None), "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns, in one pass."""
    src = docs.withColumn("__text", F.col(text_col))
    return src.mapInArrow(_scores(model, threshold), docs.schema)
