"""Toxic passages by maximum-scoring segments over token log-odds.

A token weighs its log-odds between toxic and clean documents, both rates shrunk by a Dirichlet prior
to the rate in all of them, and taken at the confidence bound next to zero: above it for words of toxic
texts, below it for words of clean ones. Tokens whose sign is open, or that are new, cost a small drift.
A linear scan finds all maximal-scoring segments of a text; a segment of score s among n words is
expected K n exp(-lambda s) times by chance (the extreme-value law of such maxima), and a document
adds up -ln of that over its significant segments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import materialize, release

from .quality import held_out, training_rows
from .textkernel import LOWER, U64, _pow_table, mix, steps, utf8

#: Labelled rows of each class that a fit takes; rows of the Dirichlet prior to one training row.
ROWS_PER_CLASS, PRIOR = 20_000, 0.09
DRIFT, LEAST_ROWS, BOUND = 0.1, 3, 2.0
#: A word also stands for its first so many bytes.
STEMS = (5, 6, 7, 8)

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of words (runs of ASCII letters and non-ASCII bytes, A-Z in lower case) and of their stems; each text's first word."""
    if not len(data):
        return [np.zeros(0, U64)] * (1 + len(STEMS)), np.zeros(len(offsets), np.int64)
    inside = LETTER[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    at = np.searchsorted(starts, offsets).astype(np.int64)
    if not len(starts):
        return [np.zeros(0, U64)] * (1 + len(STEMS)), at
    lens = np.add.reduceat(inside.view(np.uint8), starts, dtype=np.int64)
    heads = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(heads, lens)
    value = (LOWER[data[inside]].astype(U64) + U64(1)) * _pow_table(int(lens.max()))[place]
    total = np.cumsum(value, dtype=U64)
    before = total[heads] - value[heads]
    out = [mix(total[heads + lens - 1] - before)]
    for k in STEMS:
        stem = total[heads + np.minimum(lens, k) - 1] - before
        out.append(np.where(lens > k, mix(stem + U64(k << 8)), out[0]))
    return out, at


@dataclass
class Weights:
    """Sorted token hashes with the toxic and clean training rows that hold them, and all rows of each class."""

    keys: np.ndarray
    toxic: np.ndarray
    clean: np.ndarray
    rows: tuple[int, int]
    scale: tuple[float, float] = (1.0, 1e-4)  # lambda, K
    curve: tuple[float, float] = (-2.0, 1.0)
    table: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def log_odds(self, toxic, clean, rows) -> np.ndarray:
        """The log-odds moved BOUND standard deviations towards zero; the drift where that crosses it."""
        t, c = np.asarray(toxic, float), np.asarray(clean, float)
        n1, n0 = rows
        prior = PRIOR * sum(self.rows)
        share = np.maximum(t + c, 1e-9) / (n1 + n0)
        a, b = t + prior * share, c + prior * share
        gap = np.log(a / (n1 + prior)) - np.log(b / (n0 + prior))
        slack = BOUND * np.sqrt(1 / a + 1 / b)
        return np.where(gap > slack, gap - slack, np.minimum(gap + slack, -DRIFT))

    def scores(self, hashed: list[np.ndarray], own: int | None = None) -> np.ndarray:
        """Score of each word: its token's, or a toxic stem's if that is more and the token does not speak against it. own: the class of a training text, whose own count is left out."""
        best = np.full(len(hashed[0]), -DRIFT)
        if not len(self.keys):
            return best
        for k, h in enumerate(hashed):
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == h)
            if own is None:
                value = self.table[at[hit]]
            else:
                t, c = self.toxic[at[hit]] - (own == 1), self.clean[at[hit]] - (own == 0)
                value = self.log_odds(np.maximum(t, 0), np.maximum(c, 0), (self.rows[0] - (own == 1), self.rows[1] - (own == 0)))
                value = np.where((value > 0) & (t < LEAST_ROWS), -DRIFT, value)
            best[hit] = value if k == 0 else np.where(best[hit] >= -DRIFT, np.maximum(best[hit], value), best[hit])
        return best

    def finish(self) -> None:
        self.table = self.log_odds(self.toxic, self.clean, self.rows)

    def evidence(self, segments: np.ndarray, n: int) -> float:
        """The sum of -ln of the expected number of chance segments, over segments where that is under 1."""
        lam, k = self.scale
        return float(np.maximum(0.0, lam * segments - np.log(max(k * max(n, 1), 1e-12))).sum())


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a sequence, left to right, in linear time.

    The scan keeps candidates with the running totals before and after each. A new positive run is put
    behind the latest candidate that began at a lower total; if that one ended at a lower total too,
    the two and all between become one, which is tried again; else the run stands as a candidate.
    """
    hits = np.flatnonzero(scores > 0)
    if not len(hits):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    parts = np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1)
    held: list[list] = []  # first, end, total before, total after, index of the latest candidate begun lower
    for part in parts:
        a, b = int(part[0]), int(part[-1]) + 1
        new = [a, b, float(total[a]), float(total[b]), -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            if j < 0 or held[j][3] >= new[3]:
                new[4] = j
                held.append(new)
                break
            new = [held[j][0], new[1], held[j][2], new[3], -1]
            del held[j:]
    return [(a, b, hi - lo) for a, b, lo, hi, _ in held]


def _counts(batches):
    """Per task: token hash, toxic rows and clean rows that hold it."""
    keys, toxic, clean = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def fold(found):
        nonlocal keys, toxic, clean
        k = np.concatenate([keys] + [f[0] for f in found])
        t = np.concatenate([toxic] + [f[1] for f in found])
        c = np.concatenate([clean] + [f[2] for f in found])
        keys, where = np.unique(k, return_inverse=True)
        toxic, clean = np.bincount(where, t, len(keys)).astype(np.int64), np.bincount(where, c, len(keys)).astype(np.int64)

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(toxic), pa.array(clean)], names=["h", "toxic", "clean"])

    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False)
        data, offs = utf8(batch.column(1))
        for a, b in steps(offs):
            hashed, at = tokens(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            found = []
            for i in range(b - a):
                u = np.unique(np.concatenate([h[at[i] : at[i + 1]] for h in hashed]))
                found.append((u, np.full(len(u), int(y[a + i] == 1)), np.full(len(u), int(y[a + i] == 0))))
            fold(found)
            if len(keys) > 500_000:  # bounded memory: a task may send a token more than once
                yield flush()
                keys, toxic, clean = keys[:0], toxic[:0], clean[:0]
    if len(keys):
        yield flush()


def _evidence(w: Weights):
    def run(batches):
        for batch in batches:
            y = batch.column(0).to_pylist()
            data, offs = utf8(batch.column(1))
            out = []
            for a, b in steps(offs):
                hashed, at = tokens(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                for i in range(b - a):
                    own = w.scores([h[at[i] : at[i + 1]] for h in hashed], y[a + i])
                    out.append((y[a + i], int(at[i + 1] - at[i]), [s for *_, s in maximal_segments(own)]))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.float64()))], names=["y", "n", "segments"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", rows: int = ROWS_PER_CLASS) -> tuple[Weights | None, float]:
    """Fit on at most ``rows`` labelled documents of each class, whole texts; and the share of class 1.

    Token counts are summed over tasks; every token whose bound has a clear sign comes to the driver:
    toxic ones are in LEAST_ROWS toxic rows or more, and a clean one has to be in some dozens of clean
    rows, so their number is bounded by the tokens of the chosen rows. lambda and K are fitted to the
    segments of clean training texts (their own counts left out), the final curve to one number of each
    training text. With under two classes, or without labelled documents, there is no model and every
    text scores the share of class 1. Null ids and labels teach nothing; an id with several labels
    counts as the largest, and documents that repeat an id count each.
    """
    pick, there = training_rows(labels, label, rows)
    n0, n1 = there.get(0, 0), there.get(1, 0)
    share = (n1 + 0.5) / (n0 + n1 + 1.0)
    if not (n0 and n1):
        return None, share
    chosen = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("t")).join(pick, "__id").select(F.col("__y").alias("y"), "t")
    k1, k0 = min(n1, rows), min(n0, rows)
    counts = chosen.mapInArrow(_counts, "h long, toxic long, clean long").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    prior = PRIOR * (k1 + k0)
    a, b = (F.col(c) + prior / (k1 + k0) * (F.col("toxic") + F.col("clean")) for c in ("toxic", "clean"))
    gap, slack = F.log(a / (k1 + prior)) - F.log(b / (k0 + prior)), BOUND * F.sqrt(1 / a + 1 / b)
    got = counts.where(((gap > slack) & (F.col("toxic") >= LEAST_ROWS)) | (gap + slack < -DRIFT)).toArrow()
    keys = got["h"].to_numpy().view(U64)
    order = np.argsort(keys)
    w = Weights(keys[order], got["toxic"].to_numpy()[order].astype(float), got["clean"].to_numpy()[order].astype(float), (k1, k0))
    w.finish()
    seen = materialize(chosen.mapInArrow(_evidence(w), "y int, n long, segments array<double>"), "segments")
    calibrate(w, seen, share)
    release(seen)
    return w, share


def calibrate(w: Weights, seen: DataFrame, share: float) -> None:
    """Fit the extreme-value law to clean texts and the logistic curve to all; ``seen`` has y, n and segments of each."""
    total = F.aggregate("segments", F.lit(0.0), lambda a, s: a + s)
    found, amount, length = seen.where("y = 0").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in (F.size("segments"), total, F.col("n")))).first()
    lam = float(f"{1.0 / max(amount / found, 0.2) if found else 1.0:.9g}")  # whatever the order of the sum
    w.scale = (lam, (found + 0.5) / max(1, length))
    chance = float(np.log(w.scale[1])) + F.log(F.greatest("n", F.lit(1)))
    evidence = F.aggregate("segments", F.lit(0.0), lambda a, s: a + F.greatest(F.lit(0.0), lam * s - chance))
    rows = seen.select("y", F.log1p(evidence).alias("x")).orderBy("y", "x").toArrow()  # two numbers a training row
    x, y = rows["x"].to_numpy(), rows["y"].to_numpy().astype(float)
    n1, n0 = max(1.0, y.sum()), max(1.0, len(y) - y.sum())
    weight = np.where(y == 1, share / n1, (1 - share) / n0) * len(y)
    a, b = -2.0, 1.0
    for _ in range(50):  # Newton steps of a logistic fit with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -40, 40)))
        r, v = weight * (y - p), weight * p * (1 - p)
        grad = np.array([r.sum() - 0.01 * a, (r * x).sum() - 0.01 * b])
        hess = np.array([[v.sum() + 0.01, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 0.01]])
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a + step[0], max(0.0, b + step[1])  # more evidence never lowers a score
    w.curve = (float(a), float(b))


def _scored(w: Weights | None, share: float):
    def run(batches):
        for batch in batches:
            data, offs = utf8(batch.column(1))
            p, spans = np.full(len(offs) - 1, share), []
            for a, b in steps(offs):
                if w is None:
                    spans += [[]] * (b - a)
                    continue
                hashed, at = tokens(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                score = w.scores(hashed)
                hit = np.searchsorted(np.flatnonzero(score > 0), at)
                for i in range(b - a):
                    n = int(at[i + 1] - at[i])
                    found = maximal_segments(score[at[i] : at[i + 1]]) if hit[i + 1] > hit[i] else []
                    x = np.log1p(w.evidence(np.array([s for *_, s in found]), n)) if found else 0.0
                    p[a + i] = 1 / (1 + np.exp(-np.clip(w.curve[0] + w.curve[1] * x, -40, 40)))
                    lam, k = w.scale
                    spans.append([{"first": f, "end": e, "score": s} for f, e, s in found if lam * s > np.log(max(k * n, 1e-12))])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(spans, kind)], names=["doc_id", "score", "passages"])

    return run


def scored(docs: DataFrame, model: tuple[Weights | None, float], id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted, passages (first word, end word, score of each significant one).

    Null and empty texts have no passage and score as such; rows that repeat are scored alike; a null
    id stays null and so is its held_out; an empty table gives no row, and other columns are not read.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    out = src.mapInArrow(_scored(*model), "doc_id long, score double, passages array<struct<first:long,end:long,score:double>>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")
