"""Embedding whitening from an exact integer scatter matrix.

Vectors become integers, x = floor(scale * c) + offset. The fit list is each distinct x once. Tasks
subtract a shift, multiply limbs of 20 bits in blocks small enough for doubles to be exact, and send
sums and cross-products as digits to base 2^40, which Spark adds up cell by cell. The driver gets one
cell for each pair of dimensions, forms n * XtX - S * St in whole numbers of any size, and only then
converts to doubles and decomposes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import materialize

#: Bits of a limb and rows of a block: 2^13 products below 2^40 each add up below 2^53.
LIMB, BLOCK = 20, 1 << 13
#: Bits and number of the digits that hold a sum on its way to the driver; the last one carries the sign.
DIGIT, DIGITS = 40, 5
#: Whole numbers that no cell of an embedding can leave.
_LOW, _HIGH = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """Fit of vectors with one length: their number, whole sums, eigenvalues (falling), unit components in rows and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0


def whole(rows: np.ndarray, scale: float, offset: int) -> np.ndarray:
    """floor(scale * c) + offset as int64; what lies outside becomes the nearest long."""
    grown = np.floor(rows * scale)
    out = np.where(grown >= 2.0**63, _HIGH, np.where(grown <= -(2.0**63), _LOW, np.clip(grown, -(2.0**63), 2.0**63 - 1024).astype(np.int64)))
    if not offset:
        return out
    return np.where(out > _HIGH - offset, _HIGH, out + offset) if offset > 0 else np.where(out < _LOW - offset, _LOW, out + offset)


def packed_row(x: np.ndarray) -> bytes:
    """One byte for the width, then the entries at the smallest width of 1, 2, 4 or 8 bytes that holds them all."""
    lo, hi = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= lo and hi < 1 << 8 * w - 1)
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    """Packed rows of one length as a matrix of int64."""
    return np.stack([np.frombuffer(r, f"<i{r[0]}", offset=1).astype(np.int64) for r in rows])


def _coded(scale: float, offset: int):
    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            good = np.flatnonzero(~vectors.is_null().to_numpy(zero_copy_only=False))
            kept = vectors.take(pa.array(good))
            flat, sizes = kept.flatten(), kept.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is NaN here
            at = np.concatenate(([0], np.cumsum(sizes)))
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            fine = np.flatnonzero(bad[at[1:]] == bad[at[:-1]])
            x = whole(np.where(np.isfinite(values), values, 0.0), scale, offset)
            coded = [packed_row(x[at[i] : at[i + 1]]) for i in fine.tolist()]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(good[fine])), pa.array(sizes[fine], pa.int32()), pa.array(coded, pa.binary())], names=["vec_id", "dim", "x"])

    return run


def coded(vectors: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """(vec_id, dim, x) of the vectors whose entries are all there and finite."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return src.mapInArrow(_coded(scale, offset), "vec_id long, dim int, x binary")


def _limbs(x: np.ndarray, shift: np.ndarray) -> list[np.ndarray]:
    """x - shift as limbs to base 2^20, each within 2^20 of zero, lowest first."""
    if len(x) and max(abs(int(x.min())), abs(int(x.max())), *(abs(int(s)) for s in shift)) < 1 << LIMB - 1:
        return [(x - shift).astype(np.float64)]
    mask, out = (1 << LIMB) - 1, []
    for k in range(3):
        out.append(((x >> LIMB * k & mask) - (shift >> LIMB * k & mask)).astype(np.float64))
    return [*out, ((x >> LIMB * 3) - (shift >> LIMB * 3)).astype(np.float64)]


def scatter(x: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of x - shift, as Python integers."""
    d = x.shape[1]
    sums, cross = np.zeros(d, object), np.zeros((d, d), object)
    for a in range(0, len(x), BLOCK):
        limbs = _limbs(x[a : a + BLOCK], shift)
        for i, p in enumerate(limbs):
            sums += p.sum(axis=0).astype(np.int64).astype(object) * (1 << LIMB * i)
            for j, q in enumerate(limbs):
                cross += (p.T @ q).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return sums, cross


def _digits(values: list[int]) -> list[np.ndarray]:
    """Digits to base 2^40, lowest first; the last keeps the sign."""
    mask = (1 << DIGIT) - 1
    return [np.array([v >> DIGIT * k & mask if k < DIGITS - 1 else v >> DIGIT * k for v in values], np.int64) for k in range(DIGITS)]


def _scattered(shifts: dict[int, bytes]):
    def run(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims, rows = batch.column(0).to_numpy(), batch.column(1)
            for d in np.unique(dims).tolist():
                shift = unpacked([shifts[d]])[0]
                mine = rows.take(pa.array(np.flatnonzero(dims == d)))
                for a in range(0, len(mine), BLOCK):
                    s, c = scatter(unpacked(mine.slice(a, BLOCK).to_pylist()), shift)
                    held[d] = (held[d][0] + s, held[d][1] + c) if d in held else (s, c)
        for d, (s, c) in held.items():
            i, j = np.triu_indices(d)
            for at in range(0, d + len(i), 1 << 16):  # the sums are cells (-1, j), then the upper triangle
                ij = np.stack([np.concatenate((np.full(d, -1), i)), np.concatenate((np.arange(d), j))])[:, at : at + (1 << 16)]
                cells = [*s.tolist(), *c[i, j].tolist()][at : at + (1 << 16)]
                cols = [pa.array(np.full(len(cells), d), pa.int32()), pa.array(ij[0], pa.int32()), pa.array(ij[1], pa.int32()), *map(pa.array, _digits(cells))]
                yield pa.RecordBatch.from_arrays(cols, names=["dim", "i", "j", *(f"d{k}" for k in range(DIGITS))])

    return run


def decomposed(n: int, shift: list[int], sums: list[int], cross: dict[tuple[int, int], int], top: int) -> Whitening:
    """Components from exact sums and cross-products of x - shift; the scatter n * XtX - S * St is the same for any shift."""
    d = len(shift)
    whole_scatter = [[n * cross[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    v = np.array([[c / (n * n) for c in row] for row in whole_scatter])  # a quotient of integers is rounded once
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:top]
    comps = vectors[:, order].T
    comps = comps * np.where(np.take_along_axis(comps, np.abs(comps).argmax(axis=1)[:, None], 1) < 0, -1.0, 1.0)
    trace = sum(whole_scatter[i][i] for i in range(d)) / (n * n)
    values = np.where(values[order] > d * np.finfo(float).eps * max(values[-1], 0.0), values[order], 0.0)  # below: no variance but rounding
    return Whitening(n, [s + n * k for s, k in zip(sums, shift, strict=True)], values, comps, trace)


def _projected(x: np.ndarray, fit: Whitening) -> tuple[list[int], np.ndarray]:
    """(sum of (n * x - S)^2, whitened values) of each row; NaN along components without variance."""
    most = max([abs(int(x.min())), abs(int(x.max()))]) if x.size else 0
    far = fit.n * most + max(map(abs, fit.sums), default=0)
    exact = (np.int64, x) if far * far * x.shape[1] < 2**63 else (object, x.astype(object))
    gap = exact[1] * fit.n - np.array(fit.sums, exact[0])
    squares = (gap * gap).sum(axis=1).tolist()
    centred = (gap / fit.n).astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        return squares, np.where(fit.values > 0, centred @ fit.components.T / np.sqrt(fit.values), np.nan)


def _whitened(fits: dict[int, Whitening]):
    """Wide rows over the fit list: the whitened values, null where there are none."""

    def run(batches):
        for batch in batches:
            dims, rows = batch.column(0).to_numpy(), batch.column(1)
            for d in np.unique(dims).tolist():
                mine = rows.take(pa.array(np.flatnonzero(dims == d)))
                for a in range(0, len(mine), BLOCK):
                    w = _projected(unpacked(mine.slice(a, BLOCK).to_pylist()), fits[d])[1]
                    cols = [pa.array(w[:, k], from_pandas=True) for k in range(w.shape[1])]
                    cols += [pa.nulls(len(w), pa.float64())] * (max(len(f.values) for f in fits.values()) - len(cols))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), d), pa.int32()), *cols], names=["dim", *(f"w{k}" for k in range(len(cols)))])

    return run


def _rows(fits: dict[int, Whitening]):
    """Long rows of the result: one a vector and component."""

    def run(batches):
        for batch in batches:
            ids, dims, rows = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
            for d in np.unique(dims).tolist():
                fit, at = fits[d], np.flatnonzero(dims == d)
                for a in range(0, len(at), BLOCK):
                    here = pa.array(at[a : a + BLOCK])
                    squares, w = _projected(unpacked(rows.take(here).to_pylist()), fit)
                    m, k = w.shape
                    explained = fit.values / fit.trace if fit.trace > 0 else np.zeros(k)
                    long = np.repeat(np.arange(m), k)
                    cols = [
                        ids.take(here).take(pa.array(long)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, fit.n)),
                        pa.array([q if q <= _HIGH else None for q in squares], pa.int64()).take(pa.array(long)), pa.array([str(q) for q in squares]).take(pa.array(long)),
                        pa.array(w.reshape(-1), from_pandas=True), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, fit.identity_error)),
                    ]
                    yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "deviation_digits", "whitened", "explained", "identity_error"])

    return run


def fit_whitening(rows: DataFrame, top: int) -> dict[int, Whitening]:
    """A fit for each length of the packed vectors ``rows`` (dim, x).

    The driver receives, for each length, one vector as the shift, d * (d + 3) / 2 cells and the
    covariances of ``top`` components: made for lengths up to a few thousand, and few of them.
    """
    # A packed vector is its own key, so equal ones meet map-side first, however many there are.
    fit_list = materialize(rows.where("dim > 0").select("dim", "x").distinct(), "fitlist")
    lengths = {r["dim"]: r for r in fit_list.groupBy("dim").agg(F.count("*").alias("n"), F.min("x").alias("x")).collect()}
    if not lengths:
        return {}
    shifts = {d: bytes(r["x"]) for d, r in lengths.items()}
    names = [f"d{k}" for k in range(DIGITS)]
    cells = fit_list.mapInArrow(_scattered(shifts), "dim int, i int, j int, " + ", ".join(f"{c} long" for c in names))
    cells = cells.groupBy("dim", "i", "j").agg(*(F.sum(c).alias(c) for c in names)).toArrow().to_pydict()
    totals: dict[int, dict[tuple[int, int], int]] = {d: {} for d in lengths}
    for d, i, j, *digits in zip(*(cells[c] for c in ("dim", "i", "j", *names)), strict=True):
        totals[d][i, j] = sum(v << DIGIT * k for k, v in enumerate(digits))
    fits = {d: decomposed(r["n"], unpacked([shifts[d]])[0].tolist(), [totals[d][-1, j] for j in range(d)], totals[d], top) for d, r in lengths.items()}

    wide = max(len(f.values) for f in fits.values())
    pairs = [(i, j) for i in range(wide) for j in range(i, wide)]
    white = fit_list.mapInArrow(_whitened(fits), "dim int, " + ", ".join(f"w{k} double" for k in range(wide)))
    measured = white.groupBy("dim").agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).collect()
    error = {r["dim"]: max((abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None), default=0.0) for r in measured}
    return {d: Whitening(f.n, f.sums, f.values, f.components, f.trace, error.get(d, 0.0)) for d, f in fits.items()}


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, offset: int = 0, top: int = 4) -> DataFrame:
    """One row a vector and component: vec_id, component, n, deviation, deviation_digits, whitened, explained, identity_error.

    Vectors that are null or hold a null or non-finite entry are left out, and so are empty ones, which
    have no component. Vectors of another length have a fit of their own. Repeated rows each get their
    rows but count once in the fit; null ids are kept. ``deviation`` is null beyond the longs, where
    ``deviation_digits`` still has it. A component without variance (one distinct vector, constant or
    dependent dimensions) has ``whitened`` null and ``explained`` 0. An entry beyond the longs counts as
    the nearest long. An empty table gives no rows; other columns are not read.
    """
    rows = coded(vectors, id_col, vector_col, scale, offset)
    fits = fit_whitening(rows, top)
    kinds = "vec_id long, component int, n long, deviation long, deviation_digits string, whitened double, explained double, identity_error double"
    return rows.where("dim > 0").mapInArrow(_rows(fits), kinds)
