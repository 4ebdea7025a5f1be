"""Vectorised kernels over the UTF-8 buffers of Arrow string columns.

Words are the runs of bytes other than 0x20 and 0x09-0x0D. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text that one step of a kernel takes (a longer text is one step of its own).
STEP = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers (xor-shift and multiply)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, U64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_POW = powers(256)


def _pow_table(n: int) -> np.ndarray:
    global _POW
    if n > len(_POW):
        _POW = powers(max(n, 2 * len(_POW)))
    return _POW


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes together, one text at least."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, index of each text's first word, byte at which each word starts)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64), z
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    at = np.searchsorted(starts, offsets).astype(np.int64)
    if not len(starts):
        return np.zeros(0, U64), at, starts
    lens = np.add.reduceat(inside.view(np.uint8), starts, dtype=np.int64)
    letters = data[inside]
    if lower:
        letters = LOWER[letters]
    heads = np.cumsum(lens) - lens
    place = np.arange(len(letters), dtype=np.int64) - np.repeat(heads, lens)
    value = (letters.astype(U64) + U64(1)) * _pow_table(int(lens.max()))[place]
    return mix(np.add.reduceat(value, heads) + lens.astype(U64)), at, starts


def shingles(word: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``k`` words; of a shorter text, its whole sequence as one."""
    n = len(word)
    if n >= k:
        roll = np.zeros(n - k + 1, U64)
        for j in range(k):
            roll = mix(roll * U64(_BASE) + word[j : n - k + 1 + j])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(roll[a : b - k + 1]))
        elif b > a:
            whole = np.full(1, b - a, U64)
            for j in range(a, b):
                whole = mix(whole * U64(_BASE) + word[j : j + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, U64))
    return out


def list_array(parts: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.ListArray:
    """An Arrow list column from one 64-bit array a row."""
    offs = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offs[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat.view(np.int64) if flat.dtype == U64 else flat, kind))
