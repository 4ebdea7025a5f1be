"""Best-fit packing of token sequences under vector capacities.

An item of s tokens needs (s tokens, 1 document, s * s attention cost). Items go, longest first, to
the open bin that meets every capacity and is best by the weighted residual norm or dot product.
Items of one size are alike, so the plan is made from the histogram of sizes: at most ``capacity``
rows, whatever the corpus. Each row of the plan sends a run of ranks of one size to a run of bins, and
the corpus follows the plan by (size, rank) without a shuffle of texts.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import materialize, running_total

from .textkernel import STEP, steps

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Words of which a worker remembers the ids; then it starts afresh.
MEMO = 600_000


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet by byte: printable Latin-1 stands for itself, all others count on from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class TokenMemo:
    """Ids of texts by ``tokenizers``, each distinct word encoded once.

    A byte-level BPE never joins across the edge before a single space that has no white space beside
    it, so a text is cut there and the pieces' ids are concatenated: the same ids as of the whole text.
    A new piece of Latin letters, with or without ASCII marks after them, is one or two pre-tokens and
    goes to the library's BPE model itself; any other goes through its whole encoder.
    """

    def __init__(self, path: str, special: bool = True):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.model = self.tok.model
        self.letters = byte_letters()
        self.rest: dict[str, bytes | None] = {}
        self.head: dict[str, bytes | None] = {}
        self.edge = re.compile(r"(?<=\S) (?=\S)")
        self.word = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*)([!-/:-@[-`{-~]*)").fullmatch
        self.marks: dict[str, bytes] = {"": b""}

    def _bpe(self, text: str) -> bytes:
        letters = text.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _learn(self, memo: dict, words: set, before: str) -> None:
        """Add ids of ``before`` + word; None for a word with white space at an edge, where no cut is allowed."""
        if len(memo) > MEMO:
            memo.clear()
        hard = []
        word, tokenize, mark_of, space = self.word, self.model.tokenize, self.marks, before and self.letters[32]
        for w in words.difference(memo):
            parts = word(w)
            if parts is None or not parts[1]:
                if not w or w[0].isspace() or w[-1].isspace():
                    memo[w] = None
                else:
                    hard.append(w)
                continue
            core, mark = parts.groups()
            ids = memo.get(core)
            if ids is None:
                # ASCII letters stand for themselves
                ids = memo[core] = array("I", [t.id for t in tokenize(space + core)]).tobytes() if core.isascii() else self._bpe(before + core)
            if mark:
                if mark not in mark_of:
                    mark_of[mark] = self._bpe(mark)
                memo[w] = ids + mark_of[mark]
        for w, e in zip(hard, self.tok.encode_batch_fast([before + w for w in hard], add_special_tokens=False), strict=True):
            memo[w] = array("I", e.ids).tobytes()

    def _whole(self, text: str) -> bytes:
        first, *more = self.edge.split(text)
        out = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tok.encode_batch([first, *(" " + w for w in more if self.rest.get(w) is None)], add_special_tokens=False)]
        odd = iter(out)
        return next(odd) + b"".join([self.rest.get(w) or next(odd) for w in more])

    def ids(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        cut = [t.split(" ") for t in texts]
        heads = [c.pop(0) for c in cut]
        self._learn(self.head, set(heads), "")
        self._learn(self.rest, set().union(*cut), " ")
        rest, out = self.rest.__getitem__, []
        for text, head, c in zip(texts, heads, cut, strict=True):
            first = self.head[head]
            try:
                ids = None if first is None else first + b"".join(map(rest, c))
            except TypeError:  # a word that is None
                ids = None
            out.append(ids if ids is not None else self._whole(text) if text else b"")
        return out


def _cut(ids: bytes, most: int):
    """(piece, start, length, crc32): pieces of ``most`` ids, the first takes what is left over."""
    n = len(ids) // 4
    at, piece = 0, 0
    while at < n:
        size = (n - at) % most or most if piece == 0 else most
        yield piece, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])
        at, piece = at + size, piece + 1


def _pieces(path: str, most: int):
    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        memo = TokenMemo(path)
        for batch in batches:
            docs, texts = batch.column(0), batch.column(1).fill_null("")
            sizes = np.zeros(len(texts) + 1, np.int64)
            np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False), out=sizes[1:])
            for a, b in steps(sizes, STEP):
                rows = []
                who = docs.slice(a, b - a).to_pylist()
                for doc, ids in zip(who, memo.ids(texts.slice(a, b - a).to_pylist()), strict=True):
                    rows += [(doc, *p) for p in _cut(ids + b"\0\0\0\0", most)]
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


@dataclass(frozen=True)
class Capacity:
    """Most of a bin, weights of the dimensions in the choice of a bin, and the rule: ``norm`` or ``dot``."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"


def best_fit_plan(histogram: dict[int, int], cap: Capacity = Capacity()) -> list[tuple[int, int, int, int, int]]:
    """Rows (size, first rank, items, first bin, offset in the bin) of a vector best-fit-decreasing packing.

    Open bins are kept by their residual vector; bins of one residual are alike and are held as runs of
    bin numbers. Once a bin takes an item of a size it stays the best for the next of that size (every
    residual has shrunk), so it is filled with as many as fit before another bin is looked at.
    """
    full = (cap.tokens, cap.documents, cap.attention)
    wt, wd, wa = cap.weights
    open_bins: list[dict[tuple[int, int], list[tuple[int, int]]]] = [{} for _ in range(cap.tokens + 1)]
    plan: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def best(s: int):
        found, score = None, None
        for r in range(s, cap.tokens + 1):
            gap = wt * ((r - s) / cap.tokens) ** 2
            if cap.rule == "norm" and score is not None and gap > score:
                break
            for d, a in open_bins[r]:
                if d < 1 or a < s * s:
                    continue
                if cap.rule == "norm":
                    x = gap + wd * ((d - 1) / cap.documents) ** 2 + wa * ((a - s * s) / cap.attention) ** 2
                else:
                    x = -(wt * s * r / cap.tokens**2 + wd * d / cap.documents**2 + wa * s * s * a / cap.attention**2)
                if score is None or x < score:
                    found, score = (r, d, a), x
        return found

    def put(r: int, d: int, a: int, lo: int, n: int) -> None:
        if r and d and a:
            open_bins[r].setdefault((d, a), []).append((lo, n))

    for s in sorted(histogram, reverse=True):
        left, rank = histogram[s], 0
        if s > cap.tokens or s * s > cap.attention or cap.documents < 1:
            raise ValueError(f"an item of {s} tokens fits in no bin")
        while left:
            state = best(s)
            r, d, a = state or full
            stack = min(r // s, d, a // (s * s))
            if state:
                runs = open_bins[r].pop((d, a))
            else:
                runs = [(bins, -(-left // stack))]
                bins += runs[0][1]
            for lo, n in runs:
                whole = min(n, left // stack)
                odd = left - whole * stack if whole < n else 0  # the last bin takes what is left
                for j in range(stack if whole else 0):
                    plan.append((s, rank, whole, lo, cap.tokens - r + j * s))
                    rank += whole
                if whole:
                    put(r - stack * s, d - stack, a - stack * s * s, lo, whole)
                left -= whole * stack
                if odd:
                    odd = min(odd, stack - 1)
                    for j in range(odd):
                        plan.append((s, rank, 1, lo + whole, cap.tokens - r + j * s))
                        rank += 1
                    put(r - odd * s, d - odd, a - odd * s * s, lo + whole, 1)
                    left -= odd
                    whole += 1
                if whole < n:
                    put(r, d, a, lo + whole, n - whole)
    return plan


def _placed(plan: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(plan), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 44) + table[:, 1]

    def run(batches):
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            rank = get("rank")
            row = table[np.searchsorted(keys, (get("length") << 44) + rank, "right") - 1]
            out = [batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", cap: Capacity = Capacity()) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and then id 0; one longer than a bin is cut into whole bins, the first piece
    taking what is left over. A null text is empty: one piece of one id. Null ids and repeated rows are
    packed as documents of their own. An empty table gives no rows.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(src.mapInArrow(_pieces(tokenizer, cap.tokens), PIECE), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most cap.tokens rows
    plan = best_fit_plan(histogram, cap)
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(1024))
    ranked = running_total(pieces, "length", bucket, ["doc_id", "piece"], F.lit(1), "rank")
    return ranked.mapInArrow(_placed(plan), PIECE + ", sequence_id long, offset long")
