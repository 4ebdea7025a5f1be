"""Which texts hold which items word for word, by an inverted index of each item's rarest gram.

Grams are runs of up to eight UTF-8 bytes, held exactly in 64 bits. Of each run of ``w`` grams in a
row the least (in a scrambled order) is selected, in texts as in items: so whatever holds an item also
has every gram that is selected inside the item. Each item is looked up by the one of them that the
fewest texts have, and what is found is verified on the full texts.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import join_checked, materialize

#: (least bytes of an item, bytes of a gram, grams of a window), the longest first; items under 8 bytes are grams themselves.
CLASSES = [(24, 8, 17), (8, 4, 5), *((n, n, 1) for n in range(7, 0, -1))]
#: Slots of the table that tells which grams the items have: the size of what every task gets, however many items there are.
SLOTS = 1 << 22
#: Bytes of a text that are looked at together.
PIECE = 1 << 21
U64 = np.uint64


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers."""
    x = x * U64(0x9E3779B97F4A7C15)
    x = x ^ (x >> U64(29))
    x = x * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


def selected(text: bytes, q: int, w: int) -> np.ndarray:
    """The distinct selected grams of a text, scrambled; none if it has fewer than q + w - 1 bytes."""
    out = []
    for a in range(0, max(len(text) - (q + w - 2), 0), PIECE):
        data = np.frombuffer(text, np.uint8)[a : a + PIECE + q + w - 2].astype(U64)
        n = len(data) - q + 1
        gram = data[:n].copy()
        for j in range(1, q):
            gram |= data[j : j + n] << U64(8 * j)
        least, span = scrambled(gram), 1
        while span < w:  # minima of windows, by doubling their width
            step = min(span, w - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        out.append(np.unique(least))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U64)


def slots(grams: np.ndarray, kind: int) -> np.ndarray:
    """Slot of each gram; a class has an order of its own."""
    return (scrambled(grams + U64(kind)) % U64(SLOTS)).astype(np.int64)


def _item_grams(kinds: list[int]):
    def run(batches):
        for batch in batches:
            rows = []
            for text, raw in zip(batch.column(0).to_pylist(), batch.column(0).cast(pa.binary()).to_pylist(), strict=True):
                k = next(k for k in kinds if len(raw) >= CLASSES[k][0])
                rows += [(text, k, g) for g in selected(raw, *CLASSES[k][1:]).view(np.int64).tolist()]
            text, k, g = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(k, pa.int32()), pa.array(g, pa.int64())], names=["item", "kind", "gram"])

    return run


def _slots_of(batches):
    for batch in batches:
        kinds, grams = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(U64)
        out = [slots(grams[kinds == k], int(k)) for k in np.unique(kinds)]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64))], names=["slot"])


def _table(grams: DataFrame) -> bytes:
    """One bit a slot: whether some row of ``grams`` (kind, gram) is in it."""
    held = np.zeros(SLOTS, bool)
    held[grams.select("kind", "gram").mapInArrow(_slots_of, "slot long").distinct().toArrow().column("slot").to_numpy()] = True
    return np.packbits(held).tobytes()


def _text_grams(table: bytes, kinds: list[int], counted: bool):
    """(kind, gram, n) of the texts of a task, or (kind, gram, doc_id): those whose slot an item has."""

    def run(batches):
        held, seen = np.unpackbits(np.frombuffer(table, np.uint8)).view(bool), Counter()
        for batch in batches:
            docs, rows = batch.column(1).to_pylist(), []
            for doc, raw in zip(docs, batch.column(0).cast(pa.binary()).to_pylist(), strict=True):
                for k in kinds if raw else ():
                    grams = selected(raw, *CLASSES[k][1:])
                    found = grams[held[slots(grams, k)]].view(np.int64).tolist()
                    if counted:
                        seen.update((k, g) for g in found)
                    else:
                        rows += [(k, g, doc) for g in found]
            if counted and len(seen) > 500_000:
                rows = [(k, g, n) for (k, g), n in seen.items()]
                seen = Counter()
            if rows:
                yield _batch(rows)
        if seen:
            yield _batch([(k, g, n) for (k, g), n in seen.items()])

    def _batch(rows):
        k, g, v = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(g, pa.int64()), pa.array(v, pa.int64())], names=["kind", "gram", "n" if counted else "doc_id"])

    return run


def containing(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): the documents (doc_id, text) whose text holds an item's (item_id, text) as it is.

    Null and empty items are in none, null texts hold none; a row that repeats an id and its text gives
    its own rows. Items are never collected: tasks get a bit table of fixed size. Two scans of the
    texts: one counts the grams that items have, one lists where the chosen grams are. Texts move only
    to verify candidates. Items that share their rarest gram with many texts are verified one by one.
    """
    some = items.where("text <> ''").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item"))
    texts = materialize(some.select("item").distinct(), "items")
    least = F.lit(len(CLASSES) - 1)
    for k in range(len(CLASSES) - 2, -1, -1):
        least = F.when(F.octet_length("item") >= CLASSES[k][0], F.lit(k)).otherwise(least)
    kinds = sorted(r["k"] for r in texts.select(least.alias("k")).distinct().collect())  # at most one row a class
    grams = materialize(texts.mapInArrow(_item_grams(kinds), "item string, kind int, gram long"), "itemgrams")
    pairs = docs.select(F.col("text"), F.col("doc_id").cast("long").alias("doc_id")).where("text is not null")
    counts = pairs.mapInArrow(_text_grams(_table(grams), kinds, True), "kind int, gram long, n long").groupBy("kind", "gram").agg(F.sum("n").alias("n"))
    # A gram that no text has rules its item out at once; the inner join drops that gram, so all grams of an item must be there.
    met = grams.join(counts, ["kind", "gram"], "left").groupBy("item").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "kind", "gram")).alias("r"))
    chosen = materialize(met.where("r.n > 0").select("item", "r.kind", "r.gram"), "chosen")
    hits = pairs.mapInArrow(_text_grams(_table(chosen), kinds, False), "kind int, gram long, doc_id long")
    found = join_checked(hits, chosen, ["kind", "gram"], "inner").select(F.col("doc_id").alias("__doc"), "item").distinct()
    found = materialize(found, "candidates")
    held = join_checked(pairs, found, F.col("doc_id").eqNullSafe(F.col("__doc")), "inner").where(F.contains("text", "item"))
    return held.select("doc_id", "item").join(some, "item").select("doc_id", "item_id")
