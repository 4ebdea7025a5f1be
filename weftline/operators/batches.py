"""Greedy micro-batches under a budget, as walks along a successor graph.

A batch that starts at a row ends at a row that only the next few rows decide, so each row has one
successor: the first row of the next batch. The rows of an owner are cut into chunks of fixed size. A
batch can reach into the next chunk by less than ``most`` rows, so a chunk is a function from the
place where a walk enters it to the place where it enters the next chunk, and the batches on the way.
Functions of neighbours are composed by doubling, which tells each chunk where the walk from the
owner's first row enters it, and then every chunk is walked on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.shared import join_checked, materialize, ranged_total

#: Rows of a chunk.
CHUNK = 1 << 16


def successors(w: np.ndarray, n: int, most: int, budget: int) -> np.ndarray:
    """For each of the first ``n`` rows where the next batch starts if one starts there; ``w`` goes on with rows of the next chunk."""
    out = np.minimum(np.arange(n) + most, len(w))
    wide, open_ = w[:n].copy(), np.ones(n, bool)
    for s in range(1, most):
        here = np.arange(n) + s
        there = here < len(w)
        wide = np.where(there, np.maximum(wide, w[np.minimum(here, len(w) - 1)]), wide)
        full = open_ & there & ((s + 1) * wide > budget)
        out[full] = here[full]
        open_ &= ~full
        if not open_.any():
            break
    return out


def _sorted(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    pos, w = (table.column(c).to_numpy() for c in ("__pos", "__w"))
    order = np.argsort(pos, kind="stable")
    return pos[order], w[order]


def _ways(owner: str, most: int, budget: int, chunk: int):
    """(owner, chunk, entry, to, exit, n) for every place at which a walk can enter the chunk."""

    def run(table: pa.Table) -> pa.Table:
        pos, w = _sorted(table)
        c = int(table.column("__chunk")[0].as_py())
        n = int((pos < (c + 1) * chunk).sum())
        after = successors(w, n, most, budget).tolist()
        leaves, batches = [0] * (n + 1), [0] * (n + 1)  # a walk that enters behind the last row starts no batch
        for i in range(n - 1, -1, -1):
            inside = after[i] < n
            leaves[i] = leaves[after[i]] if inside else max(after[i] - chunk, 0)
            batches[i] = 1 + (batches[after[i]] if inside else 0)
        m = min(most, n + 1)
        key = table.column(owner).slice(0, 1).combine_chunks().take(pa.array([0] * m))
        cols = [key, pa.array([c] * m), pa.array(range(m), pa.int32()), pa.array([c + 1] * m), pa.array(leaves[:m], pa.int32()), pa.array(batches[:m], pa.int64())]
        return pa.Table.from_arrays(cols, names=[owner, "__chunk", "entry", "to", "exit", "n"])

    return run


def _walked(owner: str, most: int, budget: int, chunk: int):
    """The batches, or parts of them, in a chunk that a walk enters at ``entry`` after ``before`` batches."""

    def run(rows: pa.Table, entered: pa.Table) -> pa.Table:
        names = [owner, "batch", "n", "width"]
        if not rows.num_rows or not entered.num_rows:
            return pa.Table.from_arrays([rows.column(owner).slice(0, 0), *(pa.array([], pa.int64()) for _ in range(3))], names=names)
        pos, w = _sorted(rows)
        c, at, before = (int(t.column(x)[0].as_py()) for t, x in ((rows, "__chunk"), (entered, "entry"), (entered, "before")))
        n = int((pos < (c + 1) * chunk).sum())
        after = successors(w, n, most, budget).tolist()
        starts = [0] if at > 0 else []  # rows ahead of the entry end the batch before
        first = before - len(starts)
        while at < n:
            starts.append(at)
            at = after[at]
        ends = np.array([*starts[1:], n])
        cols = [rows.column(owner).slice(0, 1).combine_chunks().take(pa.array([0] * len(starts))), pa.array(first + np.arange(len(starts))), pa.array(ends - np.array(starts)), pa.array(np.maximum.reduceat(w[:n], starts))]
        return pa.Table.from_arrays(cols, names=names)

    return run


def micro_batches(df: DataFrame, owner: str, id_col: str, length: str, most: int, budget: int, chunk: int = CHUNK) -> DataFrame:
    """One row a batch: (owner, batch, n, width). Rows in the order of id join a batch while it has under ``most`` rows and (n + 1) * widest <= budget.

    A batch takes its first row whatever its length. Null lengths count as 0, null is an owner, rows of
    one id go by length. No task holds more of an owner than a chunk and ``most`` rows.
    """
    if most < 1 or chunk < most:
        raise ValueError("a batch has one row at least and a chunk as many rows as a batch")
    key = f"`{owner}` {df.schema[owner].dataType.simpleString()}"
    rows = df.select(owner, F.col(id_col).alias("__id"), F.coalesce(F.col(length).cast("long"), F.lit(0)).alias("__w"))
    rows = ranged_total(rows, owner, ["__id", "__w"], F.lit(1), "__pos")
    c = F.floor(F.col("__pos") / chunk)
    seen = F.when((F.col("__pos") % chunk < most) & (c > 0), F.array(c, c - 1)).otherwise(F.array(c))  # a chunk sees the rows that its last batch may take
    rows = materialize(rows.select(owner, "__pos", "__w", F.explode(seen).alias("__chunk")), "lengths")
    ways = rows.groupBy(owner, "__chunk").applyInArrow(_ways(owner, most, budget, chunk), f"{key}, __chunk long, entry int, to long, exit int, n long")
    jumps = [materialize(ways, "ways")]
    last = jumps[0].agg(F.coalesce(F.max("__chunk"), F.lit(0))).first()[0]
    for _ in range(1, int(last).bit_length()):
        a, b = jumps[-1], jumps[-1].select(F.col(owner).alias("__o"), F.col("__chunk").alias("__c"), F.col("entry").alias("__e"), F.col("to").alias("__to"), F.col("exit").alias("__x"), F.col("n").alias("__n"))
        on = F.col(owner).eqNullSafe(F.col("__o")) & (F.col("to") == F.col("__c")) & (F.col("exit") == F.col("__e"))
        jumps.append(materialize(join_checked(a, b, on, "inner").select(owner, "__chunk", "entry", F.col("__to").alias("to"), F.col("__x").alias("exit"), (F.col("n") + F.col("__n")).alias("n")), "ways"))
    entered = jumps[0].where("__chunk = 0 and entry = 0").select(owner, "__chunk", "entry", F.lit(0).cast("long").alias("before"))
    for jump in reversed(jumps if last else []):
        far = jump.select(F.col(owner).alias("__o"), F.col("__chunk").alias("__c"), F.col("entry").alias("__e"), "to", "exit", "n")
        on = F.col(owner).eqNullSafe(F.col("__o")) & (F.col("__chunk") == F.col("__c")) & (F.col("entry") == F.col("__e"))
        moved = join_checked(entered, far, on, "inner").select(owner, F.col("to").alias("__chunk"), F.col("exit").alias("entry"), (F.col("before") + F.col("n")).alias("before"))
        entered = materialize(entered.unionByName(moved), "entered")
    parts = rows.groupBy(owner, "__chunk").cogroup(entered.groupBy(owner, "__chunk")).applyInArrow(_walked(owner, most, budget, chunk), f"{key}, batch long, n long, width long")
    return parts.groupBy(owner, "batch").agg(F.sum("n").alias("n"), F.max("width").alias("width"))
