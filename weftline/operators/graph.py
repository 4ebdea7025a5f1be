"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from weftline.plans.shared import materialize, release

MAX_ROUNDS = 60


def _stamped(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, and their count and checksums, observed while they are written."""
    h = F.xxhash64("u", "v")
    seen = Observation()
    marks = [F.count("*").alias("n"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(h, 32)).alias("high")]
    out = materialize(edges.observe(seen, *marks), "edges")
    return out, tuple(seen.get[k] for k in ("n", "low", "high"))


def _star(edges: DataFrame, both_ways: bool) -> tuple[DataFrame, tuple]:
    """``edges``: (u, v) with u > v. Hang the neighbours of each node on the least of them."""
    flow = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else edges
    # written, so that the planner knows its size: a hub's rows are then split by AQE's skew join
    least = materialize(flow.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    out = flow.join(least, "u")
    if both_ways:
        out = out.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    out = _stamped(out.where(F.col("u") != F.col("v")).distinct())
    release(least)
    return out


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (id, component) for each node of ``edges``; component is the least id reachable.

    Nothing is gathered on the driver but a count and two checksums a round. Minima are taken with
    partial aggregation and joined back from a written table, so a hub with a large share of the
    edges is split by AQE's skew join. Edges with a null end are ignored; a loop makes a node alone.
    """
    raw = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    raw = materialize(raw.distinct(), "raw")
    now, seen = _stamped(raw.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        big, _ = _star(now, True)
        nxt, stamp = _star(big, False)
        release(big)
        release(now)
        now = nxt
        if stamp == seen:
            break
        seen = stamp
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component"))
    leaves = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    loops = raw.where("a = b").select(F.col("a").alias("id"), F.col("a").alias("component"))
    return leaves.unionByName(roots).unionByName(loops).groupBy("id").agg(F.min("component").alias("component"))
