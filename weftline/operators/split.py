"""Train, validation and test: by hash, by inheritance, and by connected components."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.hashing import seeded_order
from weftline.operators.graph import connected_components
from weftline.plans.shared import join_checked, materialize, running_total

SPLITS = ("train", "validation", "test")


def check_ratios(ratios: tuple[float, float, float]) -> None:
    if any(not 0 <= r <= 1 for r in ratios) or abs(sum(ratios) - 1) > 1e-6:
        raise ValueError(f"the three ratios do not make a whole: {ratios}")


def record_components(records: DataFrame, id_col: str, keys: list[Column]) -> DataFrame:
    """(id, component) of records that share a key, directly or through others; component is the least id.

    Each key links its records to the least of them, so a key with k records gives k - 1 edges. A null
    key links nothing.
    """
    rows = records.select(F.col(id_col).alias("id"), F.explode(F.array_compact(F.array(*keys))).alias("key"))
    least = materialize(rows.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1").select("key", "least"), "least")
    edges = rows.join(least, "key").select("id", "least").distinct()
    comp = materialize(connected_components(edges, "id", "least"), "comp")
    out = records.select(F.col(id_col).alias("id")).join(comp, "id", "left")
    return out.select("id", F.coalesce("component", "id").alias("component"))


def fill_greedily(sizes: list[tuple], ratios: tuple[float, float, float], total: int, first_to_train: bool = False) -> list[int]:
    """The split of each component in the order given.

    A component goes where most rows are still missing (the earlier split of equals); when no more are
    left than splits without any, those are served first. ``first_to_train`` settles the first one.
    """
    open_splits = [k for k in range(3) if ratios[k] > 0]
    missing = {k: total * ratios[k] for k in open_splits}
    unserved = list(open_splits)
    out: list[int] = []
    for left, (_, n) in zip(range(len(sizes), 0, -1), sizes, strict=True):
        if first_to_train and not out and 0 in missing:
            to = 0
        elif left <= len(unserved):
            to = unserved[0]
        else:
            to = max(missing, key=missing.get)
        missing[to] -= n
        unserved = [k for k in unserved if k != to]
        out.append(to)
    return out


def fill_by_size(histogram: list[tuple[int, int]], ratios: tuple[float, float, float], in_train: int = 0) -> list[tuple[int, int, list[int]]]:
    """The deal of ``fill_greedily`` for (size, components) runs, largest first, as (size, first place in the run, splits in turn).

    Within a run every deal lowers a deficit by the same size, so splits take turns: those within one
    size of the largest deficit, in a fixed order, until a further one comes within reach. That is three
    entries a run at most. Only the last three components of all can be due to unserved splits.
    ``in_train`` rows are in the first split already and count for the total.
    """
    total, left = sum(n * k for n, k in histogram) + in_train, sum(k for _, k in histogram)
    missing = {s: Fraction(total * ratios[s]) for s in range(3) if ratios[s] > 0}
    unserved = [s for s in missing if s or not in_train]
    if in_train:
        missing[0] -= in_train
    plan = []
    for n, k in histogram:
        at = 0
        while at < k:
            lead = max(missing, key=missing.get)
            if left <= 3:
                turn, dealt = [unserved[0] if left <= len(unserved) else lead], 1
            else:
                reach = (missing[lead] - n, -lead)
                turn = sorted((s for s in missing if (missing[s], -s) > reach), key=lambda s: (-missing[s], s))
                dealt = min(k - at, left - 3)
                for s in set(missing) - set(turn):
                    rounds, over = divmod(missing[lead] - missing[s], n)
                    dealt = min(dealt, len(turn) * (rounds - (over == 0 and s < lead)))
            plan.append((n, at, turn))
            for i, s in enumerate(turn):
                missing[s] -= n * len(range(i, dealt, len(turn)))
            unserved = [s for s in unserved if s not in turn[:dealt]]
            at, left = at + dealt, left - dealt
    return plan


def leakage_safe_split(components: DataFrame, ratios: tuple[float, float, float] = (0.85, 0.1, 0.05), seed: int = 42, reviewed: DataFrame | None = None) -> DataFrame:
    """(component, size, split) from (id, component); no component is parted.

    ``reviewed`` (id) are rows that supervision needs: of the components with one, the first in the deal's
    order is dealt before all others, to train. Ids that have no component count for nothing.

    Components go largest first, ties in a seeded order, each to the split with the largest deficit.
    The driver plans the deal from the histogram of sizes, which has fewer entries than the square root
    of twice the rows; a component finds its turn by its place among those of its size.
    """
    check_ratios(ratios)
    sizes = materialize(components.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    key = seeded_order(seed, F.col("component"))
    first = None
    if reviewed is not None and ratios[0] > 0:
        held = components.join(reviewed.select(F.col("id").alias("__id")).distinct(), F.col("id") == F.col("__id"), "left_semi").select(F.col("component").alias("__c")).distinct()
        first = sizes.join(held, F.col("component") == F.col("__c"), "left_semi").orderBy(F.desc("size"), key, "component").first()
    whole = sizes
    if first is not None:
        sizes = sizes.where(F.col("component") != F.lit(first["component"]))
    histogram = [(r["size"], r["count"]) for r in sizes.groupBy("size").count().orderBy(F.desc("size")).collect()]
    turns: dict[int, list] = {}
    for n, at, turn in fill_by_size(histogram, ratios, first["size"] if first is not None else 0):
        turns.setdefault(n, []).append((at, [SPLITS[s] for s in turn]))
    plan = components.sparkSession.createDataFrame(list(turns.items()), "__size long, __turns array<struct<at:long,splits:array<string>>>")
    cell = F.coalesce(F.conv(F.substring(key, 1, 4), 16, 10).cast("int"), F.lit(-1))
    placed = running_total(sizes, "size", cell, [key, F.col("component")], F.lit(1), "__place")
    placed = join_checked(placed, plan, F.col("size") == F.col("__size"), "inner")
    turn = F.element_at(F.filter("__turns", lambda t: t["at"] <= F.col("__place")), -1)
    split = F.element_at(turn["splits"], ((F.col("__place") - turn["at"]) % F.size(turn["splits"]) + 1).cast("int"))
    out = placed.select("component", "size", split.alias("split"))
    if first is None:
        return out
    return out.unionByName(whole.where(F.col("component") == F.lit(first["component"])).select("component", "size", F.lit(SPLITS[0]).alias("split")))


def require_full_splits(assigned: DataFrame, ratios: tuple[float, float, float]) -> dict[str, int]:
    """Rows of each split of ``assigned`` (split); raise if one whose ratio is not 0 has none."""
    check_ratios(ratios)
    counts = {r["split"]: r["count"] for r in assigned.groupBy("split").count().collect()}
    empty = [s for s, r in zip(SPLITS, ratios, strict=True) if r > 0 and not counts.get(s)]
    if empty:
        raise ValueError(f"splits without a row: {empty}")
    return {s: counts.get(s, 0) for s in SPLITS}


def extend_split(components: DataFrame, prior: DataFrame) -> DataFrame:
    """(id, component, split): every record takes the first split (train, validation, test) that its component has in ``prior`` (id, split), train if none."""
    number = F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split"))
    known = components.join(prior, "id", "left").withColumn("__n", F.when(number > 0, number))
    best = known.groupBy("component").agg(F.min("__n").alias("__b"))
    out = components.join(best, "component")
    return out.select("id", "component", F.element_at(F.array(*map(F.lit, SPLITS)), F.coalesce(F.col("__b"), F.lit(1)).cast("int")).alias("split"))
