"""Prefixes of conversations by hash: which go on with others, and whether records chain.

The hash of a prefix is the sum of its turns' hashes, each of which holds the turn's place, role and
text. A running sum gives every prefix of a conversation in one pass, and equal prefixes meet in an
equi-join whatever their length. Two sums of 64-bit hashes are kept, in numbers that do not overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _marks(at: Column, *parts: Column) -> tuple[Column, Column]:
    """Two independent hashes of a turn at its place."""
    first = F.xxhash64(at.cast("long"), *parts)
    return first.cast("decimal(20,0)"), F.xxhash64(F.lit("turn"), *reversed(parts), first, at.cast("long")).cast("decimal(20,0)")


def prefix_hashes(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``turns`` with ``at`` (from 1) and ``prefix``, the hash of the turns so far; null roles and texts are values of their own."""
    w = Window.partitionBy(key).orderBy(order)
    out = turns.withColumn("at", F.row_number().over(w).cast("long"))
    parts = [F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in (F.col(role), F.col(text))]
    a, b = _marks(F.col("at"), *parts)
    far = w.rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumns({"__a": a, "__b": b}).withColumn("prefix", F.struct(F.sum("__a").over(far).alias("a"), F.sum("__b").over(far).alias("b"))).drop("__a", "__b")


def continuations(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turns, copies, same_as, continues, shared): one row a conversation.

    ``copies`` conversations are equal to it, itself included, the first of them being ``same_as``;
    ``continues`` is the longest shorter conversation that it begins with, by its first copy, and
    ``shared`` that one's turns; null where it goes on with none. Equal conversations are one row on
    the side that is looked up, so a prefix finds one at most, however many share it. Turns without a
    key are left out.
    """
    p = prefix_hashes(turns.where(F.col(key).isNotNull()), key, order, role, text).select(key, "at", "prefix")
    last = F.max("at").over(Window.partitionBy(key))
    p = p.withColumn("turns", last)
    ends = p.where("at = turns").groupBy(F.col("at").alias("__at"), F.col("prefix").alias("__p")).agg(F.min(key).alias("first"), F.count("*").alias("copies"))
    met = p.join(ends, (F.col("at") == F.col("__at")) & (F.col("prefix") == F.col("__p")), "left")
    whole = F.col("at") == F.col("turns")
    shorter = F.when(~whole & F.col("first").isNotNull(), F.struct("at", "first"))
    return met.groupBy(key).agg(F.max("turns").alias("turns"), F.max(F.when(whole, F.col("copies"))).alias("copies"), F.max(F.when(whole, F.col("first"))).alias("same_as"), F.max(shorter).alias("s")).select(key, "turns", "copies", "same_as", F.col("s.first").alias("continues"), F.col("s.at").alias("shared"))


def turns_hash(turns: Column) -> Column:
    """The hash of an array of turns (role, content), as ``prefix_hashes`` gives it for the same turns."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    each = F.transform(turns, lambda x, i: F.struct(*[m.alias(n) for n, m in zip("ab", _marks(i + 1, part(x["role"]), part(x["content"])), strict=True)]))
    zero = F.lit(0).cast("decimal(38,0)")
    total = lambda n: F.aggregate(each, zero, lambda s, x: (s + x[n]).cast("decimal(38,0)")).cast("decimal(30,0)")
    return F.struct(total("a").alias("a"), total("b").alias("b"))


def record_problems(records: DataFrame, key: str, order: str, most: int | None = None, user: str = "user", answerer: str = "assistant") -> DataFrame:
    """``records`` (key, order, prompt, completion: arrays of role and content) with ``problem``, null if there is none.

    The first that holds counts: no_prompt, last_not_user, completion_count (not one turn of the
    answerer), broken_chain (the prompt without its last turn is not what the record before had as
    prompt and completion; the first record has none before), too_long (more than ``most`` characters).
    """
    w = Window.partitionBy(key).orderBy(order)
    none = F.array().cast("array<struct<role:string,content:string>>")
    prompt, done = F.coalesce("prompt", none), F.coalesce("completion", none)
    out = records.withColumn("__whole", turns_hash(F.concat(prompt, done))).withColumn("__n", F.size(prompt) + F.size(done))
    out = out.withColumns({"__before": F.lag("__whole").over(w), "__m": F.lag("__n").over(w), "__head": turns_hash(F.slice(prompt, F.lit(1), F.greatest(F.size(prompt) - 1, F.lit(0))))})
    chained = F.col("__before").isNull() | ((F.size(prompt) - 1 == F.col("__m")) & (F.col("__head") == F.col("__before")))
    chars = F.aggregate(F.concat(prompt, done), F.lit(0).cast("long"), lambda s, x: s + F.coalesce(F.length(x["content"]), F.lit(0)))
    problem = F.when(F.size(prompt) == 0, "no_prompt").when(~F.coalesce(F.element_at(prompt, -1)["role"] == user, F.lit(False)), "last_not_user")
    problem = problem.when((F.size(done) != 1) | ~F.coalesce(F.get(done, F.lit(0))["role"] == answerer, F.lit(False)), "completion_count").when(~chained, "broken_chain")
    if most is not None:
        problem = problem.when(chars > most, "too_long")
    return out.withColumn("problem", problem).drop("__whole", "__n", "__before", "__m", "__head")
