"""Sequence operators over turns (conversation, turn, role, text): runs, exchanges and histories.

Every window is partitioned by conversation and ordered by turn, so all of them share one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(key: str):
    return Window.partitionBy(key)


def role_runs(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role") -> DataFrame:
    """``turns`` with ``run``: the number, from 1, of the run of equal roles that a turn is in."""
    w = _by(key).orderBy(order)
    new = F.when(F.lag(role).over(w).eqNullSafe(F.col(role)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return turns.withColumn("__new", new).withColumn("run", F.sum("__new").over(w)).drop("__new")


def exchanges(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", answerer: str = "assistant") -> DataFrame:
    """``turns`` with ``exchange`` (from 0), ``is_prompt`` and ``answered``.

    An exchange is all turns before a run of the answerer and that run; turns after the last run are an
    exchange that is not answered.
    """
    w = _by(key).orderBy(order)
    mine = F.col(role).eqNullSafe(F.lit(answerer))
    before = F.lag(mine.cast("int"), 1, 0).over(w)
    starts = F.when(~mine & (before == 1), 1).otherwise(0)
    out = turns.withColumn("__s", starts).withColumn("exchange", F.sum("__s").over(w)).drop("__s")
    out = out.withColumn("is_prompt", ~mine)
    return out.withColumn("answered", F.max(mine).over(_by(key).partitionBy(key, "exchange")))


def history(turns: DataFrame, limit: int = 8, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row an assistant turn with ``history``: up to ``limit`` turns before it, from a user turn to a user turn."""
    w = _by(key).orderBy(order).rowsBetween(-limit, -1)
    past = F.collect_list(F.struct(F.col(role).alias("role"), F.col(text).alias("content"))).over(w)
    out = turns.withColumn("history", past)
    trimmed = F.when(F.get("history", F.lit(0))["role"] != "user", F.slice("history", 2, limit)).otherwise(F.col("history"))
    out = out.where(F.col(role) == "assistant").withColumn("history", trimmed)
    return out.where((F.size("history") > 0) & (F.element_at("history", -1)["role"] == "user"))


def prefix_history(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """``turns`` at odd positions (from 0) with ``earlier``: how many turns come before, and their length together."""
    w = _by(key).orderBy(order)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    out = turns.withColumn("earlier", F.row_number().over(w) - 1).withColumn("earlier_chars", F.coalesce(F.sum(F.length("text")).over(past), F.lit(0)))
    return out.where(F.col("earlier") % 2 == 1)


def common_runs(turns: DataFrame, common: Column, key: str = "conv_id", order: str = "turn", role: str = "role") -> DataFrame:
    """(key, start, end): maximal runs of common turns, from their first user turn to their last assistant turn.

    A run without a user turn before an assistant turn gives nothing.
    """
    w = _by(key).orderBy(order)
    t = turns.withColumn("__c", F.coalesce(common, F.lit(False))).withColumn("__i", F.row_number().over(w))
    t = t.withColumn("__run", F.sum(F.when(F.col("__c"), 0).otherwise(1)).over(w)).where("__c")
    run = Window.partitionBy(key, "__run")
    t = t.withColumn("__a", F.min(F.when(F.col(role) == "user", F.col("__i"))).over(run))
    t = t.withColumn("__z", F.max(F.when((F.col(role) == "assistant") & (F.col("__i") > F.col("__a")), F.col("__i"))).over(run))
    t = t.where(F.col("__i").between(F.col("__a"), F.col("__z")))
    return t.groupBy(key, "__run").agg(F.min(order).alias("start"), F.max(order).alias("end")).drop("__run")


def before_break(turns: DataFrame, bad: Column, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """``turns`` with ``cut``: whether a bad turn has come by then, itself included."""
    w = _by(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return turns.withColumn("cut", F.max(F.coalesce(bad, F.lit(False))).over(w))


def trim_tail(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role") -> DataFrame:
    """Without the turns after the last assistant turn."""
    last = F.max(F.when(F.col(role) == "assistant", F.col(order))).over(_by(key))
    return turns.withColumn("__l", last).where(F.col(order) <= F.col("__l")).drop("__l")


def earlier_exchanges(pairs: DataFrame, limit: int = 3, key: str = "conv_id", order: str = "exchange", user: str = "user_text", answer: str = "answer_text") -> DataFrame:
    """``pairs`` with ``earlier``: the last ``limit`` exchanges before each."""
    w = _by(key).orderBy(order).rowsBetween(-limit, -1)
    return pairs.withColumn("earlier", F.collect_list(F.struct(F.col(user).alias("user"), F.col(answer).alias("answer"))).over(w))


#: Kinds of script lines.
SPEECH, CHOICE, PLAYER, NARRATION = "speech", "choice", "player", "narration"


def script_stages(lines: DataFrame, key: str = "group_no", by_group: bool = True) -> DataFrame:
    """``lines`` (key, idx, kind, choice_group, ...) with ``stage`` and ``part``: option, branch or plain.

    A block of choices (with the player's lines among them) and, where options are grouped, the lines
    after it that have a group are one stage; the lines up to the next block are another.
    """
    w = _by(key).orderBy("idx")
    far = F.col("kind").isin(CHOICE, PLAYER)
    out = lines.withColumn("__run", F.sum(F.when(far, 0).otherwise(1)).over(w))
    chosen = F.max(F.col("kind") == CHOICE).over(_by(key).partitionBy(key, "__run").orderBy("idx"))
    out = out.withColumn("__block", far & chosen)
    out = out.withColumn("__after", F.sum(F.when(F.col("__block"), 1).otherwise(0)).over(w))
    bare = F.sum(F.when(F.col("__block") | (F.col("choice_group") > 0), 0).otherwise(1)).over(_by(key).partitionBy(key, "__after").orderBy("idx"))
    branch = ~F.col("__block") & (F.col("__after") > 0) & (bare == 0) & F.lit(by_group)
    out = out.withColumn("part", F.when(F.col("__block"), "option").when(branch, "branch").otherwise("plain"))
    before = F.lag("part").over(w)
    new = ((F.col("part") == "option") & ~before.eqNullSafe("option")) | ((F.col("part") == "plain") & ~before.eqNullSafe("plain"))
    return out.withColumn("stage", F.sum(F.when(new, 1).otherwise(0)).over(w)).drop("__run", "__block", "__after")
