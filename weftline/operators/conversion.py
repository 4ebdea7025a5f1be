"""Foreign dialogues turned into training records: context breaks, turns that may not be learned, exclusions with reasons."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLASSIFIED, BREAK, UNCONVERTED = "content_classification", "context_break", "unconverted_speech"
_PARTS = "array<struct<kind:string,text:string>>"


@dataclass(frozen=True)
class Style:
    """How segments are converted; each is a function of a text column.

    ``breaks``: what may stand in no user turn and makes an answer unfit. ``unfit``: what makes an answer
    unfit besides. ``speak``: speech in the owner's register, null where it cannot be derived. ``clean``: a
    text without what is no speech. ``shown``: a part's kind and text as they stand in a turn.
    """

    breaks: Callable[[Column], Column]
    unfit: Callable[[Column], Column]
    speak: Callable[[Column], Column]
    clean: Callable[[Column], Column]
    shown: Callable[[Column, Column], Column]


def converted_turns(turns: DataFrame, style: Style, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """``turns`` (key, order, role, segments of kind and text) with content, trainable, breaks, cut and mentions.

    A user turn breaks its conversation if one of its segments mentions what ``style.breaks`` finds or
    nothing of it is left; ``cut`` holds from there on. An answer is trainable as long as every segment
    is fit and every speech is derived; from the first that is not, speech is only cleaned.
    """
    segments = F.coalesce("segments", F.array().cast(_PARTS))
    yes = lambda c: F.coalesce(c, F.lit(False))
    speech = lambda s: s["kind"] == "speech"
    made = F.transform(segments, lambda s: F.struct(s["kind"].alias("kind"), style.clean(s["text"]).alias("plain"), F.when(speech(s), style.speak(s["text"])).alias("spoken"), yes(style.breaks(s["text"])).alias("far"), yes(style.unfit(s["text"])).alias("unfit")))
    out = turns.withColumn("__made", made)
    fit = F.transform("__made", lambda m: ~m["far"] & ~m["unfit"] & ((m["kind"] != "speech") | m["spoken"].isNotNull()))
    out = out.withColumn("__bad", F.array_position(fit, F.lit(False)))
    user = F.col("role") == "user"
    said = F.transform("__made", lambda m, i: F.struct(m["kind"].alias("kind"), F.when((m["kind"] == "speech") & ~user & ((F.col("__bad") == 0) | (i + 1 < F.col("__bad"))), m["spoken"]).otherwise(m["plain"]).alias("text")))
    shown = F.transform(F.filter(said, lambda s: F.coalesce(s["text"], F.lit("")) != ""), lambda s: style.shown(s["kind"], s["text"]))
    out = out.withColumn("content", F.array_join(shown, " ")).withColumn("mentions", F.exists("__made", lambda m: m["far"]))
    out = out.withColumn("breaks", user & (F.col("mentions") | (F.col("content") == "")))
    far = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("cut", F.max("breaks").over(far))
    return out.withColumn("trainable", ~user & (F.col("__bad") == 0) & (F.col("content") != "")).drop("__made", "__bad")


def records_of(turns: DataFrame, style: Style, gate: Column, opening: Column, system: Column, limit: int = 8, key: str = "conv_id", order: str = "turn") -> tuple[DataFrame, DataFrame]:
    """(records, exclusions) of conversations. ``gate`` is null for one that may be read, else why not; it is the same for all its turns.

    records: key, order, prompt (system and up to ``limit`` turns before the answer, from a user turn on) and completion, for
    every trainable answer. A conversation that begins with an answer gets ``opening`` as its first user
    turn. Answers that may not be learned still are history. exclusions: key, order (null for a whole
    conversation), reason, detail and preview: one for each conversation that the gate keeps out, each
    break (with the number of answers that it loses), and each answer that is not trainable.
    """
    t = turns.withColumn("__gate", gate)
    closed = t.where(F.col("__gate").isNotNull()).groupBy(key).agg(F.min("__gate").alias("detail"), F.min_by(F.concat_ws(" ", F.transform("segments", lambda s: s["text"])), order).alias("text"))
    t = converted_turns(t.where(F.col("__gate").isNull()), style, key, order)
    whole, w = Window.partitionBy(key), Window.partitionBy(key).orderBy(order)
    later = F.sum(F.when(F.col("role") != "user", 1).otherwise(0)).over(w.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumns({"__later": later, "__raw": F.concat_ws(" ", F.transform("segments", lambda s: s["text"]))})
    first = F.col("breaks") & (F.sum(F.col("breaks").cast("int")).over(w) == 1)
    broken = t.withColumn("__first", first).where("__first")
    why = F.concat_ws(":", F.when(F.col("mentions"), "real_world").otherwise("empty"), F.col("__later").cast("string"))
    stay = t.where(~F.col("cut") & (F.col("content") != ""))
    unfit = stay.where((F.col("role") != "user") & ~F.col("trainable"))
    row = lambda df, o, reason, detail, text: df.select(key, o.alias(order), F.lit(reason).alias("reason"), detail.alias("detail"), F.substring(text, 1, 80).alias("preview"))
    none = F.lit(None).cast(turns.schema[order].dataType)
    exclusions = row(closed, none, CLASSIFIED, F.col("detail"), F.col("text")).unionByName(row(broken, F.col(order), BREAK, why, F.col("__raw"))).unionByName(row(unfit, F.col(order), UNCONVERTED, F.lit("speech_style"), F.col("content")))

    last = F.max(F.when(F.col("role") != "user", F.col(order))).over(whole)
    stay = stay.withColumn("__last", last).where(F.col(order) <= F.col("__last"))
    past = F.collect_list(F.struct("role", "content")).over(w.rowsBetween(-limit, -1))
    head = F.first("role").over(w)
    stay = stay.withColumns({"__past": past, "__n": F.row_number().over(w), "__head": head})
    user = F.struct(F.lit("user").alias("role"), opening.alias("content"))
    # The opening is the turn ahead of the first one: it is history as long as the window reaches it.
    history = F.when((F.col("__head") != "user") & (F.col("__n") <= limit), F.concat(F.array(user), F.when(F.col("__n") == limit + 1, F.slice("__past", 2, limit)).otherwise(F.col("__past")))).otherwise(F.col("__past"))
    history = F.when(F.get(history, F.lit(0))["role"] != "user", F.slice(history, 2, limit)).otherwise(history)
    prompt = F.concat(F.array(F.struct(F.lit("system").alias("role"), system.alias("content"))), history)
    done = F.array(F.struct(F.col("role"), F.col("content")))
    return stay.where("trainable").select(key, order, prompt.alias("prompt"), done.alias("completion")), exclusions
