"""Keys, records and acceptance rules of training records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import masked_entity, strip


def json_text(c: Column) -> Column:
    """A string as JSON text: quotes, backslashes and control characters escaped, with small letters in their numbers, everything else as it is; null stays ``null``."""
    made = F.to_json(F.array(c))
    small = made
    for code in (*range(0x0B, 0x0C), *range(0x0E, 0x10), *range(0x1A, 0x20)):
        small = F.regexp_replace(small, r"(?<!\\)((?:\\\\)*)\\u%04X" % code, r"$1\\u%04x" % code)
    made = F.when(made.rlike(r"\\u00[01][A-F]"), small).otherwise(made)
    return F.coalesce(F.substring(made, F.lit(2), F.length(made) - 2), F.lit("null"))


def json_list(c: Column) -> Column:
    """An array of strings as a JSON list with a space after each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(c, json_text), ", "), F.lit("]"))


def content_key(prefix: str = "", **parts: Column) -> Column:
    """SHA-256 of a JSON object whose names are sorted; each part is JSON text already. Spaces stand after commas and colons."""
    body = F.concat_ws(", ", *[F.concat(F.lit(f'"{n}": '), parts[n]) for n in sorted(parts)])
    return F.concat(F.lit(prefix), F.sha2(F.concat(F.lit("{"), body, F.lit("}")), 256))


def record_key(kind: Column, table: Column, keys: Column, context: Column, speech: Column) -> Column:
    """The key by which annotations find a record: its source, the last two turns before it, and its speech. ``keys`` are whole numbers."""
    numbers = F.concat(F.lit("["), F.array_join(F.transform(keys, lambda x: x.cast("string")), ", "), F.lit("]"))
    source = F.concat(F.lit('{"keys": '), numbers, F.lit(', "kind": '), json_text(kind), F.lit(', "table": '), json_text(table), F.lit("}"))
    last = F.when(F.size(context) > 2, F.slice(context, -2, 2)).otherwise(context)
    return content_key(context=json_list(last), source=source, speech=json_list(speech))


def speech_key(language: Column, task: Column, kind: Column, table: Column, speech: Column, prefix: str) -> Column:
    """The key that a record keeps when its context is written anew: language, task, source and speech."""
    source = F.concat(F.lit('{"kind": '), json_text(kind), F.lit(', "table": '), json_text(table), F.lit("}"))
    return content_key(prefix, language=json_text(F.coalesce(language, F.lit("ko"))), task=json_text(task), source=source, speech=json_list(speech))


def lanes(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """The rows of several readers with the name and number (from 0) of their lane."""
    out = None
    for i, (name, df) in enumerate(parts):
        df = df.withColumn("lane", F.lit(name)).withColumn("lane_no", F.lit(i))
        out = df if out is None else out.unionByName(df)
    return out


def majority_level(df: DataFrame, owner: str, level: str, default: str = "casual", share: float = 0.5) -> DataFrame:
    """(owner, level, total): the most frequent level other than ``default`` if those levels together have ``share`` of all rows; of equals the greater."""
    counts = df.where(F.col(level).isNotNull()).groupBy(owner, level).agg(F.count("*").alias("n"))
    other = F.col(level) != default
    out = counts.groupBy(owner).agg(F.sum("n").alias("total"), F.sum(F.when(other, F.col("n"))).alias("others"), F.max(F.when(other, F.struct("n", F.col(level).alias("l")))).alias("best"))
    return out.select(owner, F.when(F.col("others") >= F.lit(share) * F.col("total"), F.col("best.l")).otherwise(default).alias("level"), "total")


def accepted_lines(df: DataFrame, key: list[str], text: str, order: str, most: int = 29) -> DataFrame:
    """``df`` with ``state``: exceeds_length, repeated (not the first such line of its key) or accepted; empty lines are ``empty``."""
    from weftline.operators.dedup import first_seen

    out = first_seen(df, [*key, text], [order])
    state = F.when(F.coalesce(F.col(text), F.lit("")) == "", "empty").when(F.length(text) > most, "exceeds_length").when(~F.col("kept"), "repeated").otherwise("accepted")
    return out.withColumn("state", state).drop("kept")


def memory_problem(memories: DataFrame, stories: DataFrame, allowed: list[str], main: str, alternate: list[int], low: int = 1, high: int = 40, most: int = 29) -> DataFrame:
    """``memories`` (owner, is_variant, text, story_no, level, line_keys) with ``level`` and ``problem``, null if accepted.

    ``stories``: story_no, story_type, act, ending, unlock, available (line keys). The first problem counts:
    length, level, no_story, story_type, owner (a main story belongs to all but variants, another to the
    owner of its act), ending, evidence (a main story, or stated keys, must name lines that are there).
    The level is the greater of the memory's and the story's.
    """
    m = memories.withColumn("level", F.coalesce("level", F.lit(low))).withColumn("text", F.trim("text"))
    j = m.join(stories, "story_no", "left")
    keys = F.coalesce("line_keys", F.array().cast("array<bigint>"))
    shown = F.size(F.array_except(keys, F.coalesce("available", F.array().cast("array<bigint>")))) == 0
    owned = F.when(F.col("story_type") == main, ~F.col("is_variant")).otherwise(F.col("act").eqNullSafe(F.col("owner")))
    problem = (
        F.when(~F.length("text").between(1, most) | F.col("text").isNull(), "length")
        .when(~F.col("level").between(low, high), "level")
        .when(F.col("story_type").isNull(), "no_story")
        .when(~F.col("story_type").isin(main, *allowed), "story_type")
        .when(~owned, "owner")
        .when(F.col("ending").isin(*alternate), "ending")
        .when(((F.col("story_type") == main) | (F.size(keys) > 0)) & ((F.size(keys) == 0) | ~shown), "evidence")
    )
    return j.withColumn("problem", problem).withColumn("level", F.greatest("level", F.coalesce("unlock", F.lit(low)))).select(*m.columns, "problem")


def evidence_problem(notes: DataFrame, records: DataFrame) -> DataFrame:
    """``notes`` (record_key, evidence_key, evidence) with ``problem``: no_record, other_episode or not_in_source, null if supported.

    ``records``: record_key, kind, table, episode, speech. A note without an evidence key is supported by its
    own record, and by another only from the same kind, table and episode; each text must occur there.
    """
    own = records.select("record_key", F.struct("kind", "table", "episode").alias("__own"))
    far = records.select(F.col("record_key").alias("__key"), F.struct("kind", "table", "episode").alias("__far"), F.col("speech").alias("__speech"))
    j = notes.withColumn("__key", F.coalesce("evidence_key", "record_key")).join(own, "record_key", "left").join(far, "__key", "left")
    held = (F.size("evidence") > 0) & F.forall("evidence", lambda e: F.contains(F.col("__speech"), e))
    problem = F.when(F.col("__own").isNull(), "no_record").when(~F.col("__own").eqNullSafe(F.col("__far")), "other_episode").when(~F.coalesce(held, F.lit(False)), "not_in_source")
    return j.select(*notes.columns, problem.alias("problem"))


def render_template(template: Column, language: Column, translated: DataFrame, values: dict[str, Column], own: str) -> tuple[DataFrame, Column, Column]:
    """What a template gives: (``translated`` renamed for a join on template and language, the join's condition, the text).

    In the language ``own`` names in braces are replaced by values; in others the fixed translation stands, null if there is none.
    """
    names = translated.select(F.col("template").alias("__t"), F.col("language").alias("__l"), F.col("text").alias("__text"))
    text = template
    for n, c in values.items():
        text = F.replace(text, F.lit("{" + n + "}"), c)
    return names, (template == F.col("__t")) & (language == F.col("__l")), F.when(language == own, text).otherwise(F.col("__text"))


#: What the relation of a narrative says of it, and the names of felt emotions.
RELATIONS = {"xAttr": "interpretation", "xReact": "emotion", "xIntent": "intention", "xWant": "intention", "xNeed": "decision", "xEffect": "action"}
EMOTIONS = {
    "afraid": "두려움", "angry": "분노", "annoyed": "짜증", "anticipating": "기대", "anxious": "불안", "apprehensive": "걱정", "ashamed": "수치심", "caring": "보살핌",
    "confident": "자신감", "content": "만족", "devastated": "절망", "disappointed": "실망", "disgusted": "혐오", "embarrassed": "당혹", "excited": "신남", "faithful": "신뢰",
    "furious": "격분", "grateful": "감사", "guilty": "죄책감", "hopeful": "희망", "impressed": "감탄", "jealous": "질투", "joyful": "기쁨", "lonely": "외로움",
    "nostalgic": "그리움", "prepared": "준비됨", "proud": "자부심", "sad": "슬픔", "sentimental": "감상", "surprised": "놀람", "terrified": "공포", "trusting": "믿음",
}


def general_records(rows: DataFrame, language: str, split: Column, kind: str) -> DataFrame:
    """(id, language, split, first_role, turns, judgment) of foreign dialogues: each gives a conversation, a judgment, both or neither.

    ``rows``: id, turns, cue (the narrative or situation) and, of ``kind`` relation, relation and tail, or, of
    ``kind`` emotion, emotion. A conversation has two turns that are not blank at least; a judgment is JSON of one field, by
    the relation or the emotion's name, and stands for rows whose cue and value are there and known. Both share the split of the id.
    """
    table = RELATIONS if kind == "relation" else EMOTIONS
    known = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.coalesce(F.col(kind), F.lit("")))
    field, value = (known, strip(F.col("tail"))) if kind == "relation" else (F.when(known.isNotNull(), F.lit("emotion")), known)
    turns = F.filter(F.transform(F.coalesce("turns", F.array().cast("array<string>")), strip), lambda t: t != "")
    base = rows.select("id", F.lit(language).alias("language"), split.alias("split"), F.lit("user").alias("first_role"), turns.alias("turns"), strip(F.col("cue")).alias("__cue"), field.alias("__field"), value.alias("__value"))
    talk = base.where(F.size("turns") >= 2).select("id", "language", "split", "first_role", "turns", F.lit(None).cast("string").alias("judgment"))
    made = F.concat(F.lit('{"'), F.col("__field"), F.lit('": '), json_text(F.col("__value")), F.lit("}"))
    judged = base.where(F.col("__field").isNotNull() & (F.coalesce("__cue", F.lit("")) != "") & (F.coalesce("__value", F.lit("")) != ""))
    return talk.unionByName(judged.select(F.concat("id", F.lit(":judgment")).alias("id"), "language", "split", "first_role", F.array("__cue").alias("turns"), made.alias("judgment")))


def judgment_record(relation: Column, fields: dict[str, str], value: Column, situation: Column) -> Column:
    """JSON of the situation and, under the name that the relation stands for, the value; null for an unknown relation."""
    made = None
    for r, name in fields.items():
        one = F.to_json(F.struct(situation.alias("situation"), value.alias(name)))
        made = F.when(relation == r, one) if made is None else made.when(relation == r, one)
    return made


def mentions_itself(c: Column, pattern: str) -> Column:
    """Whether a text names a masked entity, or its speaker in the words of the pattern."""
    return masked_entity(c) | c.rlike(pattern)


def both_ways(comments: DataFrame, names: DataFrame, about: str, by: str, text: str) -> DataFrame:
    """(owner, direction, other, text): comments about an owner and comments by it, with the other's name; those about itself stand once a direction."""
    n = names.select(F.col("id").alias("__id"), F.col("name").alias("other"))
    one = comments.select(F.col(about).alias("owner"), F.lit("about").alias("direction"), F.col(by).alias("__id"), F.col(text).alias("text"))
    two = comments.select(F.col(by).alias("owner"), F.lit("by").alias("direction"), F.col(about).alias("__id"), F.col(text).alias("text"))
    return one.unionByName(two).join(n, "__id", "left").select("owner", "direction", "other", "text")


def collated(ids: Column, prompt_tokens: Column, width: Column, fill: int = 0) -> Column:
    """A row of a padded batch: ids, attention mask, target places (those after the prompt), and the weight of each: one over their number."""
    n = F.size(ids)
    more = F.greatest(width - n, F.lit(0)).cast("int")
    count = F.greatest(n - prompt_tokens, F.lit(0)).cast("int")
    places = F.when(count > 0, F.sequence(prompt_tokens.cast("int"), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.struct(
        F.concat(ids, F.array_repeat(F.lit(fill).cast("int"), more)).alias("ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), more)).alias("mask"),
        places.alias("targets"),
        F.when(count > 0, F.lit(1.0) / count).alias("weight"),
    )
