"""Records from memories, authored lessons and conversations, and the binding of prompts to their owner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.derive import composed_memory, message

GENERAL, OWNER = "Context: general\n", "SpiritId: "


def filled(template: Column, values: Column) -> Column:
    """A template with every {name} that the map ``values`` has replaced; others stay."""
    return F.aggregate(F.map_entries(F.coalesce(values, F.create_map().cast("map<string,string>"))), template, lambda t, e: F.replace(t, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))


def language_facts(facts: DataFrame, key: str, language: str) -> DataFrame:
    """(key, text, cue, reference) of facts with columns text_<language> and cue_<language>; facts without a text in it are left out."""
    return facts.select(F.col(key).alias("key"), F.col(f"text_{language}").alias("text"), F.col(f"cue_{language}").alias("cue"), F.concat(F.lit("world:"), F.col(key).cast("string")).alias("reference")).where("text <> ''")


def memory_records(memories: DataFrame, core: Column, level_line: Column) -> DataFrame:
    """``memories`` (owner, no, text, cue, level, story_no, evidence, ...) with id, prompt, completion and event_keys.

    The system message is the core lines without the memory itself and the line of its level; the event
    is the story, or else each piece of evidence.
    """
    system = message("system", F.array_join(composed_memory(core, F.col("text"), level_line), "\n"))
    events = F.when(F.col("story_no").isNotNull(), F.array(F.concat(F.lit("StoryInfo:"), F.col("story_no").cast("string")))).otherwise(F.transform("evidence", lambda e: F.concat(F.lit("memory:"), e)))
    number = F.concat(F.lit("self_memory:"), F.lpad(F.col("no").cast("string"), 5, "0"))
    return memories.select(*memories.columns, number.alias("id"), F.array(system, message("user", F.col("cue"))).alias("prompt"), F.array(message("assistant", F.col("text"))).alias("completion"), events.alias("event_keys"))


def style_evidence(styles: DataFrame, records: DataFrame) -> DataFrame:
    """(owner, origin_id, event_keys, problem): the one record that shows an owner's style; style_not_unique or style_changed where there is none.

    ``styles``: owner, table, keys, quote. ``records``: owner, table, keys, id, event_keys, text.
    """
    r = records.select(F.col("owner").alias("__o"), F.col("table").alias("__t"), F.col("keys").alias("__k"), F.struct("id", "event_keys", "text").alias("r"))
    met = styles.join(r, (F.col("owner") == F.col("__o")) & (F.col("table") == F.col("__t")) & (F.col("keys") == F.col("__k")), "left")
    one = met.groupBy("owner", "table", "keys", "quote").agg(F.count("r").alias("n"), F.min("r").alias("r"))
    problem = F.when(F.col("n") != 1, "style_not_unique").when(~F.coalesce(F.col("r.text") == F.col("quote"), F.lit(False)), "style_changed")
    return one.select("owner", F.when(problem.isNull(), F.col("r.id")).alias("origin_id"), F.when(problem.isNull(), F.col("r.event_keys")).alias("event_keys"), problem.alias("problem"))


def topic_lessons(answers: DataFrame, topics: DataFrame, owners: DataFrame, system: Column) -> DataFrame:
    """(owner, topic, prompt, completion, fact): each owner's answer to each topic's question, after the topic's own turns.

    ``answers``: owner, topic, text; ``topics``: topic, question, history (role, content), fact;
    ``owners``: owner, name and what ``system`` uses. {name} stands for the owner's name in answers, and in a
    topic's turns {name} and {topic} for the name and the owner's answer to that topic. Answers to unknown topics
    and of unknown owners are left out.
    """
    a = answers.join(owners.select("owner", "name", system.alias("__system")), "owner").withColumn("text", F.replace("text", F.lit("{name}"), F.col("name")))
    said = a.groupBy("owner").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("topic", "text")))).alias("__said"))
    rows = a.join(said, "owner").join(topics, "topic")
    values = F.map_concat(F.map_filter("__said", lambda k, v: k != "name"), F.create_map(F.lit("name"), F.col("name")))
    rows = rows.withColumn("__values", values)
    before = F.transform(F.coalesce("history", F.array().cast("array<struct<role:string,content:string>>")), lambda t: F.struct(t["role"].alias("role"), filled(t["content"], F.col("__values")).alias("content")))
    prompt = F.concat(F.array(message("system", F.col("__system"))), before, F.array(message("user", F.col("question"))))
    return rows.select("owner", "topic", prompt.alias("prompt"), F.array(message("assistant", F.col("text"))).alias("completion"), "fact")


def conversation_lessons(authored: DataFrame, owners: DataFrame, system: Column) -> tuple[DataFrame, DataFrame]:
    """(lessons, problems) of authored conversations (owner, id, turns of role and content).

    Each answer is a lesson: owner, id, part (from 0), prompt (system and all turns before) and completion, {name} replaced.
    problems (owner, id, problem): duplicate (an owner has the id twice), odd_turns (fewer than two or an odd
    number), roles (not user and answer in turn), blank (a turn without text). Such conversations give no lesson.
    """
    n = authored.groupBy(F.col("owner").alias("__o"), F.col("id").alias("__i")).agg(F.count("*").alias("__n"))
    rows = authored.join(n, F.col("owner").eqNullSafe(F.col("__o")) & F.col("id").eqNullSafe(F.col("__i"))).join(owners.select("owner", "name", system.alias("__system")), "owner")
    turns = F.coalesce("turns", F.array().cast("array<struct<role:string,content:string>>"))
    rows = rows.withColumn("__t", F.transform(turns, lambda t: F.struct(t["role"].alias("role"), F.replace(t["content"], F.lit("{name}"), F.col("name")).alias("content"))))
    wrong = F.exists(F.transform("__t", lambda t, i: ~F.coalesce(t["role"] == F.when(i % 2 == 0, "user").otherwise("assistant"), F.lit(False))), lambda x: x)
    blank = F.exists("__t", lambda t: F.trim(F.coalesce(t["content"], F.lit(""))) == "")
    problem = F.when(F.col("__n") > 1, "duplicate").when((F.size("__t") < 2) | (F.size("__t") % 2 == 1), "odd_turns").when(wrong, "roles").when(blank, "blank")
    rows = rows.withColumn("problem", problem)
    good = rows.where("problem is null").withColumn("part", F.explode(F.sequence(F.lit(0), (F.size("__t") / 2).cast("int") - 1)))
    prompt = F.concat(F.array(message("system", F.col("__system"))), F.slice("__t", F.lit(1), F.col("part") * 2 + 1))
    lessons = good.select("owner", "id", "part", prompt.alias("prompt"), F.slice("__t", F.col("part") * 2 + 2, F.lit(1)).alias("completion"))
    return lessons, rows.where("problem is not null").select("owner", "id", "problem")


def bound_prompt(messages: Column, owner: Column) -> Column:
    """A prompt bound to its owner: the system message becomes the header that names it; a null owner binds to the general context.

    Null where an owner's prompt does not begin with a system message, or with one that names another owner.
    """
    header = F.concat(F.lit(OWNER), owner, F.lit("\n"))
    first = F.get(messages, F.lit(0))
    body = F.filter(messages, lambda m: m["role"] != "system")
    named = (first["role"] == "system") & (~first["content"].startswith(OWNER) | F.startswith(first["content"], header))
    own = F.when(named, F.concat(F.array(message("system", header)), F.slice(messages, F.lit(2), F.greatest(F.size(messages), F.lit(1)))))
    return F.when(owner.isNull(), F.concat(F.array(message("system", F.lit(GENERAL))), body)).otherwise(own)
