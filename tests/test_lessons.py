"""Conversion, lessons, memories and prompt binding beside plain Python."""

import random

from pyspark.sql import functions as F

from weftline.operators import conversion, lessons
from weftline.operators.conversion import Style

STYLE = Style(lambda t: t.contains("http"), lambda t: t.contains("##"), lambda t: F.when(~t.contains("?"), F.upper(t)), lambda t: F.trim(F.replace(t, F.lit("~"), F.lit(""))), lambda k, t: F.when(k == "action", F.concat(F.lit("*"), t, F.lit("*"))).otherwise(t))
KIND = "conv_id long, turn int, role string, segments array<struct<kind:string,text:string>>, gate string"


def plain(turns, limit):
    """One conversation: (records, exclusions)."""
    shown = lambda k, t: f"*{t}*" if k == "action" else t
    clean = lambda t: t.replace("~", "").strip(" ")
    if turns[0][3]:
        return [], [(None, "content_classification", turns[0][3])]
    out, gone = [], []
    for n, (at, role, segs, _) in enumerate(turns):
        if role == "user":
            text = " ".join(shown(k, clean(t)) for k, t in segs if clean(t))
            far = any("http" in t for _, t in segs)
            if far or not text:
                gone.append((at, "context_break", f"{'real_world' if far else 'empty'}:{sum(r != 'user' for _, r, _, _ in turns[n:])}"))
                break
            out.append((at, role, text, False))
            continue
        ok, parts = True, []
        for k, t in segs:
            ok = ok and "http" not in t and "##" not in t and not (k == "speech" and "?" in t)
            made = t.upper() if ok and k == "speech" else clean(t)
            if made:
                parts.append(shown(k, made))
        if parts:
            out.append((at, role, " ".join(parts), ok))
            if not ok:
                gone.append((at, "unconverted_speech", "speech_style"))
    while out and out[-1][1] == "user":
        out.pop()
    if out and out[0][1] != "user":
        out.insert(0, (None, "user", "OPEN", False))
    records = []
    for i, (at, role, text, ok) in enumerate(out):
        if role != "user" and ok:
            history = [(r, t) for _, r, t, _ in out[max(0, i - limit) : i]]
            records.append((at, [("system", "SYS"), *(history if not history or history[0][0] == "user" else history[1:])], [(role, text)]))
    return records, gone


def test_conversion_beside_plain_python(spark):
    rng = random.Random(11)
    word = lambda: rng.choice(["ab", "c~", "~", "", "d?", "e##", "see http", " f ", "g"])
    convs = {c: [(t, rng.choice(["user", "assistant"]), [(rng.choice(["speech", "action"]), word()) for _ in range(rng.randrange(0, 4))], "gated" if c % 9 == 0 else None) for t in range(rng.randrange(1, 16))] for c in range(150)}
    df = spark.createDataFrame([(c, *t) for c, turns in convs.items() for t in turns], KIND)
    records, gone = conversion.records_of(df, STYLE, F.col("gate"), F.lit("OPEN"), F.lit("SYS"), limit=4)
    got = {}
    for r in records.collect():
        got.setdefault(r["conv_id"], []).append((r["turn"], [tuple(x) for x in r["prompt"]], [tuple(x) for x in r["completion"]]))
    out = {}
    for r in gone.collect():
        out.setdefault(r["conv_id"], []).append((r["turn"], r["reason"], r["detail"]))
    for c, turns in convs.items():
        want, lost = plain(turns, 4)
        assert sorted(got.get(c, [])) == sorted(want), (c, turns)
        assert sorted(out.get(c, []), key=repr) == sorted(lost, key=repr), (c, turns)
    records, gone = conversion.records_of(df.limit(0), STYLE, F.col("gate"), F.lit("OPEN"), F.lit("SYS"))
    assert records.count() == gone.count() == 0


OWNERS = "owner long, name string, sys string"
TURN = "array<struct<role:string,content:string>>"


def test_topic_lessons(spark):
    owners = spark.createDataFrame([(1, "Ann", "S1"), (2, "Bo", "S2")], OWNERS)
    answers = spark.createDataFrame([(1, "food", "{name} likes tea"), (1, "home", "a hut"), (2, "food", "rice"), (2, "lost", "x"), (3, "food", "y")], "owner long, topic string, text string")
    topics = spark.createDataFrame([("food", "what food?", [("user", "hi {name}"), ("assistant", "I live in {home}, {other}")], "f1"), ("home", "where?", None, "f2")], f"topic string, question string, history {TURN}, fact string")
    got = {(r["owner"], r["topic"]): ([tuple(x) for x in r["prompt"]], r["completion"][0]["content"], r["fact"]) for r in lessons.topic_lessons(answers, topics, owners, F.col("sys")).collect()}
    assert got == {
        (1, "food"): ([("system", "S1"), ("user", "hi Ann"), ("assistant", "I live in a hut, {other}"), ("user", "what food?")], "Ann likes tea", "f1"), (1, "home"): ([("system", "S1"), ("user", "where?")], "a hut", "f2"),
        (2, "food"): ([("system", "S2"), ("user", "hi Bo"), ("assistant", "I live in {home}, {other}"), ("user", "what food?")], "rice", "f1"),
    }


def test_conversation_lessons_and_their_problems(spark):
    owners = spark.createDataFrame([(1, "Ann", "S")], OWNERS)
    u, a = lambda t: ("user", t), lambda t: ("assistant", t)
    rows = [(1, "ok", [u("I am {name}"), a("b"), u("c"), a("d {name}")]), (1, "odd", [u("a"), a("b"), u("c")]), (1, "none", None), (1, "roles", [a("a"), u("b")]), (1, "blank", [u(" "), a("b")]), (1, "twice", [u("a"), a("b")]), (1, "twice", [u("a"), a("b")]), (9, "far", [u("a"), a("b")])]
    found, problems = lessons.conversation_lessons(spark.createDataFrame(rows, f"owner long, id string, turns {TURN}"), owners, F.col("sys"))
    assert sorted((r["id"], r["part"], [x["content"] for x in r["prompt"]], r["completion"][0]["content"]) for r in found.collect()) == [("ok", 0, ["S", "I am Ann"], "b"), ("ok", 1, ["S", "I am Ann", "b", "c"], "d Ann")]
    assert sorted(tuple(r) for r in problems.collect()) == [(1, "blank", "blank"), (1, "none", "odd_turns"), (1, "odd", "odd_turns"), (1, "roles", "roles"), (1, "twice", "duplicate"), (1, "twice", "duplicate")]


def test_style_evidence(spark):
    styles = spark.createDataFrame([(1, "t", [1, 2], "q"), (2, "t", [3], "q"), (3, "t", [4], "q"), (4, "t", [5], "q")], "owner long, table string, keys array<int>, quote string")
    records = spark.createDataFrame([(1, "t", [1, 2], "r1", ["e"], "q"), (2, "t", [3], "r2", ["e"], "q"), (2, "t", [3], "r3", ["e"], "q"), (3, "t", [4], "r4", None, "other")], "owner long, table string, keys array<int>, id string, event_keys array<string>, text string")
    assert {r["owner"]: (r["origin_id"], r["problem"]) for r in lessons.style_evidence(styles, records).collect()} == {1: ("r1", None), 2: (None, "style_not_unique"), 3: (None, "style_changed"), 4: (None, "style_not_unique")}


def test_memories_facts_and_bound_prompts(spark):
    facts = spark.createDataFrame([("sky", "blue", "what colour?", None, None), ("sea", "wet", "how is it?", "nass", "wie?")], "k string, text_en string, cue_en string, text_de string, cue_de string")
    assert [tuple(r) for r in lessons.language_facts(facts, "k", "de").collect()] == [("sea", "nass", "wie?", "world:sea")]
    memories = spark.createDataFrame([(1, 0, "m0", "cue", 1, None, ["x", "y"]), (1, 1, "m1", "cue", 3, 7, ["z"])], "owner long, no int, text string, cue string, level int, story_no int, evidence array<string>")
    got = {r["id"]: ([x["content"] for x in r["prompt"]], r["completion"][0]["content"], r["event_keys"]) for r in lessons.memory_records(memories, F.array(F.lit("m0"), F.lit("m1"), F.lit("m0")), F.concat(F.lit("level "), F.col("level").cast("string"))).collect()}
    assert got == {"self_memory:00000": (["m1\nlevel 1", "cue"], "m0", ["memory:x", "memory:y"]), "self_memory:00001": (["m0\nlevel 3", "cue"], "m1", ["StoryInfo:7"])}
    s, u = ("system", "identity"), ("user", "hi")
    rows = [(1, [s, u], "a"), (2, [s, u, s], None), (3, [u], "a"), (4, [("system", "SpiritId: b\n"), u], "a"), (5, [("system", "SpiritId: a\nmore"), u], "a"), (6, [], "a"), (7, [], None)]
    got = {r["id"]: r["p"] and [tuple(x) for x in r["p"]] for r in spark.createDataFrame(rows, f"id int, m {TURN}, o string").select("id", lessons.bound_prompt(F.col("m"), F.col("o")).alias("p")).collect()}
    own, general = ("system", "SpiritId: a\n"), ("system", "Context: general\n")
    assert got == {1: [own, u], 2: [general, u], 3: None, 4: None, 5: [own, u], 6: None, 7: [general]}
