"""Audits, style profiles, reviewed splits and general records on small rows."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import audits, records, report, split


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reviewed_component_first_beside_the_plain_deal(spark, seed):
    rng = random.Random(seed)
    comp = [c for c in range(60) for _ in range(rng.choice([1, 1, 1, 2, 3, 9]))]
    rows = [(i, c) for i, c in enumerate(comp)]
    reviewed = rng.sample(range(len(rows)), 3) if seed < 3 else []
    df = spark.createDataFrame(rows, "id long, component long")
    ids = spark.createDataFrame([(i,) for i in [*reviewed, 10**6, None]], "id long")
    ratios = (0.6, 0.25, 0.15)
    got = {r["component"]: r["split"] for r in split.leakage_safe_split(df, ratios, 7, ids).collect()}
    order = sorted(set(comp), key=lambda c: (-comp.count(c), hashlib.sha256(f"7|{c}".encode()).hexdigest(), c))
    held = {comp[i] for i in reviewed}
    first = next((c for c in order if c in held), None)
    order.sort(key=lambda c: c != first)
    plain = split.fill_greedily([(c, comp.count(c)) for c in order], ratios, len(comp), first_to_train=first is not None)
    assert got == {c: split.SPLITS[s] for c, s in zip(order, plain, strict=True)}
    assert first is None or got[first] == "train"


def test_empty_splits_are_an_error(spark):
    df = spark.createDataFrame([("train",), ("train",), ("test",)], "split string")
    assert split.require_full_splits(df, (0.8, 0.0, 0.2)) == {"train": 2, "validation": 0, "test": 1}
    with pytest.raises(ValueError, match="validation"):
        split.require_full_splits(df, (0.8, 0.1, 0.1))


@pytest.mark.parametrize(
    ("check", "text", "want"),
    [
        (lambda c: audits.slot_problem(F.array(c), ["{s}"], ["씨"]), "{s} {x} {s}씨", "{x}"),
        (lambda c: audits.slot_problem(F.array(F.lit("fine"), c), ["{s}"], ["씨"]), "{s}씨", "{s}씨"),
        (lambda c: audits.slot_problem(F.array(c), ["{s}"], []), "{s} {s}", "{s} {s}"),
        (lambda c: audits.slot_problem(F.array(c), ["{s}"], ["씨"]), None, None),
        (lambda c: audits.own_slot(F.lit("user"), c, {"user": "{u}", "assistant": "{a}"}), "hi {a} {u}", "{u}"),
        (lambda c: audits.own_slot(F.lit("other"), c, {"user": "{u}"}), "{u}", None),
        (lambda c: audits.source_term(c, ["a.b", "a"], ["xa"]), "xa a.b", "a.b"),
        (lambda c: audits.source_term(c, ["a"], ["xa"]), "xa b", None),
        (lambda c: audits.address_hit(c, "[가-힣]+(?:씨|짱)", ["씨"], ["미나씨"]), "미나씨 유이짱 소라씨", "소라씨"),
        (audits.kana_hit, "abc すき", "すき"),
        (audits.kana_hit, None, None),
        (lambda c: audits.marker_hit(c, ["zz", "b"]), "abc zz", "zz"),
    ],
)
def test_checks_of_a_turn(spark, check, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(check(F.col("t")).alias("r")).first()["r"] == want


def test_problems_of_a_pattern(spark):
    kind = "id int, turns array<struct<role:string,segments:array<string>>>, situation string, topic string, level string"
    u, a = ("user", ["x"]), ("assistant", ["y"])
    rows = [(1, [u, a], "s", "t", "casual"), (2, [a, u], "s", "no", "casual"), (3, [u, ("third", ["x"]), a], "no", "t", "casual"), (4, [u, ("user", [" "]), a], "s", "t", "no"), (5, [u, ("user", []), a], None, None, None), (6, [], "s", "t", None), (7, None, "s", None, "casual")]
    df = spark.createDataFrame(rows, kind)
    found = df.select("id", audits.structure_problem(F.col("turns"), "user", "assistant", ["user", "assistant"]).alias("s"), audits.field_problem(F.col("situation"), F.col("topic"), F.col("level"), {"s": "t"}, ["casual"]).alias("f"))
    assert {r["id"]: (r["s"], r["f"]) for r in found.collect()} == {1: (None, None), 2: ("roles", "topic"), 3: ("unknown_role", "situation"), 4: ("empty_segment", "level"), 5: ("empty_turn", "situation"), 6: ("roles", "level"), 7: ("roles", "topic")}


def test_names_by_join(spark):
    turns = spark.createDataFrame([(1, "see Annas and Bo"), (2, None), (3, "none"), (4, "Bo")], "id int, t string")
    names = spark.createDataFrame([("Anna",), ("Bo",), ("Bo",), (None,)], "name string")
    got = audits.foreign_names(turns, names, ["id"], "t", "[A-Za-z]+", lambda w: F.regexp_replace(w, "s$", ""))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "Annas"), (4, "Bo")]


def test_style_of_an_owner(spark):
    level = F.when(F.col("s").endswith("yo"), "polite").otherwise("casual")
    rows = [("a", "sir I go yo. we go yo."), ("a", "you sir sirs. me me"), ("b", "hm"), ("b", None), (None, "sir"), ("c", "I yo. I yo. me yo")]
    got = report.style_profile(spark.createDataFrame(rows, "o string, t string"), "o", "t", ["sirs", "sir"], {"me": r"\bme\b", "I": r"\bI\b"}, r"\byou\b", level, 3, "none", "me", "one")
    assert {r["o"]: (r["addressed"], r["total"], r["level"], r["address"], r["first_person"], r["uses_second_person"]) for r in got.collect()} == {"a": (True, 4, "polite", "sir", "I", False), "b": (False, 1, "casual", "none", "me", False), "c": (False, 3, "polite", "none", "I", False)}


def test_general_records(spark):
    rows = [("1", [" a ", "b", None, ""], " cue ", "xNeed", ' t"x '), ("2", ["a"], "cue", "xWant", ""), ("3", None, "cue", "other", "t"), ("4", ["a", "b"], None, None, None)]
    df = spark.createDataFrame(rows, "id string, turns array<string>, cue string, relation string, tail string")
    got = sorted((r["id"], r["turns"], r["judgment"]) for r in records.general_records(df, "en", F.lit("train"), "relation").collect())
    assert got == [("1", ["a", "b"], None), ("1:judgment", ["cue"], json.dumps({"decision": 't"x'})), ("4", ["a", "b"], None)]
    two = spark.createDataFrame([("1", ["a"], "cue", "sad"), ("2", ["a"], "cue", "glad")], "id string, turns array<string>, cue string, emotion string")
    assert [(r["id"], r["judgment"]) for r in records.general_records(two, "ko", F.lit("train"), "emotion").collect()] == [("1:judgment", json.dumps({"emotion": "슬픔"}, ensure_ascii=False))]
    assert len(records.EMOTIONS) == 32 and len(records.RELATIONS) == 6


def test_dominant_value_of_every_owner(spark):
    rows = [("a", "x"), ("a", "x"), ("a", None), ("b", "z"), ("b", "y"), ("c", ""), ("c", None), (None, "q"), (None, "q"), ("d", "x"), ("d", ""), ("d", None)]
    got = report.dominant(spark.createDataFrame(rows, "o string, v string"), "o", "v").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("a", "x", 2, 3), ("b", "y", 1, 2), (None, "q", 2, 2)], key=repr)
