"""Lanes and annotations on small fixtures."""

from pyspark.sql import functions as F

from weftline.operators import annotate, lanes
from weftline.operators.lanes import Lane, Lookup


def test_first_lookup_that_resolves(spark):
    rows = [(1, "a", "k1", "x1"), (2, "b", "gone", "x1"), (3, "c", None, None), (4, "", "k1", None), (5, "e", "bad", "x2"), (6, "f", "void", "x9"), (1, "a", "k1", "x1"), (None, "n", "k1", None)]
    df = spark.createDataFrame(rows, "id long, text string, k string, x string")
    first = spark.createDataFrame([("k1", "one", None), ("k1", "two", None), ("bad", "no", "guide"), ("void", "", None), (None, "never", None)], "key string, value string, reason string")
    second = spark.createDataFrame([("x1", "far"), ("x2", "near")], "key string, value string")
    lane = Lane("l", df, F.col("id"), F.col("text"), [("empty", F.col("text") == "")], [Lookup("first", F.col("k"), "<{value}>"), Lookup("second", F.col("x"))])
    got = lanes.read_lanes([lane], {"first": first, "second": second})
    rows = sorted(((r["record_id"], r["situation"], r["source"], r["reason"], [(m["source"], m["reason"]) for m in r["misses"]]) for r in got.collect()), key=repr)
    assert rows == sorted(
        [
            ("1", "<one>", "first", None, []), ("1", "<one>", "first", None, []), ("2", "far", "second", None, [("first", "no_row")]), ("3", None, None, "unverified_trigger", [("first", "no_key"), ("second", "no_key")]),
            ("4", None, None, "empty", []), ("5", "near", "second", None, [("first", "guide")]), ("6", None, None, "unverified_trigger", [("first", "no_value"), ("second", "no_row")]), (None, "<one>", "first", None, []),
        ],
        key=repr,
    )
    assert lanes.accepted(got).count() + lanes.skipped(got).count() == df.count()


def test_lanes_without_lookups_sources_or_rows(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id long, text string, reason int")
    plain = Lane("plain", df, F.col("id"), F.col("text"), default=F.concat(F.lit("at "), F.col("reason").cast("string")))
    bare = Lane("bare", df, F.col("id"), F.col("text"))
    got = sorted((r["lane"], r["situation"] or "", r["reason"] or "") for r in lanes.read_lanes([plain, bare], {}).collect())
    assert got == [("bare", "", "unverified_trigger"), ("bare", "", "unverified_trigger"), ("plain", "at 5", ""), ("plain", "at 6", "")]
    none = Lane("none", df.limit(0), F.col("id"), F.col("text"), lookups=[Lookup("s", F.col("id"))])
    assert lanes.read_lanes([none], {"s": df.select(F.col("id").alias("key"), F.col("text").alias("value"))}).count() == 0


def test_a_hot_key_and_many_records(spark):
    df = spark.range(3000).select("id", F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    source = spark.range(-1, 1500).select(F.col("id").alias("key"), F.col("id").alias("value"))
    got = lanes.read_lanes([Lane("l", df, F.col("id"), F.col("text"), lookups=[Lookup("s", F.col("k"))])], {"s": source})
    assert lanes.accepted(got).where("situation = '-1'").count() == 1000 and got.count() == 3000
    assert lanes.skipped(got).count() == df.where("k >= 1500").count()


NOTE = "record_key long, annotation_kind string, reason string, evidence array<string>, evidence_key long, judgment struct<activated_memory:array<string>,interpretation:string,decision:string,emotion:string,intention:string,action:string,evidence:array<string>>"


def test_annotations_exclude_enrich_and_must_be_used(spark):
    rows = spark.createDataFrame([(1, "talk", "t", 1, "I said so", "ctx one", ["m"]), (2, "talk", "t", 1, "he spoke", "ctx two", ["m"]), (3, "talk", "t", 2, "far", "ctx three", None), (4, "talk", "t", 2, "x", None, ["m"]), (5, "talk", "t", 3, None, "ctx", ["m"])], "record_key long, kind string, table string, episode int, speech string, context string, memory array<string>")
    ok = (["m"], "i", "d", "e", "n", "a", ["ctx"])
    notes = [
        (1, "non_self_speech", "why", ["he spoke"], 2, None), (2, None, None, None, None, ok), (3, "non_self_speech", "w", ["I said"], 1, None), (4, "j", None, None, None, ok), (5, "j", None, None, None, (["m", "?"], "i", "d", "e", "n", "a", ["ctx"])), (9, "j", None, None, None, ok),
    ]
    n = spark.createDataFrame(notes, NOTE)
    kept, excluded, problems = annotate.apply_annotations(rows, n)
    assert {r["record_key"]: r["judgment"] is not None for r in kept.collect()} == {2: True, 3: False, 4: False, 5: False}
    assert [(r["record_key"], r["detail"], r["preview"]) for r in excluded.collect()] == [(1, "why", "I said so")]
    assert {r["record_key"]: r["problem"] for r in problems.collect()} == {3: "other_episode", 4: "not_in_context", 5: "unknown_memory", 9: "no_record"}
    kept, excluded, problems = annotate.apply_annotations(rows, n.where("record_key in (1, 2)"), learn=False)
    assert {r["record_key"]: r["judgment"] for r in kept.collect()} == dict.fromkeys([2, 3, 4, 5]) and excluded.count() == 1 and problems.count() == 0
    twice = annotate.apply_annotations(rows, n.where("record_key = 2").unionByName(n.where("record_key = 2")))
    assert [r["problem"] for r in twice[2].collect()] == ["repeated", "repeated"] and twice[0].count() == 5
    empty = annotate.apply_annotations(rows, n.limit(0))
    assert empty[0].count() == 5 and empty[1].count() == empty[2].count() == 0
