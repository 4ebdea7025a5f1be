"""Names, slots and registers on literal rows."""

from pyspark.sql import functions as F

from weftline.functions import hashing
from weftline.operators import vocabulary


def test_slots_take_the_longest_term_and_its_follower(spark):
    df = spark.createDataFrame([("Ann Annabel Anna.", ["Ann", "Annabel"]), ("a+b a+b.", ["a+b", "", None]), ("Ann", []), (None, ["x"]), ("Ann", None)], "t string, names array<string>")
    got = [r.x for r in df.select(vocabulary.slotted(F.col("t"), [(F.col("names"), "{n}")]).alias("x")).collect()]
    assert got == ["{n} {n} {n}a.", "{n} {n}.", "Ann", None, "Ann"]
    got = df.select(vocabulary.slotted(F.col("t"), [(F.col("names"), "{n}")], r"\.|$").alias("x")).first().x
    assert got == "Ann Annabel Anna."


def test_forms_are_foreign_unless_canon_holds_them(spark):
    text = spark.createDataFrame([("bobmr, come",), ("bobmr! amy-mr bobmr",), ("amymr, amymr! amymr",), ("amymr. zedmr",), ("joems",), (None,), ("",)], "text string")
    stats = vocabulary.address_statistics(text, "text", "(?<![a-z])([a-z]+)(mr|ms)(?![a-z])", r"\s*(?:[,!.]|$)")
    found = {(r.base, r.suffix): (r.uses, r.vocative_uses) for r in stats.collect()}
    assert found == {("bob", "mr"): (3, 3), ("amy", "mr"): (4, 4), ("zed", "mr"): (1, 1), ("joe", "ms"): (1, 1)}
    canon = spark.createDataFrame([("zedmr",), ("amymr",)], "form string")
    names = spark.createDataFrame([("zed",), ("amy",), (None,)], "word string")
    assert {r.form for r in vocabulary.foreign_forms(stats, canon, names, ["ms"]).collect()} == {"amymr", "joems"}


def test_common_turns(spark):
    df = spark.createDataFrame([(["walked home"],), (["ok", "no 7"],), (["fine", None],), ([],), (None,)], "s array<string>")
    stem = lambda w: F.regexp_replace(w, "ed$", "")
    assert [r.x for r in df.select(vocabulary.is_common_turn(F.col("s"), [r"\d"], "[a-z]+", stem, ["walk"]).alias("x")).collect()] == [False, False, True, False, False]
    assert df.select(vocabulary.is_common_turn(F.col("s"), [], "[a-z]+", stem, []).alias("x")).first().x


def test_a_text_is_rewritten_whole_or_not_at_all(spark):
    df = spark.createDataFrame([(["he goes", " yes "],), (["he goes", "unknown"],), ([" "],), (None,), ([None],)], "s array<string>")
    rewrite = lambda s: vocabulary.rewritten_ending(s, {"yes": "indeed"}, [("goes", "walks"), ("oes", "never")], ["!"])
    assert [r.x for r in df.select(vocabulary.rewritten_text(F.col("s"), rewrite).alias("x")).collect()] == ["he walks indeed", None, None, None, None]


def test_signature_leaves_resources_out():
    one = hashing.settings_signature({"rate": 1, "workers": 4}, {"workers"}, {"train": "ab"}, [("a", 2)])
    assert one == hashing.settings_signature({"workers": 9, "rate": 1}, {"workers"}, {"train": "ab"}, [("a", 2)])
    assert one != hashing.settings_signature({"rate": 2}, {"workers"}, {"train": "ab"}, [("a", 2)])
