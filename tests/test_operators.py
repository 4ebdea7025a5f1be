"""Operators on small literal tables: the cases that the driver's tables cannot show."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import hashing, text
from weftline.operators import annotate, classify, curriculum, derive, evaluate, graph, report, sequence, split
from weftline.sources import sinks, tables
from weftline.streaming import events


def one(spark, value, column):
    """``column`` over the one value of column t."""
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (text.normalize_text, "  é\r\nb\rc　", "é\nb\nc"),
        (text.normalize_text, None, ""),
        (text.clean_script_text, "<font:red>hi</font> there @1.5\n<sound>x @2 @-3.25 \n", "hi</font> there x"),
        (text.is_empty_text, "　\n", True),
        (text.unquote, '" hi "', "hi"),
        (text.unquote, '"', '"'),
        (text.slug, "--Ab c!9--", "ab_c_9"),
        (text.join_cjk, "你 好 a b 你", "你好 a b 你"),
        (text.clean_roleplay, '*waves* "hi"  ㅋㅋㅋ you', "hi you"),
        (text.sentences, "One. Two?! … three) ", ["One", "Two", "three"]),
        (text.speech_level, "그렇습니다", "formal"),
        (text.speech_level, "그랬슴다", "military"),
        (text.speech_level, "가", "casual"),
        (lambda c: text.with_particle(c, "topic"), "정령", "정령은"),
        (lambda c: text.with_particle(c, "topic"), "나", "나는"),
        (lambda c: text.with_particle(c, "subject"), "abc", "abc가"),
        (lambda c: text.word_stem(c, ["에서", "에"]), "학교에서", "학교"),
        (lambda c: text.word_stem(c, ["에서", "에"]), "집에", "집에"),
        (text.call_name, "Ann (cook)", "Ann"),
        (text.collapse_slots, "{a} {a}{a} {b}", "{a} {b}"),
        (lambda c: text.corrected(c, [("x", ["a", "b"]), ("y", ["xx"])]), "ab", "y"),
        (lambda c: text.section_after(c, "## bio"), "x\n## bio \n\n tall\nshort", "tall"),
        (lambda c: text.name_forms(c, ["님"]), "Anna B", ["Anna B", "Anna B님", "Anna", "Anna님"]),
        (text.quoted_parts, "“a “b” (gloss) c” d “e”", ["a b  c", "e"]),
        (lambda c: text.is_placeholder(c, ("tmp",), ("label.",)), "label._x", True),
        (lambda c: text.is_placeholder(c, ("tmp",), ("label.",)), "labelx_x", False),
        (evaluate.degenerate, " ", "empty_response"),
        (evaluate.degenerate, "a b a a c", "repetition_collapse"),
        (evaluate.degenerate, "ababababababababab", "character_collapse"),
        (evaluate.degenerate, "all is well here", None),
        (lambda c: evaluate.first_hit(c, ["AI", "bot"]), "a Bot, an ai", "AI"),
        (evaluate.number_answer, " 2 .", 2),
        (evaluate.number_answer, "2 or 3", None),
        (lambda c: evaluate.number_answer(c, ["개"], {"두개": 2, "둘": 2}), "2 개.", 2),
        (lambda c: evaluate.number_answer(c, ["개"], {"두개": 2, "둘": 2}), "두 개!", 2),
        (lambda c: evaluate.number_answer(c, ["개"], {"두개": 2, "둘": 2}), "둘다", None),
    ],
)
def test_text(spark, f, value, want):
    assert one(spark, value, f) == want


def test_segments(spark):
    got = one(spark, 'hi *waves* "you" * *  * x', text.segments)
    assert [(s.kind, s.text) for s in got] == [("speech", "hi"), ("action", "waves"), ("speech", "you"), ("speech", "* x")]


def test_json_text_is_what_the_standard_library_writes(spark):
    import json

    from weftline.operators import records

    rows = ["".join(chr(i) for i in range(256)), "\x0b\x0b\x1f", "\\u000B", "\\\\u001F\x1f\\\x1f", 'q"\\', "é日\u2028", ""]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string").select("i", records.json_text(F.col("t")).alias("j")).orderBy("i").collect()
    assert [r.j for r in got] == [json.dumps(r, ensure_ascii=False) for r in rows]


def test_hashes(spark):
    rows = spark.createDataFrame([(f"k{i}",) for i in range(200)], "k string").select("k", hashing.stable_index(F.col("k"), 97).alias("i"), hashing.permille(F.col("k")).alias("p")).collect()
    for r in rows:
        d = hashlib.sha256(r.k.encode()).digest()
        assert r.i == int.from_bytes(d[:8], "big") % 97 and r.p == int.from_bytes(d[:4], "big") % 1000


def turns(spark, roles, key=1):
    return spark.createDataFrame([(key, i, r, f"t{i}") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")


def test_runs_and_exchanges(spark):
    t = turns(spark, ["user", "user", "assistant", "assistant", "user", "system", "assistant", "user"])
    assert [r.run for r in sequence.role_runs(t).orderBy("turn").collect()] == [1, 1, 2, 2, 3, 4, 5, 6]
    e = sequence.exchanges(t).orderBy("turn").collect()
    assert [r.exchange for r in e] == [0, 0, 0, 0, 1, 1, 1, 2] and [r.answered for r in e] == [True] * 7 + [False]


def test_history_bounds(spark):
    t = turns(spark, ["assistant", *["user", "assistant"] * 8])
    for r in sequence.history(t).collect():
        assert 0 < len(r.history) <= 8 and r.history[0].role == "user" and r.history[-1].role == "user"
        assert r.history[-1].content == f"t{r.turn - 1}"


def test_common_runs(spark):
    t = turns(spark, ["assistant", "user", "assistant", "user", "system", "user", "user", "assistant", "user"])
    got = sequence.common_runs(t, F.col("role") != "system").orderBy("start").collect()
    assert [(r.start, r.end) for r in got] == [(1, 2), (5, 7)]


def test_micro_batches(spark):
    from weftline.operators import batches

    rng = random.Random(1)
    widths = [rng.randrange(1, 60) for _ in range(80)]
    df = spark.createDataFrame([("o", i, w) for i, w in enumerate(widths)], "owner string, id long, w long")
    want, n, wide = [], 0, 0
    for w in widths:
        if n and (n == 6 or (n + 1) * max(wide, w) > 150):
            want.append((n, wide))
            n, wide = 0, 0
        n, wide = n + 1, max(wide, w)
    want.append((n, wide))
    got = batches.micro_batches(df, "owner", "id", "w", 6, 150).orderBy("batch").collect()
    assert [(r.n, r.width) for r in got] == want and all(r.n * r.width <= 150 or r.n == 1 for r in got)


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 300)] + [(rng.randrange(400, 460), rng.randrange(400, 460)) for _ in range(50)] + [(9, 9), (None, 3)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges[:-1]:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: top(x) for x in root}
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_are_transitive(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "b"), (3, None, "b"), (4, None, None)], "id long, k string, l string")
    got = {r.id: r.component for r in split.record_components(df, "id", [F.concat(F.lit("k"), "k"), F.concat(F.lit("l"), "l")]).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_greedy_fill():
    assert split.fill_greedily([("a", 5), ("b", 3), ("c", 2), ("d", 1), ("e", 1)], (0.6, 0.2, 0.2), 12) == [0, 1, 2, 0, 0]
    assert split.fill_greedily([("a", 10), ("b", 1), ("c", 1)], (0.9, 0.05, 0.05), 12) == [0, 1, 2]
    with pytest.raises(ValueError, match="ratios"):
        split.check_ratios((0.5, 0.6, 0.1))


def test_split_of_many_equal_components(spark):
    comp = spark.createDataFrame([(i, i // 3) for i in range(3000)], "id long, component long")
    s = split.leakage_safe_split(comp)
    assert s.count() == 1000 and s.select("component").distinct().count() == 1000
    rows = {r["split"]: r["sum(size)"] for r in s.groupBy("split").sum("size").collect()}
    assert abs(rows["train"] - 2550) <= 6 and abs(rows["validation"] - 300) <= 6 and abs(rows["test"] - 150) <= 6


def test_fill_by_size_deals_as_one_by_one_does():
    g = random.Random(4)
    for ratios in [(0.85, 0.1, 0.05), (0.5, 0.25, 0.25), (0.2, 0.3, 0.5), (1, 0, 0), (0, 0.5, 0.5), (0.98, 0.01, 0.01)]:
        for _ in range(60):
            sizes = sorted((g.choice([1, 1, 1, 2, 3, 8, 40]) for _ in range(g.choice([0, 1, 2, 3, 4, 5, 30, 200]))), reverse=True)
            runs = [(n, sizes.count(n)) for n in sorted(set(sizes), reverse=True)]
            dealt = []
            plan = split.fill_by_size(runs, ratios)
            for n, k in runs:
                turns = [(at, turn) for m, at, turn in plan if m == n]
                for place in range(k):
                    at, turn = [t for t in turns if t[0] <= place][-1]
                    dealt.append(turn[(place - at) % len(turn)])
            assert dealt == split.fill_greedily(list(enumerate(sizes)), ratios, sum(sizes)), (sizes, ratios)


def test_split_of_no_rows(spark):
    assert split.leakage_safe_split(spark.createDataFrame([], "id long, component long")).count() == 0


def test_owners_and_ids_may_be_null(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 2, 3), (None, 4, 7), (None, None, 2)], "owner string, id long, n int")
    got = sorted((r.owner or "", r.id or 0, r.offset) for r in curriculum.token_offsets(df, "owner", "id", "n").collect())
    assert [g[:2] for g in got] == [("", 0), ("", 4), ("a", 1), ("a", 2), ("a", 2)]
    assert [g[2] for g in got[:3]] == [0, 2, 0] and got[3][2] == 5 and got[4][2] in (5, 8)
    some = curriculum.sample_per_owner(df, "owner", "id", F.least(F.col("available") - 1, F.lit(2)))
    assert {(r.owner, r["count"]) for r in some.groupBy("owner").count().collect()} == {("a", 2), (None, 1)}
    assert {r.pool for r in curriculum.length_batches(df, "owner", "id", "n").collect()} == {0}


def test_annotations_must_be_used(spark):
    r, n = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(2, "x"), (3, "y")], "k long, note string")
    merged = annotate.annotation_merge(r, n, "k")
    assert {x.k: x.state for x in merged.collect()} == {1: "unannotated", 2: "matched", 3: "unused"}
    with pytest.raises(ValueError, match="without a record"):
        annotate.require_all_used(merged, "k")
    with pytest.raises(ValueError, match="not unique"):
        annotate.require_unique(n.unionByName(n), "k", "note")


def test_aliases(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "id long, keys array<string>")
    aliases = spark.createDataFrame([("a", "x"), ("a", "b"), ("x", "y")], "key string, alias string")
    assert {r.id: r["keys"] for r in annotate.expand_aliases(rows, aliases, "id", "keys").collect()} == {1: ["a", "b", "x"], 2: ["c"]}


def test_gate_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "he is 12 years old"), (3, None)], "id long, text string")
    ok, bad = classify.gate(df, F.when(classify.stated_age_under(F.col("text"), 18), "age"), "gate", ["id"])
    assert [r.id for r in ok.orderBy("id").collect()] == [1, 3] and [(r.id, r.reason) for r in bad.collect()] == [(2, "age")]


def test_report(spark):
    df = spark.createDataFrame([("o", "a"), ("o", "a"), ("o", None), ("o", "b"), ("p", "a"), ("p", None), ("p", "")], "owner string, v string")
    assert [(r.owner, r.v, r.n) for r in report.dominant(df, "owner", "v").collect()] == [("o", "a", 2)]
    a = report.dataset_digest(df).first().digest
    assert a == report.dataset_digest(df.repartition(5)).first().digest != report.dataset_digest(df.limit(3)).first().digest


def test_derive(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"], "c", "L")], "core array<string>, target string, level string")
    assert df.select(derive.composed_memory(F.col("core"), F.col("target"), F.col("level")).alias("x")).first().x == ["a", "b", "L"]
    x = spark.createDataFrame([(2, [1, 2, 3])], "p int, ids array<int>").select(curriculum.label_mask(F.col("p"), F.col("ids")).alias("m"), curriculum.pad(F.col("ids"), F.lit(5)).alias("w")).first()
    assert x.m == [-100, -100, 3] and x.w == [1, 2, 3, 0, 0]


def test_sources_and_sinks(spark, tmp_path):
    import gzip

    (tmp_path / "a.json").write_text(json.dumps([{"x": 1}, {"x": 2}]))
    assert sorted(r.x for r in tables.json_array(spark, str(tmp_path / "a.json"), "x int").collect()) == [1, 2]
    (tmp_path / "l.jsonl").write_text('{"x": 1}\n\n{bad\n{"x": 3}\n')
    rows, bad = tables.json_lines(spark, str(tmp_path / "l.jsonl"), "x int", "key")
    assert sorted(r.x for r in rows.collect()) == [1, 3] and [r.line for r in bad.collect()] == ["{bad"]
    with gzip.open(tmp_path / "t.gz", "wt") as f:
        f.write('["a", "b"]\n["c"]\n')
    assert sorted(r.turns for r in tables.array_lines(spark, str(tmp_path / "t.gz"))[0].collect()) == [["a", "b"], ["c"]]
    (tmp_path / "d.txt").write_text("# note\nk\tv w\nk\tz\n\nq\t\n")
    assert [(r.key, r.value) for r in tables.dictionary(spark, str(tmp_path / "d.txt")).collect()] == [("k", "v")]
    (tmp_path / "p").mkdir()
    for n, t in (("a", '{"id": 1, "name": "x"}'), ("b", '{"id": 2}'), ("c", "{")):
        (tmp_path / "p" / f"{n}.json").write_text(t)
    good, wrong = tables.persona_files(spark, str(tmp_path / "p"), "id int, name string", ["id", "name"])
    assert [r.id for r in good.collect()] == [1] and sorted(r.missing for r in wrong.collect()) == [["id", "name"], ["name"]]
    with pytest.raises(KeyError):
        tables.Catalogue({}).read(spark, "x")
    t = turns(spark, ["user", "assistant", "user"])
    back = tables.exploded_turns(tables.conversations_as_arrays(t)).orderBy("turn").collect()
    assert [(r.role, r.text) for r in back] == [("user", "t0"), ("assistant", "t1"), ("user", "t2")]
    df = spark.createDataFrame([("s", "en", "train", "é"), ("s", "en", "test", None)], "owner string, language string, split string, text string")
    assert sinks.corpus(df, str(tmp_path / "c"), ["owner", "split"]).count() == 2
    sinks.json_lines(df, str(tmp_path / "j"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "j")).collect())[1].endswith('"text":"é"}')
    sinks.fan_out(df, str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).count() == 2


def test_streams(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", "a", 1.0), (1, "2024-01-01 00:10:00", "a", 2.0), (1, "2024-01-01 05:00:00", "b", 3.0)], "user_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    q = events.tumbling(stream).writeStream.format("memory").queryName("tumble").outputMode("update").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert sorted((r.event_type, r.n) for r in spark.table("tumble").collect()) == [("a", 2), ("b", 1)]
    assert sorted(r.n for r in events.sessions(df).collect()) == [1, 2]
    t = turns(spark, ["user", "assistant"] * 6)
    t.write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema(t.schema).parquet(str(tmp_path / "t"))
    q = events.conversation_state(stream, 4, idle_ms=None).writeStream.format("memory").queryName("state").outputMode("update").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    r = spark.table("state").first()
    assert r.turns == 12 and r.history.count("\n") == 3


def test_short_items_are_found(spark):
    from weftline.operators import containment

    docs = spark.createDataFrame([(1, "one two three"), (2, "solo"), (3, None), (4, "xsolox alpha beta gamma."), (5, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two"), (2, "solo"), (3, "alpha beta gamma"), (4, ""), (5, None), (6, "solo")], "item_id long, text string")
    got = sorted((r.item_id, r.doc_id) for r in containment.containing(docs, items).collect())
    assert got == [(1, 1), (2, 2), (2, 4), (3, 4), (6, 2), (6, 4)]
    assert containment.containing(docs, items.limit(0)).count() == 0
