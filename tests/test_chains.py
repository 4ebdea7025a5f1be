"""Prefixes, quotes and digests beside plain Python."""

import hashlib
import os
import random

import pyarrow as pa
import pytest

from weftline.functions import quotes
from weftline.operators import prefixes
from weftline.sources import digests

TURNS = "conv_id long, turn long, role string, text string"


def test_continuations_beside_plain_prefixes(spark):
    rng = random.Random(6)
    convs = {i: [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None])) for _ in range(rng.randrange(1, 7))] for i in range(120)}
    convs |= {1000 + i: convs[i][: 1 + i % 3] for i in range(60)} | {2000 + i: list(convs[i]) for i in range(0, 60, 4)}
    rows = [(c, t, *x) for c, turns in convs.items() for t, x in enumerate(turns)] + [(None, 0, "user", "a")]
    rng.shuffle(rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in prefixes.continuations(spark.createDataFrame(rows, TURNS)).collect()}
    want = {}
    for c, turns in convs.items():
        same = sorted(k for k, v in convs.items() if v == turns)
        n, first = max(((len(v), -k) for k, v in convs.items() if len(v) < len(turns) and turns[: len(v)] == v), default=(None, None))
        want[c] = (len(turns), len(same), same[0], None if n is None else -first, n)
    assert got == want
    assert prefixes.continuations(spark.createDataFrame([], TURNS)).count() == 0


def test_a_first_turn_that_many_share(spark):
    rows = [(i, 0, "user", "hello") for i in range(400)] + [(i, 1, "assistant", str(i)) for i in range(1, 400)]
    got = prefixes.continuations(spark.createDataFrame(rows, TURNS)).collect()
    assert len(got) == 400 and all((r["continues"], r["shared"]) == ((0, 1) if r["conv_id"] else (None, None)) for r in got)


def test_record_problems(spark):
    kind = "conv long, at int, prompt array<struct<role:string,content:string>>, completion array<struct<role:string,content:string>>"
    u, a = lambda t: ("user", t), lambda t: ("assistant", t)
    rows = [
        (1, 1, [u("q")], [a("r")]), (1, 2, [u("q"), a("r"), u("s")], [a("t")]), (1, 3, [u("q"), a("other"), u("s")], [a("t")]), (1, 4, None, [a("t")]), (1, 5, [u("x"), a("y")], [a("t")]), (1, 6, [u("x")], []), (1, 7, [u("x")], [a("1"), a("2")]), (1, 8, [u("x")], [u("1")]),
        (2, 1, [("system", None), u("q")], [a("r" * 50)]), (2, 2, [("system", None), u("q"), a("r" * 50), u("z")], [a("t" * 99)]), (2, 3, [("system", ""), u("q"), a("r" * 50), u("z"), a("t" * 99), u("e")], [a("f")]),
    ]
    found = prefixes.record_problems(spark.createDataFrame(rows, kind), "conv", "at", most=120)
    assert {(r["conv"], r["at"]): r["problem"] for r in found.collect()} == {
        (1, 1): None, (1, 2): None, (1, 3): "broken_chain", (1, 4): "no_prompt", (1, 5): "last_not_user", (1, 6): "completion_count", (1, 7): "completion_count", (1, 8): "completion_count", (2, 1): None, (2, 2): "too_long", (2, 3): "broken_chain",
    }


def plain_outer(text):
    depth, out = 0, []
    for c in text:
        if c == "「":
            depth += 1
            if depth > 1:
                continue
        elif c == "」" and depth:
            depth -= 1
            if depth:
                continue
        out.append(c)
    return "".join(out)


def test_outer_quotes_beside_a_counter():
    rng = random.Random(12)
    rows = ["".join(rng.choice("「」「」aé日 ") for _ in range(rng.choice([0, 1, 2, 7, 30, 200]))) for _ in range(600)] + [None, "", "「", "」", "」」「「a」"]
    rng.shuffle(rows)
    got = quotes.outer_quotes(pa.array(rows)).to_pylist()
    assert got == [None if r is None else plain_outer(r) for r in rows]
    assert quotes.outer_quotes(pa.array(rows).slice(17, 80)).to_pylist() == got[17:97]
    assert quotes.outer_quotes(pa.array([], pa.string())).to_pylist() == []


@pytest.mark.parametrize(
    ("text", "known", "speaker", "parts"),
    [
        ("미나 「안녕 (웃음) 잘 가」 (손을 흔든다) 밖", None, "미나", [("speech", "안녕"), ("action", "웃음"), ("speech", "잘 가"), ("action", "손을 흔든다"), ("action", "밖")]),
        ("그냥 말", None, None, [("speech", "그냥 말")]),
        ("미나 「a「b」c", None, "미나", [("speech", "abc")]),
        ("미나 「a」", ["유이"], None, [("action", "미나"), ("speech", "a")]),
        ("검(劍) (긴)칼 「x」(※주)", None, "검 긴칼", [("speech", "x")]),
        ("(앉는다) 「」 ()", None, None, [("action", "앉는다")]),
        ("열린 (괄호", None, "열린", [("speech", "괄호")]),
        (None, None, None, None),
        ("", None, None, []),
    ],
)
def test_parts_of_a_turn(spark, text, known, speaker, parts):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "t string").select(quotes.unglossed(F.col("t")).alias("t"))
    s, p = quotes.turn_parts(F.col("t"), known)
    r = df.select(s.alias("s"), p.alias("p")).first()
    assert (r["s"], None if r["p"] is None else [tuple(x) for x in r["p"]]) == (speaker, parts)


def test_digests_of_changed_files_alone(spark, tmp_path):
    data = tmp_path / "in"
    (data / "sub").mkdir(parents=True)
    content = {"a.bin": os.urandom(5000), "sub/b.bin": b"y", "c [1].bin": b"x" * 2000}
    for name, raw in content.items():
        (data / name).write_bytes(raw)
    (data / "empty").write_bytes(b"")

    def tree(raw):
        chunks = [raw[i : i + 1000] for i in range(0, len(raw), 1000)] or [b""]
        return hashlib.sha256("".join(hashlib.sha256(c).hexdigest() for c in chunks).encode()).hexdigest()

    def found(known):
        return {r["path"].rsplit("/in/", 1)[1].replace("%20", " "): (r["digest"], r["was_read"]) for r in digests.file_digests(spark, str(data), known, 1000).collect()}

    first = digests.file_digests(spark, str(data), None, 1000)
    assert found(None) == {n: (tree(raw), True) for n, raw in content.items()}
    known = spark.createDataFrame(first.drop("was_read").collect(), digests.KNOWN)
    assert found(known) == {n: (tree(raw), False) for n, raw in content.items()} and digests.changed_files(spark, str(data), known)[1] == []
    before = digests.folder_digest(known, str(data)).first()
    content["a.bin"] = b"changed" * 700
    (data / "a.bin").write_bytes(content["a.bin"])
    os.utime(data / "a.bin", (1, 1))
    assert [p.rsplit("/", 1)[1] for p in digests.changed_files(spark, str(data), known)[1]] == ["a.bin"]
    again = digests.file_digests(spark, str(data), known, 1000)
    assert found(known) == {n: (tree(raw), n == "a.bin") for n, raw in content.items()}
    after = digests.folder_digest(again, str(data)).first()
    assert before["digest"] != after["digest"] and after["files"] == 3 and after["bytes"] == sum(map(len, content.values()))
