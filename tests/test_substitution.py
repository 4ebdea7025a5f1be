"""Substitution by owners' tables beside a plain scan."""

import random

import pytest

from weftline.operators import substitution

PAIRS = [("은", "는"), ("이", "가"), ("을", "를"), ("이랑", "랑"), ("아", "야"), ("이에요", "예요")]


def plain(text, table, agree):
    out, i = [], 0
    while text is not None and i < len(text):
        form = next((text[i : i + n] for n in range(len(text) - i, 0, -1) if text[i : i + n] in table), None)
        if form is None:
            out.append(text[i])
            i += 1
            continue
        out.append(table[form])
        i += len(form)
        mark = next((m for m in sorted({p for v in PAIRS for p in v}, key=lambda p: (-len(p), p)) if text.startswith(m, i)), None) if agree else None
        if mark and not "가" <= text[i + len(mark) : i + len(mark) + 1] <= "힣":
            closed = "가" <= out[-1][-1:] <= "힣" and (ord(out[-1][-1]) - 0xAC00) % 28 > 0
            out.append(next(v for v in PAIRS if mark in v)[0 if closed else 1])
            i += len(mark)
    return None if text is None else "".join(out)


@pytest.mark.parametrize("agree", [True, False])
def test_owners_tables(spark, agree):
    rng = random.Random(3)
    letters = "abc가는을이랑 .강나"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    tables = {o: {word(rng.randrange(1, 4)): word(rng.randrange(0, 4)) for _ in range(rng.randrange(1, 12))} for o in range(8)}
    texts = [(rng.choice([*range(10), None]), i, word(rng.choice([0, 1, 5, 40, 300])), "kept") for i in range(200)] + [(1, 900, None, None), (1, 901, "", "x")]
    names = [(o, f, t) for o, table in tables.items() for f, t in table.items()] + [(None, "a", "X"), (2, "", "X"), (2, None, "X"), (2, "zzz", None)]
    df = spark.createDataFrame(texts, "owner long, id long, text string, form string")
    got = substitution.replaced_by_owner(df, spark.createDataFrame(names, "owner long, form string, target string"), "owner", "text", agree, part=7)
    assert got.columns == df.columns
    rows = {r["id"]: (r["owner"], r["text"], r["form"]) for r in got.collect()}
    assert rows == {i: (o, plain(t, tables[o], agree) if o in tables else t, f) for o, i, t, f in texts}


def test_stages_ties_and_empty_tables(spark):
    names = spark.createDataFrame([("o", 1, "X", "pq"), ("o", 0, "ab", "X"), ("o", 0, "abc", "Y"), ("o", 0, "ab", "Z"), ("o", 2, "pq", "Q")], "owner string, stage int, form string, target string")
    df = spark.createDataFrame([("o", "abcab", 1), ("o", "abcab", 1), ("p", "abcab", 2)], "owner string, text string, target int")
    assert sorted((r["owner"], r["text"], r["target"]) for r in substitution.replaced_by_owner(df, names, "owner", "text").collect()) == [("o", "YQ", 1), ("o", "YQ", 1), ("p", "abcab", 2)]
    assert substitution.replaced_by_owner(df.limit(0), names, "owner", "text").count() == 0
    assert sorted(r["text"] for r in substitution.replaced_by_owner(df, names.limit(0), "owner", "text").collect()) == ["abcab"] * 3


def test_name_forms_in_order(spark):
    names = spark.createDataFrame([(1, "Anna B Lee", "A"), (2, None, "N"), (3, "", "E"), (4, "Bo", "B")], "id long, name string, target string")
    got = substitution.name_forms(names, "id", "name", "target", ["님"]).orderBy("id", "place").collect()
    assert [r["form"] for r in got if r["id"] == 1] == ["Anna B Lee님", "Anna B Lee", "Anna님", "Anna", "Lee님", "Lee"]
    assert [r["form"] for r in got if r["id"] == 4] == ["Bo님", "Bo"]
