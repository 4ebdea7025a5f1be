"""Settings, named functions, catalogue, label records and encodings on small rows."""

from dataclasses import dataclass, field

import pytest
from pyspark.sql import functions as F

from weftline.functions import registry
from weftline.operators import behaviour, curriculum
from weftline.sources import settings, tables


@dataclass(frozen=True)
class Ratios:
    train: float
    test: float = 0.0


@dataclass(frozen=True)
class Run:
    name: str
    steps: int
    ratios: Ratios
    languages: list[str] = field(default_factory=list)
    limit: int | None = None

    def check(self):
        if self.steps < 1:
            raise ValueError("steps must be positive")


def test_typed_settings(tmp_path):
    (tmp_path / "s.json").write_text('{"name": "a", "steps": 3, "ratios": {"train": 1}, "languages": ["ko"], "limit": null}')
    assert settings.read_settings(Run, str(tmp_path / "s.json")) == Run("a", 3, Ratios(1.0), ["ko"])
    good = {"name": "a", "steps": 3, "ratios": {"train": 0.5}}
    for change, words in [({"stepz": 1}, "unknown"), ({"steps": "3"}, "whole number"), ({"steps": True}, "whole number"), ({"steps": 0}, "positive"), ({"ratios": {}}, "missing"), ({"ratios": 1}, "mapping"), ({"languages": "ko"}, "list"), ({"languages": [1]}, "text"), ({"limit": 1.5}, "whole number")]:
        with pytest.raises(ValueError, match=words):
            settings.typed(Run, good | change)
    with pytest.raises(ValueError, match="missing"):
        settings.typed(Run, {})


def test_functions_by_name(spark):
    df = spark.createDataFrame([("A  b",), (None,)], "t string")
    got = registry.applied(df, {"s": ("slug", "t"), "p": ("preview", "t", 2)}).collect()
    assert sorted(map(tuple, got), key=repr) == [("A  b", "a_b", "A "), (None, None, None)]
    with pytest.raises(KeyError, match="nothing"):
        registry.applied(df, {"x": ("nothing", "t")})
    with pytest.raises(ValueError, match="slug"):
        registry.register("slug", F.lower)


def test_catalogue(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, None)], "k long, t string").write.parquet(str(tmp_path / "p"))
    both = tables.Catalogue({"talk": {"path": str(tmp_path / "p"), "licence": "cc0", "id": "k", "prefix": "ext:"}, "gone": {"path": str(tmp_path / "none")}})
    assert sorted((r["source_id"], r["source_name"], r["licence"]) for r in both.read(spark, "talk").collect()) == [("ext:1", "talk", "cc0"), ("ext:2", "talk", "cc0")]
    with pytest.raises(KeyError, match="other"):
        both.read(spark, "other")
    with pytest.raises(FileNotFoundError, match="gone"):
        both.require(spark)
    first, again = (both.digest(spark, "talk").first() for _ in range(2))
    assert first == again and first["files"] >= 1


def test_label_records(spark):
    kind = "id string, task string, prompt array<struct<role:string,content:string>>, completion array<struct<role:string,content:string>>, judgment struct<activated_memory:array<string>,decision:string,action:string>, record_key string"
    p, c = [("system", "a\nb"), ("user", "old"), ("user", "q")], [("assistant", "said")]
    rows = [("1", "persona_speech", p, c, (["b", "m"], 'd"', "x"), "k"), ("2", "persona_speech", p, c, (None, "d", "x"), "k"), ("3", "persona_speech", p, c, ([], "", "x"), "k"), ("4", "other", p, c, ([], "d", "x"), "k"), ("5", "persona_speech", [], c, ([], "d", "x"), "k"), ("6", "persona_speech", p, c, None, "k")]
    got = behaviour.with_behaviour(spark.createDataFrame(rows, kind), ["decision", "action"], "why").collect()
    made = [r for r in got if r["task"] == behaviour.BEHAVIOUR]
    assert len(got) == 7 and [r["id"] for r in made] == ["1:judgment"]
    assert [x["content"] for x in made[0]["prompt"]] == ["a\nb\nm", "old", "why\nq"] and made[0]["completion"][0]["content"] == '{"decision":"d\\"","action":"x"}' and made[0]["origin_id"] == "1"


def test_encodings(spark):
    rows = [(1, [1, 2], [1, 2, 3]), (2, [1, 2], [1, 2]), (3, [2], [1, 2]), (4, [], [1]), (5, None, [5, 6]), (6, [1], None), (7, [1], [1, 2, 3, 4, 5])]
    got = behaviour.encoded(spark.createDataFrame(rows, "i int, p array<int>, x array<int>"), "p", "x", 4).collect()
    assert {r["i"]: (r["problem"], r["labels"]) for r in got} == {1: (None, [-100, -100, 3]), 2: ("not_a_prefix", None), 3: ("not_a_prefix", None), 4: (None, [1]), 5: (None, [5, 6]), 6: ("not_a_prefix", None), 7: ("too_long", None)}


def test_batches_keep_their_rows_when_shuffled(spark):
    df = spark.createDataFrame([(o, i, (i * 37) % 11) for o in ("a", None) for i in range(60)], "o string, id long, n long")
    batches = curriculum.length_batches(df, "o", "id", "n", batch=4, pool_batches=3)
    got = curriculum.shuffled_batches(batches, "o").collect()
    assert len(got) == 120
    for owner in ("a", None):
        mine = [r for r in got if r["o"] == owner]
        steps = {(r["pool"], r["batch"]): r["step"] for r in mine}
        assert sorted(steps.values()) == list(range(len(steps))) and len({(r["pool"], r["batch"], r["step"]) for r in mine}) == len(steps)
