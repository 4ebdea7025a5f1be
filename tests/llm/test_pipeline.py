import corpus_pipeline
import pytest

import __spark_entry__ as entry


def test_stages(spark, tmp_path):
    import random

    rng = random.Random(1)
    rows = []
    for i in range(120):
        t = " ".join(rng.choice(["stone", "river", "garden", "walks", "under", "evening"]) + str(rng.randrange(30)) for _ in range(80))
        rows.append((i, t if i % 6 else " ".join(f"{w}$$$" for w in t.split()), "en", f"s{i % 3}", len(t)))
    rows += [(200, rows[1][1], "en", "s1", 1), (201, rows[2][1] + " end", "en", None, 1), (202, None, None, None, None), (203, "", "en", "s0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 6 > 0)) for i in range(120)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert sorted(out.columns) == sorted(docs.columns)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(seen["quality"] & set(range(0, 120, 6))) <= 2 and len(seen["quality"] & {i for i in range(120) if i % 6}) >= 98
    assert 1 not in seen["exact"] and 200 in seen["exact"] and 202 not in seen["exact"]
    assert 2 in seen["near"] and 201 not in seen["near"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == seen["mix"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and [n for n in names if n.startswith("op")] == sorted((n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert len([n for n in names if n.startswith("op")]) == 13
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("k", range(5))
def test_stage_order(k):
    assert [n for n, _ in corpus_pipeline.STAGES][k] == ["quality", "exact", "near", "mix", "pack"][k]
