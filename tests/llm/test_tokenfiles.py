"""Token files: exact round trip, order, stripes and pruning."""

import zlib
from pathlib import Path

import numpy as np
import pyarrow.orc as orc
import pytest

from weftline.llm import queries, tokenfiles

DATA = Path("/root/testdata/sf0.001")
tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tok():
    return tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def plain(tok, docs):
    at, out = 0, []
    for doc, text in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_query_beside_the_library(spark, tok):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    got = queries.op13_token_files(spark, str(DATA)).collect()
    assert sorted(map(tuple, got)) == plain(tok, docs)


def test_odd_rows(spark, tok):
    rows = [(3, "b", 1), (1, None, 1), (2, "", 1), (7, "x" * 50_000 + " <|endoftext|> é日本", 1), (4, "same", 1), (4, "same", 2), (9, "  lead and trail  ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at int").repartition(3)
    got = sorted(map(tuple, tokenfiles.encoded_documents(docs, public.path("byte_bpe_50k.json")).collect()))
    assert got == plain(tok, sorted((r[0], r[1]) for r in rows))
    nulls = spark.createDataFrame([(None, "a"), (5, "b"), (None, "a")], "doc_id long, text string")
    got = tokenfiles.encoded_documents(nulls, public.path("byte_bpe_50k.json")).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r["start"])] == plain(tok, [(None, "a"), (None, "a"), (5, "b")])
    assert tokenfiles.encoded_documents(docs.limit(0), public.path("byte_bpe_50k.json")).count() == 0


def test_one_id_in_several_files(spark, tok, tmp_path):
    """A third of the rows have one id: they are spread, and places still have no gap."""
    rows = [(5 if i % 3 == 0 else i, f"text {i}") for i in range(600)]
    path = str(tmp_path / "t")
    tokenfiles.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, public.path("byte_bpe_50k.json"))
    got = sorted(map(tuple, tokenfiles.document_offsets(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(r[0] for r in rows)
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orc") / "t")
    docs = spark.range(0, 60_000, 2).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 80), i -> cast(xxhash64(id, i) % 9973 AS string))) AS text").coalesce(1)
    tokenfiles.write_tokens(docs, path, public.path("byte_bpe_50k.json"), stripe=1 << 18)
    return path


def read_rows(df):
    """Rows that the scan of an executed plan gave out."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        if "Scan" in p.nodeName():
            found.append(p.metrics().get("numOutputRows").get().value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return rows, sum(found)


def test_stripes_indexes_and_run_lengths(files):
    parts = sorted(Path(files).glob("*.orc"))
    stripes = [orc.ORCFile(p) for p in parts]
    assert sum(f.nrows for f in stripes) == 30_000 and max(f.nstripes for f in stripes) >= 2
    ids = sum(len(v) for f in stripes for v in f.read(columns=["ids"]).column("ids").to_pylist())
    assert sum(p.stat().st_size for p in parts) < 2.2 * ids  # four bytes an id without encoding


def test_scan_is_split_by_stripes(spark, files):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        tasks = tokenfiles.read_tokens(spark, files).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sum(tasks) == 30_000 and sum(n > 0 for n in tasks) > len(list(Path(files).glob("*.orc")))


def test_metadata_leaves_out_row_groups(spark, files):
    plan = tokenfiles.lookup(spark, files, [100])
    assert "PushedFilters: [In" in plan._jdf.queryExecution().toString() or "EqualTo(doc_id,100)" in plan._jdf.queryExecution().toString()
    rows, read = read_rows(plan)
    assert [r["doc_id"] for r in rows] == [100] and read <= 2 * tokenfiles.ROW_GROUP
    rows, read = read_rows(tokenfiles.lookup(spark, files, [100, 59_000]))
    assert sorted(r["doc_id"] for r in rows) == [100, 59_000] and read <= 4 * tokenfiles.ROW_GROUP


def test_bloom_filter_leaves_out_ids_within_the_range(spark, files):
    """Odd ids lie within the ranges of the row groups, so that their filters alone can tell."""
    absent = [1001, 15_001, 30_003, 45_005, 59_001]
    rows, read = zip(*(read_rows(tokenfiles.lookup(spark, files, [i])) for i in absent), strict=True)
    assert not any(rows) and sum(n == 0 for n in read) >= 4
