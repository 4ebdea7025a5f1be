import corpus_pipeline


def test_exact_stage_keeps_one_row_of_an_id_and_text(spark):
    rows = [(1, "a b", "s"), (2, "a b", "s"), (2, "a b", "t"), (2, "c", "s"), (2, "c", "s"), (None, "d", "s"), (None, "d", "s"), (3, "e", "s"), (4, None, "s"), (4, "", "s")] + [(9, "hot", "s")] * 1500
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = corpus_pipeline.exact(spark, d, "")
    assert out.columns == d.columns
    assert sorted(((r.doc_id or 0, r.text or "") for r in out.collect())) == [(0, "d"), (2, "a b"), (2, "c"), (3, "e"), (4, ""), (9, "hot")]
