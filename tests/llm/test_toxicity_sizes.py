import numpy as np

from weftline.llm import toxicity


def test_toxic_documents_are_found_at_sf001(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = toxicity.scored(docs, toxicity.train(docs, labels)).join(labels.where("toxic is not null").select("doc_id", "toxic"), "doc_id").collect()
    assert np.mean([r.predicted for r in out if r.toxic == 1]) > 0.7
    assert np.mean([r.predicted for r in out if r.toxic == 0]) < 0.01


def test_a_clear_word_scores_at_every_table_size():
    for n1, n0 in [(45, 284), (352, 2803), (20_000, 20_000)]:
        w = toxicity.Weights(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), (n1, n0))
        assert w.log_odds([18], [0], (n1, n0))[0] > 0
        assert w.log_odds([18], [18 * n0 / n1], (n1, n0))[0] < 0
