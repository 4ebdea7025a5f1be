import itertools
import random
import zlib

import numpy as np
import pytest

from weftline.llm import pseudolik, quality, toxicity
from weftline.llm.textkernel import words

WORDS = ["stone", "river", "little", "garden", "walks", "under", "evening", "light", "the", "of", "and"]


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(WORDS) for _ in range(rng.randrange(30, 120))]
        toxic, junk = i % 5 == 0, i % 7 == 0
        if toxic:
            w[10:10] = [rng.choice(["vile", "scum", "moron"]) for _ in range(4)]
        if junk:
            w = [f"{x}$$$" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, 0 if junk else 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame([(i, t, 0.0, 1) for i, t in docs], "doc_id long, text string, score double, label int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


MESSY = [(None, "x"), (1001, None), (1002, ""), (1003, " \n\t"), (1004, "é" * 40_000), (1005, "a " * 60_000), (1005, "a " * 60_000), (1006, "\x00\x00"), (1007, "moron " * 9)]


@pytest.mark.parametrize(("op", "label"), [(toxicity, "toxic"), (quality, "quality")])
def test_learns_and_survives(spark, op, label):
    docs, labels = corpus()
    d, y = frames(spark, docs + MESSY, [*labels, (1007, None, None), (None, 1, 1), (3, 1, 0)])
    model = op.train(d, y)
    out = op.scored(d, model).collect()
    assert len(out) == len(docs) + len(MESSY) and all(0 <= r.score <= 1 for r in out)
    truth = {i: (q, t)[label == "toxic"] for i, q, t in labels}
    held = [r for r in out if r.doc_id is not None and r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    if op is toxicity:
        assert next(r for r in out if r.doc_id == 1007).predicted == 1
    empty = op.scored(d.limit(0), model)
    assert empty.count() == 0
    none = op.train(d, y.limit(0))
    assert {r.predicted for r in op.scored(d, none).collect()} <= {0, 1}


def test_keep_good_keeps_columns(spark):
    docs, labels = corpus()
    d, y = frames(spark, docs + MESSY, labels)
    kept = quality.keep_good(d, quality.train(d, y))
    assert kept.columns == d.columns
    ids = {r.doc_id for r in kept.collect()}
    good = {i for i, q, _ in labels if q}
    assert len(good - ids) <= 2 and len(ids & {i for i, q, _ in labels if not q}) <= 8


def test_network_is_the_same_in_any_batch():
    net = quality.Net.fresh(1)
    texts = [b"", b"a", b"x" * 127, b"y" * 128, b"z" * 129, bytes(range(256)) * 5, b"hello world " * 40]
    offs = np.cumsum([0] + [len(t) for t in texts])
    together = quality.logits(net, np.frombuffer(b"".join(texts), np.uint8), offs)
    alone = [quality.logits(net, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-4)


def test_segments_are_maximal():
    rng = random.Random(2)
    for _ in range(200):
        s = np.array([rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rng.randrange(1, 14))], float)

        def split(a, b, s=s):  # the definition: the best segment, then the same on both sides
            best = max(((s[i:j].sum(), -(j - i), -i, i, j) for i, j in itertools.combinations(range(a, b + 1), 2)), default=None)
            if best is None or best[0] <= 0:
                return []
            i, j = best[3], best[4]
            return [*split(a, i), (i, j, best[0]), *split(j, b)]

        got = toxicity.maximal_segments(s)
        assert [x[2] for x in got] == [x[2] for x in split(0, len(s))]
        assert all(s[a:b].sum() == v for a, b, v in got)


def test_pseudo_likelihood(spark):
    docs, _ = corpus(200)
    rng = random.Random(5)
    shuffled = [(i + 5000, " ".join(rng.sample(t.split(), len(t.split())))) for i, t in docs]
    ordered = [(i, " ".join(itertools.islice(itertools.cycle(["the", "river", "walks", "under", "light"]), 60))) for i, _ in docs]
    d = spark.createDataFrame([(i, t, 1) for i, t in ordered + shuffled + MESSY], "doc_id long, text string, n_words int")
    model = pseudolik.train(d, rounds=6, stride=1, known=20)
    out = pseudolik.scored(d, model).collect()
    assert len(out) == 400 + len(MESSY)
    by = {r.doc_id: r for r in out}
    for i, t in ordered[:20] + MESSY[1:6]:
        assert by[i].n_words == len((t or "").split()) and (by[i].mean_log_probability is None) == (by[i].n_words == 0)
    mean = lambda rows, by=by: np.mean([by[i].mean_log_probability for i, _ in rows])
    assert mean(ordered) > mean(shuffled) + 0.3
    # texts that it was not trained on: well above single words
    fresh = spark.createDataFrame([(i, " ".join(itertools.islice(itertools.cycle(["the", "river", "walks", "under", "light"]), i % 5, 40 + i % 5)), 1) for i in range(50)], d.schema)
    got = [r.mean_log_probability for r in pseudolik.scored(fresh, model).collect()]
    alone = [r.mean_log_probability for r in pseudolik.scored(fresh, pseudolik.train(d, rounds=0, known=20)).collect()]
    assert np.mean(got) > np.mean(alone) + 0.5
    assert pseudolik.scored(d.limit(0), pseudolik.train(d.limit(0))).count() == 0


def test_scores_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(pseudolik, "SHARD", 5000)
    docs, _ = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    one, two = [{r.doc_id: r.pseudo_log_likelihood for r in pseudolik.scored(x, pseudolik.train(x, stride=2)).collect()} for x in (d.repartition(1), d.repartition(7))]
    assert all(one[i] == pytest.approx(two[i], abs=1e-3) for i, _ in docs)


def test_counts_are_of_single_words(spark):
    """Without training the score is the brute-force log-likelihood of single words, whether they have leaves of their own or not."""
    docs, _ = corpus(60)
    d = spark.createDataFrame(docs + MESSY[1:], "doc_id long, text string")
    told = [w.lower() for _, t in docs + MESSY[1:] for w in (t or "").split()]
    count = {w: told.count(w) for w in set(told)}
    got = {r.doc_id: r.pseudo_log_likelihood for r in pseudolik.scored(d, pseudolik.train(d, rounds=0, known=6)).collect()}
    # leaves without words count as one occurrence
    total = len(told) + pseudolik.REST - len({w for w in count if sorted(count.values())[-6] > count[w]})
    for i, t in docs:
        want = sum(np.log(count[w.lower()] / total) for w in t.split())
        assert got[i] == pytest.approx(want, rel=0.02)


def test_log_probability_is_a_distribution():
    vocab = pseudolik.vocabulary(np.arange(10, dtype=np.uint64) * np.uint64(7), np.arange(1, 11), np.ones(pseudolik.REST, np.int64))
    net = pseudolik.Window.fresh(vocab)
    net.table[: len(vocab.start), :-1] = np.random.default_rng(0).standard_normal((len(vocab.start), pseudolik.HIDDEN))
    around = np.array([[0], [5], [len(vocab.counts)], [3]])
    leaves = np.arange(len(vocab.counts))
    assert np.exp(net.log_probability(np.repeat(around, len(leaves), 1), leaves)).sum() == pytest.approx(1, abs=1e-5)
    before = net.log_probability(around, np.array([7]))[0]
    net.learn(around, np.array([7]), np.zeros(len(net.table)), np.zeros(len(net.table)), 0.02)
    assert net.log_probability(around, np.array([7]))[0] > before


def test_every_word_is_a_target():
    """With the shipped parameters each round learns from every word of every document once, whatever batches it comes in."""
    import pyarrow as pa

    vocab = pseudolik.vocabulary(np.arange(20, dtype=np.uint64), np.full(20, 5), np.ones(pseudolik.REST, np.int64))
    net = pseudolik.Window.fresh(vocab)
    sizes, shards = [1, 3, pseudolik.BATCH + 5, 40, 2, 17], [0, 0, 0, 0, 1, 1]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int64()), pa.array(range(6), pa.int64()), pa.array([[i % 20 for i in range(n)] for n in sizes], pa.list_(pa.int32()))], names=["shard", "order", "leaves"]
    )
    got = {}
    for batch in pseudolik._trained(net, pseudolik.RATE, 0, pseudolik.STRIDE)([rows.slice(0, 3), rows.slice(3)]):
        for shard, at, times in zip(*(batch.column(c).to_pylist() for c in ("shard", "rows", "times")), strict=True):
            # the classes are in every target
            got[shard] = got.get(shard, 0) + np.frombuffer(times)[np.frombuffer(at, np.int32) == vocab.inner].sum()
    assert pseudolik.ROUNDS >= 1 and got == {0: sum(sizes[:4]), 1: sum(sizes[4:])}


def test_words_at_edges():
    h, at, starts = words(np.frombuffer(b"ab cdab", np.uint8), np.array([0, 2, 2, 5, 7]))
    assert at.tolist() == [0, 1, 1, 2, 3] and starts.tolist() == [0, 3, 5] and h[0] == h[2] != h[1]
