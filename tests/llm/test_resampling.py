"""Importance resampling beside plain counting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from weftline.llm import resampling


def plain(docs, target, how=resampling.Resampling()):
    def features(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
        return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    bucket = lambda f: zlib.crc32(f.encode()) % how.buckets
    s, t = (Counter(bucket(f) for x in side for f in features(x)[1]) for side in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + how.buckets) / ((s[b] + 1) * (all_t + how.buckets))))
    rows, able = [], []
    for i, (doc, text) in enumerate(docs):
        n_words, fs = features(text)
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"{how.seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n_words >= how.least_words:
                able.append((-score, doc, len(fs), i))
        rows.append([doc, len(fs), weight, score, None])
    for rank, (*_, i) in enumerate(sorted(able)[: len(able) * how.percent // 100], 1):
        rows[i][4] = rank
    return sorted(map(tuple, rows), key=repr)


def words_of(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def frames(spark, docs, target):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")


def check(spark, docs, target):
    got = resampling.resampled(*frames(spark, docs, target)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(docs, target)


def test_against_plain_counting(spark):
    rng = random.Random(3)
    vocabulary = ["the", "The", "café", "naïve", "x1", "don't", "日本", "a-b", "10:30", "Éa", "tab\there", *(f"w{i}" for i in range(80))]
    docs = [(i, words_of(rng, rng.choice([0, 1, 5, 19, 20, 60, 300]), vocabulary)) for i in range(150)]
    docs += [(900 + i, docs[7][1]) for i in range(40)] + [(7, docs[7][1])]
    check(spark, docs, [words_of(rng, 50, vocabulary[:30]) for _ in range(10)])


def test_nulls_empty_and_very_long(spark):
    docs = [(1, None), (2, ""), (None, words_of(random.Random(1), 40, ["a", "b"])), (4, " !? "), (5, "q" * 200_000 + " " + "word " * 200_000), (6, "a b " * 30), (6, "a c " * 30), (8, "é" * 30)]
    check(spark, docs, [None, "", "a b c"])
    check(spark, [(1, "a b")], [])


def test_empty_table(spark):
    docs, target = frames(spark, [], ["a b"])
    assert resampling.resampled(docs, target).count() == 0


def test_clashing_names_and_draw(spark):
    rng = random.Random(5)
    rows = [(i, words_of(rng, 30, ["a", "b", "c", "d"]), 1, 2, "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank int, score int, bucket string")
    target = spark.createDataFrame([("a b a b", 1)], "text string, s int")
    taken = resampling.drawn(docs, target)
    assert taken.columns == docs.columns and taken.count() == 10


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_dictionary_has_each_string_once(spark, parts, monkeypatch):
    """Whatever the number of ranges, flushes and lines, and with one first word in most pairs."""
    monkeypatch.setattr(resampling, "LINE", 7)
    rng = random.Random(parts)
    texts = [" ".join(["hot", f"v{rng.randrange(500)}"] * 40) for _ in range(60)]
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = resampling.distinct_features({"s": table, "t": table.limit(0)}, parts).collect()
    want = Counter(f for x in texts for w in [x.split()] for f in [*w, *map(" ".join, zip(w, w[1:]))])
    assert len(got) == len(want) and {r["feature"]: r["s"] for r in got} == want


def test_counting_in_several_flushes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(resampling, "HELD", 50)
    monkeypatch.setattr(resampling, "STEP", 100)
    rng = random.Random(9)
    texts = [words_of(rng, 30, [f"w{i}" for i in range(40)]) for _ in range(30)]
    sent = [b.to_pydict() for b in resampling._counted([b"w2", b"w2 w15", b"w2 w30", b"w7"])([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])]
    got = Counter()
    for b in sent:
        for line in b["line"]:
            for f in line.split("\n"):
                w, _, n = f.partition(":")
                got[w] += int(n or 1)
    assert len(sent) > 1
    assert got == Counter(f for x in texts for w in [x.split()] for f in [*w, *map(" ".join, zip(w, w[1:]))])
