import random
from collections import Counter

from weftline.llm import mixing


def test_documents_meet_targets_whatever_their_length(spark):
    rng = random.Random(4)
    rows = []
    for i in range(2400):
        source = "s00" if i % 3 == 0 else f"s{rng.randrange(1, 20):02}"
        rows.append((i, "w " * (rng.randrange(1000, 1600) if i % 4 == 0 else rng.randrange(1, 300)), source))
    rows += [(None, "w " * (1 + i), "s00") for i in range(100)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    target = {r.source: r.target for r in mixing.mix(d).sources.collect()}
    words, long_in, long_out = Counter(), Counter(), Counter()
    for _, t, s in rows:
        long_in[s] += len(t) >= 2000
    for r in mixing.mixed_documents(d).collect():
        words[r.source] += len(r.text) // 2
        long_out[r.source] += len(r.text) >= 2000
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t) // 2
    assert target["s00"] / size["s00"] < 0.25  # the hot source is cut to a small share
    for s in target:
        assert abs(words[s] - target[s]) <= 2 * 1600 + 128, (s, words[s], target[s])
    share = target["s00"] / size["s00"]
    assert abs(long_out["s00"] - share * long_in["s00"]) <= 0.25 * share * long_in["s00"]
    assert abs(words["s00"] - target["s00"]) <= 0.03 * target["s00"]
