import random
import re
from collections import defaultdict

import numpy as np
import pytest

from weftline.llm import minhash


def shingle_set(t, k):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    ids = [i for i, _ in rows if i is not None]
    sets = {i: shingle_set(t, k) for i, t in rows}
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id long, text string, rep string, n int")


def family(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_families(spark, k, percent):
    rng = random.Random(9)
    rows = []
    for f in range(6):
        base = [f"b{rng.randrange(10**6)}" for _ in range(rng.choice([40, 150, 400]))]
        rows += [(len(rows) + j, family(rng, base, rng.randrange(0, max(2, len(base) // 30)))) for j in range(30)]
    rng.shuffle(rows)
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(frame(spark, rows), k=k, percent=percent).collect()}
    assert out == brute(rows, k, percent)


def test_messy(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two\n"), (8, "É a b"), (9, "é a b"), (None, "one"), (10, "x y z " * 30000), (11, "x y z " * 30001)]
    got = minhash.near_groups(frame(spark, rows)).collect()
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None}
    assert len(got) == len(rows) and out == brute(rows, 3, 85)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    kept = minhash.drop_near_copies(frame(spark, rows), k=3, percent=85)
    assert kept.columns == ["doc_id", "text", "rep", "n"] and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "6", "8", "9", "10", "None"])
    assert minhash.near_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("edits", [2, 6, 12])
def test_one_family_in_many_groups(spark, edits):
    """Rows of one bucket that are not linked with its pivot are compared with each other."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    other = base[:60] + [f"o{i}" for i in range(60)]
    rows = [(i, family(rng, base if i % 2 else other, rng.randrange(1, edits))) for i in range(80)]
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(frame(spark, rows)).collect()}
    assert out == brute(rows, 3, 85)


def test_rows_of_one_id_are_one_node(spark):
    rng = random.Random(7)
    base, other = [f"b{i}" for i in range(60)], [f"o{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (1, " ".join(other)), *[(i, family(rng, base if i % 2 else other, 2)) for i in range(2, 20)]]
    got = minhash.near_groups(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    far = {i: t for i, t in rows[2:] if not any(len(shingle_set(t, 3) & (s := shingle_set(u, 3))) * 100 >= 85 * len(shingle_set(t, 3) | s) for _, u in rows[:2])}
    assert {r.component_id for r in got if r.doc_id not in far} == {1}


def test_common_sizes():
    g = np.random.default_rng(1)
    sets = [np.unique(g.integers(0, 50, 20).astype(np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = minhash.common_sizes(sets, chunk=7)
    assert all(got[i, j] == want[i][j] for i in range(9) for j in range(9) if i != j)


def test_tensored_entries_bound_the_miss():
    for percent in (80, 85, 95):
        m, t = minhash.entries(percent), percent / 100
        assert 2 * (1 - t * t) ** m <= minhash.MISS
    a, b = minhash.collections([np.arange(50, dtype=np.uint64)] * 2, 4, 1)
    assert (a[0] == a[1]).all() and a.shape == (2, 4) == b.shape and len(set(a[0]) | set(b[0])) == 8


def test_near_copies_meet_once_a_piece(spark):
    """Rows of one pivot that share long runs: no pair within reach is missed, and a pair is not met once an element."""
    rng, rows = random.Random(4), []
    shared = rng.sample(range(1, 10**9), 12000)  # what the pivot alone has, and then each pair's own run
    for i in range(60):
        run = shared[:40] + shared[100 + i // 2 * 150 : 250 + i // 2 * 150]
        d = rng.sample(run, len(run) - rng.randrange(6)) + rng.sample(range(10**9, 2 * 10**9), rng.choice([0, 5, 20, 45]))
        rows.append((7, 100 + i, 500, i, d, 0, 0, 0, 0))
    diffs = spark.createDataFrame(rows, "pivot long, x long, n long, grp long, d array<long>, b0 long, b1 long, b2 long, b3 long")
    got = [(r.x, r.z) for r in minhash._candidates(diffs, 80).collect()]
    near = {(a[1], b[1]) for a in rows for b in rows if a[1] < b[1] and 180 * len(set(a[4]) ^ set(b[4])) <= 20 * 1000}
    assert len(near) > 15 and near <= set(got)
    # each element of the run in reach would give a row: over a thousand
    assert len(got) <= 8 * len(near)


def test_a_family_meets_under_few_pivots(spark, monkeypatch):
    """Buckets of one family have many pivots; their rows are not compared anew under each of them."""
    rng, seen, whole = random.Random(12), [], minhash._candidates
    base = [f"b{i}" for i in range(150)]
    rows = [(i, family(rng, base, rng.randrange(3, 14))) for i in range(150)]

    def counted(diffs, percent):
        out = whole(diffs, percent)
        seen.append((diffs.count(), diffs.select("x").distinct().count(), out.count(), out.select("x", "z").distinct().count()))
        return out

    monkeypatch.setattr(minhash, "_candidates", counted)
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(frame(spark, rows)).collect()}
    assert out == brute(rows, 3, 85) and len({c for _, c, _ in out.values()}) > 20
    ((differences, texts, met, pairs),) = seen
    assert pairs and differences <= 2 * texts and met <= 4 * pairs


def test_bitmaps_bound_the_difference():
    g = np.random.default_rng(4)
    sets = [np.unique(g.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 30, 300, 0)] + [np.zeros(0, np.uint64)]
    sets.append(np.union1d(sets[1], sets[0]))
    bits = np.stack(minhash.bitmaps(sets), 1)
    for a in range(len(sets)):
        for b in range(len(sets)):
            assert int(np.bitwise_count(bits[a] ^ bits[b]).sum()) <= len(np.setxor1d(sets[a], sets[b]))
