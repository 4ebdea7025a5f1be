import math

import numpy as np
import pytest

from weftline.llm import crosspolytope as cp


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 2) for i, v, y in rows], "vec_id long, embedding array<double>, label int, rep int, n int")


def brute(rows, least=0.93):
    good = {}
    for i, v, y in rows:
        if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = (np.array(v) / np.linalg.norm(v), y)
    root, n = {i: i for i, *_ in rows if i is not None}, dict.fromkeys([i for i, *_ in rows if i is not None], 0)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(good)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            (u, y), (v, z) = good[a], good[b]
            if y == z and len(u) == len(v) and u @ v >= least:
                n[a] += 1
                n[b] += 1
                x, w = top(a), top(b)
                root[max(x, w)] = min(x, w)
    return {i: (n[i], top(i), top(i) == i) for i in root}


def found(spark, rows, **kw):
    out = cp.near_vectors(frame(spark, rows), **kw).collect()
    assert len(out) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}


def cloud(seed=0, groups=25, per=8, dim=32):
    g = np.random.default_rng(seed)
    rows = []
    for k in range(groups):
        base = g.standard_normal(dim)
        rows += [(len(rows) + j, (base + g.standard_normal(dim) * 0.22).tolist(), k % 3) for j in range(per)]
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_against_brute_force(spark, block):
    rows = cloud()
    want, got = brute(rows), found(spark, rows, block=block)
    assert sum(w[0] for w in want.values()) > 50
    lost = sum(w[0] for w in want.values()) - sum(x[0] for x in got.values())
    assert 0 <= lost <= 2 and all(got[i][0] <= want[i][0] for i in got)
    if not lost:
        assert got == want


def test_messy(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1), (9, [1.0, None, 3.0], 1), (10, [1.0, float("nan"), 3.0], 1), (11, [float("inf"), 1.0, 1.0], 1), (12, [1.0, 2.0], 1), (13, [5.0], 1), (14, [7.0], 1), (15, [-7.0], 1)]
    assert found(spark, rows) == brute(rows)
    out = cp.near_vectors(frame(spark, [*rows, (None, v, 1), (2, v, 1)])).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(0, None, True)]
    assert [(r.n_links, r.component_id) for r in out if r.vec_id == 2] == [(2, 1)] * 2
    assert cp.near_vectors(frame(spark, [])).count() == 0


def test_hadamard():
    x = np.random.default_rng(1).standard_normal((5, 16))
    assert np.allclose(cp.hadamard(cp.hadamard(x)), x) and np.allclose(np.linalg.norm(cp.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
