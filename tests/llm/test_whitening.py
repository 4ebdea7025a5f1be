"""Whitening beside plain arithmetic with whole numbers and fractions."""

import math
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

from weftline.llm import queries, whitening

DATA = Path("/root/testdata/sf0.001")


def plain_scatter(rows):
    """n * XtX - S * St of distinct rows, with Python integers only."""
    rows = sorted(set(map(tuple, rows)))
    n, d = len(rows), len(rows[0])
    sums = [sum(r[i] for r in rows) for i in range(d)]
    return n, sums, [[n * sum(r[i] * r[j] for r in rows) - sums[i] * sums[j] for j in range(d)] for i in range(d)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, x string")


@pytest.mark.parametrize("scale", [3.0, 2.0**40, 2.0**60])
def test_scatter_is_exact(scale):
    rng = np.random.default_rng(1)
    x = whitening.whole(rng.normal(size=(300, 5)), scale, 0)
    x[0] = [2**63 - 1, -(2**63), 0, -1, 1] if scale > 2**50 else x[0]
    shift = x[3]
    sums, cross = whitening.scatter(x, shift)
    near = [[int(v) - int(s) for v, s in zip(r, shift)] for r in x]
    assert sums.tolist() == [sum(r[i] for r in near) for i in range(5)]
    assert cross.tolist() == [[sum(r[i] * r[j] for r in near) for j in range(5)] for i in range(5)]
    for v in (*sums.tolist(), *cross.reshape(-1).tolist()):
        assert sum(int(d[0]) << whitening.DIGIT * k for k, d in enumerate(whitening._digits([v]))) == v


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_query_beside_plain_arithmetic(spark):
    source = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    got = queries.op11_whitening(spark, str(DATA)).collect()
    x = {r["vec_id"]: [math.floor(256 * float(c)) for c in r["embedding"]] for r in source}
    n, sums, scatter = plain_scatter(x.values())
    v = np.array([[float(Fraction(c, n * n)) for c in r] for r in scatter])
    values, vectors = np.linalg.eigh(v)
    assert len(got) == 4 * len(x)
    seen = {}
    for r in got:
        dev = [n * a - b for a, b in zip(x[r["vec_id"]], sums)]
        assert r["n"] == n and r["deviation"] == sum(a * a for a in dev) == int(r["deviation_digits"])
        k = r["component"]
        assert r["explained"] == pytest.approx(values[-k] / np.trace(v), rel=1e-9)
        want = np.dot(np.array(dev) / n, vectors[:, -k]) / math.sqrt(values[-k])
        seen.setdefault(k, []).append((r["whitened"], want))
        assert r["identity_error"] <= 1e-9
    for pairs in seen.values():
        a, b = np.array(pairs).T
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, -b, atol=1e-8)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 3.0], 1, "a"), (2, [2.0, 2.5, 1.0], None, None), (2, [2.0, 2.5, 1.0], 1, "a"), (None, [0.0, -1.0, 4.5], 1, "a"), (4, [5.0, 1.0, 0.25], 1, "a")]
    bad = [(5, None, 1, "a"), (6, [1.0, None, 2.0], 1, "a"), (7, [1.0, nan, 2.0], 1, "a"), (8, [inf, 1.0, 2.0], 1, "a"), (9, [], 1, "a")]
    pair = [(10, [1.0, 0.0], 1, "a"), (11, [3.0, 1.0], 1, "a"), (12, [2.0, 5.0], 1, "a")]
    got = whitening.whitened(frame(spark, good + bad + pair)).collect()
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {1: 3, 2: 6, None: 3, 4: 3, 10: 2, 11: 2, 12: 2}
    assert {r["n"] for r in by[1]} == {4} and {r["n"] for r in by[10]} == {3}
    assert len({(r["component"], r["whitened"]) for r in by[2]}) == 3
    assert max(r["identity_error"] for r in got) < 1e-9


def test_no_variance_and_far_values(spark):
    same = whitening.whitened(frame(spark, [(i, [1.0, 2.0], 1, "a") for i in range(3)])).collect()
    assert len(same) == 6 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(1, 0, None, 0.0, 0.0)}
    far = whitening.whitened(frame(spark, [(1, [1e30, 1.0], 1, "a"), (2, [-1e30, 7.0], 1, "a"), (3, [0.0, 3.0], 1, "a")])).collect()
    x = [[2**63 - 1, 256], [-(2**63), 1792], [0, 768]]
    n, sums, _ = plain_scatter(x)
    digits = {r["vec_id"]: (r["deviation"], int(r["deviation_digits"])) for r in far}
    want = {i + 1: sum((n * a - b) ** 2 for a, b in zip(r, sums)) for i, r in enumerate(x)}
    assert digits == {k: (v if v < 2**63 else None, v) for k, v in want.items()}


def test_empty_table_and_clashing_names(spark):
    assert whitening.whitened(frame(spark, [])).count() == 0
    rows = spark.createDataFrame([(1, [1.0, 2.0], 3, 4), (2, [0.0, 5.0], 3, 4)], "vec_id long, embedding array<float>, dim int, component int")
    assert whitening.whitened(rows).count() == 4


def test_offset_and_scale(spark):
    rows = frame(spark, [(1, [0.5, 1.0], 1, ""), (2, [0.25, -1.0], 1, ""), (3, [3.0, 2.0], 1, "")])
    plain, moved = (whitening.whitened(rows, offset=o).orderBy("vec_id", "component").select("deviation", "explained").collect() for o in (0, 1000))
    assert plain == moved
