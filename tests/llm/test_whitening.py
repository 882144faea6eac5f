from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from snaplake.llm.queries import op12_whitening
from snaplake.llm.whitening import centred, covariance, polarised, square_sums, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, x string, n long, whitened double, `key` int"


def scaled(v):
    if not v or any(c is None or not isfinite(c) for c in v):
        return None
    x = [floor(256 * Fraction(c)) for c in v]
    return tuple(x) if all(-2 ** 63 <= c < 2 ** 63 for c in x) else None


def brute(rows, components=4):
    """Whitened rows by exact fractions and one eigh: (rows by id, whole covariance)."""
    kept = [(i, x) for i, x in ((i, scaled(v)) for i, v in rows) if x]
    fit = sorted({x for _, x in kept})
    n, d = len(fit), len(fit[0])
    total = [sum(x[k] for x in fit) for k in range(d)]
    y = [[n * x[k] - total[k] for k in range(d)] for x in fit]
    v = np.array([[sum(r[i] * r[j] for r in y) / n ** 3 for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    out = []
    for i, x in kept:
        own = np.array([(n * x[k] - total[k]) / n for k in range(d)])
        out.append((i, n, sum((n * x[k] - total[k]) ** 2 for k in range(d)), own @ u / np.sqrt(e), e / np.trace(v)))
    return out


def compare(found, rows):
    want = {}
    for i, n, deviation, z, share in brute(rows):
        for k in range(len(z)):
            want.setdefault((i, k + 1, n, deviation), []).append((z[k], share[k]))
    got = {}
    for r in found:
        got.setdefault((r[0], r[1], r[2], r[3]), []).append((r[4], r[5]))
        assert r[6] < 1e-9
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    sign = {}
    for key, pairs in got.items():
        for (z, share), (z0, share0) in zip(sorted(pairs), sorted(want[key])):
            assert abs(abs(z) - abs(z0)) < 1e-9 and abs(share - share0) < 1e-12
            if abs(z0) > 1e-6:
                sign.setdefault(key[1], set()).add(np.sign(z * z0))
    assert all(len(s) == 1 for s in sign.values())  # one sign for all rows


def test_sums_of_squares_are_exact_at_any_size():
    r = np.random.default_rng(0)
    for top in (10, 1 << 20, 1 << 30, 1 << 45, 1 << 61):
        u = r.integers(-top, top, (300, 3))
        assert square_sums(u).tolist() == [sum(int(x) ** 2 for x in u[:, k]) for k in range(3)]
    assert centred(np.array([[2 ** 62]]), 1000, np.array([5], object)).tolist() == [[1000 * 2 ** 62 - 5]]


def test_polarisation_gives_every_covariance():
    r = np.random.default_rng(1)
    x = r.integers(-300, 300, (2500, 5)) * np.array([1, 2, 0, 5, 9])
    x[:, 4] += x[:, 0]
    sums = polarised(x, len(x), x.sum(0).astype(object))
    assert np.allclose(covariance(sums.tolist(), 5, len(x)), np.cov(x.T, bias=True), rtol=1e-12)


def test_the_query_equals_exact_fractions(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = op12_whitening(spark, sf)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    compare([tuple(r) for r in found.collect()], rows)


def test_odd_vectors(spark):
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=5) * [9, 5, 3, 2, 1]).tolist()) for i in range(60)]
    rows += [(7, rows[7][1])] * 40 + [(None, rows[8][1]), (100, [0.0] * 5), (101, [-0.0] * 5)]
    odd = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] * 5), (204, [float("inf"), 1.0, 1.0, 1.0, 1.0]),
           (205, [1e200] * 5), (206, [1.0, 2.0]), (207, [-1e300, 0.0, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame([(i, v, 1, "x", 1, 0.5, 2) for i, v in rows + odd], SCHEMA).repartition(5)
    compare([tuple(x) for x in whiten(table).collect()], rows)


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2 ** 40 * i), float(i * i), float(2 ** 45 - i), 1.0 * (i % 3)]) for i in range(30)]
    table = spark.createDataFrame([(i, v, 1, "x", 1, 0.5, 2) for i, v in rows], SCHEMA)
    found = {(r.vec_id, r.component): r for r in whiten(table).collect()}
    for i, n, deviation, z, share in brute(rows):
        held = found[i, 1]
        assert held.n == n and held.deviation == (deviation if deviation < 2 ** 63 else None)
        assert abs(abs(held.whitened) - abs(z[0])) < 1e-9


@pytest.mark.parametrize("vectors, components", [([[1.0, 2.0]], 2), ([[1.0, 2.0], [2.0, 4.0], [5.0, 10.0]], 2), ([[1.0], [2.0]], 1)])
def test_directions_without_variance_have_no_value(spark, vectors, components):
    table = spark.createDataFrame([(i, v, 1, "x", 1, 0.5, 2) for i, v in enumerate(vectors)], SCHEMA)
    found = whiten(table).collect()
    assert len(found) == len(vectors) * components
    for r in found:
        varies = len(vectors) > 1 and r.component == 1
        assert (r.whitened is not None) == varies and r.identity_error < 1e-9
        assert (r.explained is None) == (len(vectors) == 1)


def test_no_vectors(spark):
    none = spark.createDataFrame([(1, None, 1, "x", 1, 0.5, 2)], SCHEMA)
    assert whiten(none).count() == 0 and whiten(none.limit(0)).count() == 0
