import hashlib
import math
import time

import numpy as np
import pyarrow as pa
import pytest

from snaplake.llm import embedding_dedup as module
from snaplake.llm.embedding_dedup import embedding_dedup


def brute(rows, threshold):
    ok = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, float) / np.abs(v).max()
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    links = [0] * len(rows)
    for i, a in ok.items():
        for j, b in ok.items():
            if j < i and len(a) == len(b) and np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), k), k)
    return sorted((k, links[i], least[root(i)], k == least[root(i)]) for i, (k, _) in enumerate(rows))


def vectors(n=260, dim=8, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = r.normal(size=dim) if i % 3 else centres[i % 12] + r.normal(size=dim) * 0.25
        rows.append((i, v.astype(np.float32).astype(float).tolist()))
    same = rows[5][1]
    rows += [(1000 + i, same) for i in range(40)] + [(2000, [2 * x for x in same]), (2001, [-x for x in same])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * dim), (3003, [float("nan")] * dim), (3004, [None] * dim), (3005, [1e200] * dim),
             (3006, [float("inf")] + [1.0] * (dim - 1)), (3007, same[:4]), (3008, same[:4]), (7, same)]
    rows += [(3010, [1e200, 2e200]), (3011, [1e200, 2e200]), (3012, [1.0, 2.0]), (3013, [1e-200, 2e-200]), (3014, [5e-324, 1e-323]),
             (3015, [1e308, -1e308]), (3016, [1e-300, 1e300]), (3017, [0.0, 3.0])]
    return rows


@pytest.mark.parametrize("size,threshold", [(16, 0.9), (100_000, 0.9), (50, 0.7), (7, 0.99)])
def test_equals_all_pairs(spark, size, threshold):
    rows = [r for r in vectors() if r[0] != 7] + [(7, vectors()[7][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, mark string").repartition(4)
    got = embedding_dedup(df, threshold=threshold, group_size=size)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == brute(rows, threshold)


def test_floats_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, math.sqrt(1 - 0.81)]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.n_links) for r in embedding_dedup(df).orderBy("vec_id").collect()][2] == (3, 0)
    assert embedding_dedup(df.limit(0)).collect() == []


def sorted_rows(units):
    """Batches as a task of the join gets them: one unit's home vectors, then those sent to it."""
    names, kinds = ["dim", "unit", "role", "rep", "n", "vec"], [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.binary()]
    at = 0
    for role, x in enumerate(units):
        k = len(x)
        cols = [[x.shape[1]] * k, [0] * k, [role] * k, range(at, at + k), [1] * k, [v.tobytes() for v in x]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)
        at += k


def test_a_pair_costs_little_more_than_its_product():
    """The first version took over ten times the CPU of the double products, so growth with the square showed at 50,000 vectors."""
    r = np.random.default_rng(1)
    x, y = r.normal(size=(4000, 64)), r.normal(size=(4000, 64))
    y[:50] = x[:50] * 3 + 0.01
    start = time.process_time()
    for _ in range(4):
        x @ y.T
    plain = time.process_time() - start
    start = time.process_time()
    rows = [row for out in module._join(0.9)(sorted_rows([x, y])) for row in out.to_pylist()]
    assert time.process_time() - start < 1.5 * plain + 0.2
    assert {(row["src"], row["dst"]) for row in rows if row["dst"] is not None} == {(4000 + i, i) for i in range(50)}
    links = [row for row in rows if row["dst"] is None]
    assert sum(row["links"] for row in links) == 100 and {row["src"] for row in links} == {*range(4000), *range(4000, 4050)}


def test_two_units_meet_once():
    """Every pair of vectors meets exactly once; a vector takes part in half the units, or only those in reach."""
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(size=(300, 8)), r.normal(size=(100, 8)) * 0.02 + np.eye(8)[0], r.normal(size=(100, 8)) * 0.02 - np.eye(8)[0]])
    pivots = {8: module._units(x[[0, 1, 300, 400]])}
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array([1] * 500, pa.int64()), pa.array([8] * 500, pa.int32()),
                                        pa.array([v.tobytes() for v in x], pa.binary())], ["rep", "n", "dim", "vec"])
    for many in ([1, 1, 1, 1], [3, 2, 2, 1]):
        dealt = [row for out in module._deal(pivots, math.sqrt(0.2), {8: np.array(many)})([batch]) for row in out.to_pylist()]
        met = np.zeros((500, 500), int)
        for unit in range(sum(many)):
            home = [row["rep"] for row in dealt if row["unit"] == unit and row["role"] == 0]
            sent = [row["rep"] for row in dealt if row["unit"] == unit and row["role"] == 1]
            met[np.ix_(home, home)] += 1
            met[np.ix_(home, sent)] += 1
            met[np.ix_(sent, home)] += 1
        u = module._units(x)
        assert met.max() == 1 and met[u @ u.T >= 0.9].min() == 1
        assert met[300:400, 400:].max() == 0  # opposite crowds, never compared
        assert len(dealt) <= 500 * (1 + sum(many) // 2)


@pytest.mark.parametrize("dim", [2, 64, 700])
def test_scores_at_the_threshold(spark, dim):
    """Single precision only leaves out what is surely below: pairs a hair above and below 0.9 are told apart."""
    r = np.random.default_rng(3)
    rows = []
    for i in range(60):
        a, b = np.linalg.qr(r.normal(size=(dim, 2)))[0].T
        c = 0.9 + (i - 30) * 10.0 ** -(6 + i % 4)
        rows += [(2 * i, (a * 7.0).tolist()), (2 * i + 1, (c * a + math.sqrt(1 - c * c) * b).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embedding_dedup(df, group_size=25)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == brute(rows, 0.9)


def test_vectors_are_kept_short_where_exact(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.5, 0.25]), (3, [1e-40, 1.0]), (4, [None, 1.0]), (5, None)]
    got = {r.vec_id: r for r in module._keyed(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v").collect()}
    assert {k: r.vec and len(r.vec) for k, r in got.items()} == {1: 16, 2: 8, 3: 16, 4: None, 5: None}
    assert bytes(got[2].mark) == hashlib.blake2b(np.array([0.5, 0.25]).tobytes(), digest_size=16).digest()
