import random

from snaplake.llm.components import connected_components


def brute(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: root(x) for x in list(parent)}


def run(spark, edges, kind="long"):
    return {r.node: r.component for r in
            connected_components(spark.createDataFrame(edges, f"src {kind}, dst {kind}")).collect()}


def test_path_star_and_odd_rows(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(200)] + [(5000 - i, 5000) for i in range(1, 50)]
    odd = [(None, 3), (4, None), (7, 7), (0, 1), (1, 0), (None, None)]
    assert run(spark, path + star + odd) == brute(path + star + odd)


def test_random_graphs(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)]
    assert run(spark, edges) == brute(edges)


def test_strings_and_empty(spark):
    assert run(spark, [("b", "a"), ("c", "b")], "string") == {"a": "a", "b": "a", "c": "a"}
    assert run(spark, []) == {}
