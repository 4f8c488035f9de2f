"""Hub labels and closeness estimates against breadth-first search."""

import random
from collections import deque
from pathlib import Path

import pytest

from concord.operators import graph as G


def random_graph(seed, n, m):
    rng = random.Random(seed)
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    edges |= {(n + i, n + i + 1) for i in range(12)} | {(0, n + 20 + i) for i in range(40)}  # a path apart, a star
    return sorted(edges)


def distances(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for s in near:
        d, todo = {s: 0}, deque([s])
        while todo:
            x = todo.popleft()
            for y in near[x]:
                if y not in d:
                    d[y] = d[x] + 1
                    todo.append(y)
        out[s] = d
    return out


@pytest.mark.parametrize("seed,n,m", [(1, 40, 60), (2, 60, 50)])
def test_hub_labels_equal_bfs(spark, seed, n, m):
    edges = random_graph(seed, n, m)
    exact = distances(edges)
    labels = G.hub_labels(spark.createDataFrame(edges, "src long, dst long")).cache()
    pairs = spark.createDataFrame([(a, b) for a in exact for b in exact] + [(0, 9999), (None, 0)], "source long, target long")
    got = {(r.source, r.target): r.distance for r in G.label_distances(pairs, labels).collect()}
    assert got == {**{(a, b): exact[a].get(b) for a in exact for b in exact}, (0, 9999): None, (None, 0): None}
    assert labels.count() < sum(map(len, exact.values())) / 3  # far fewer labels than pairs


def test_closeness_of_all_nodes(spark):
    edges = random_graph(7, 900, 1800)
    exact = distances(edges)
    n = len(exact)
    rows = G.closeness_estimates(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r.node for r in rows} == set(exact)
    errors = []
    for r in rows:
        d = exact[r.node]
        true = (len(d) - 1) / (n - 1) * (len(d) - 1) / sum(d.values()) if len(d) > 1 else 0.0
        errors.append(abs(r.closeness - true) / max(true, 1e-12))
        if len(d) < 100:
            assert r.reachable == len(d) and r.total_distance == sum(d.values())
    assert sum(errors) / n < 0.02 and max(errors) < 0.08


def test_closeness_of_an_edgeless_node(spark):
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "node long")
    rows = {r.node: r.closeness for r in G.closeness_estimates(spark.createDataFrame([(1, 2), (2, 2)], "src long, dst long"), nodes).collect()}
    assert rows == {1: 0.5, 2: 0.5, 3: 0.0}


def test_closeness_stores_no_sketch_for_nodes_with_one_neighbour(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    stored = lambda: sum(f.stat().st_size for f in root.rglob("*") if f.is_file())
    before = stored()
    edges = [(0, i) for i in range(1, 3001)] + [(5000, 5001)]
    rows = {r.node: r for r in G.closeness_estimates(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert stored() - before < 2_000_000  # a sketch of 4 KB a node and round is more than 20 MB
    assert len(rows) == 3003 and {rows[i].total_distance - rows[0].total_distance - rows[0].reachable for i in range(1, 3001)} == {-2}
    assert abs(rows[0].reachable - 3001) < 150 and rows[9].reachable == rows[0].reachable
    assert [(rows[i].reachable, rows[i].total_distance) for i in (5000, 5001)] == [(2, 1), (2, 1)]


def test_closeness_counts_edges_between_given_nodes_only(spark):
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "node long")
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 9)], "src long, dst long")
    rows = {r.node: (r.reachable, r.total_distance) for r in G.closeness_estimates(edges, nodes).collect()}
    assert rows == {1: (3, 3), 2: (3, 2), 3: (3, 3)}
