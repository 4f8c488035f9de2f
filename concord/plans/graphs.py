"""Registered graph queries (V8-V10) over edges derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from . import data as D
from .registry import query, rounded


def _geo_edges(spark, sf, with_customers: bool, with_suppliers: bool):
    nat = D.load(spark, sf, "nation")
    e = nat.select(F.concat(F.lit("n:"), F.col("n_nationkey").cast("string")).alias("src"),
                   F.concat(F.lit("r:"), F.col("n_regionkey").cast("string")).alias("dst"))
    if with_customers:
        c = D.load(spark, sf, "customer")
        e = e.unionByName(c.select(F.concat(F.lit("c:"), F.col("c_custkey").cast("string")).alias("src"),
                                   F.concat(F.lit("n:"), F.col("c_nationkey").cast("string")).alias("dst")))
    if with_suppliers:
        s = D.load(spark, sf, "supplier")
        e = e.unionByName(s.select(F.concat(F.lit("s:"), F.col("s_suppkey").cast("string")).alias("src"),
                                   F.concat(F.lit("n:"), F.col("s_nationkey").cast("string")).alias("dst")))
    return e


def _region_nodes(spark, sf):
    return D.load(spark, sf, "region").select(F.concat(F.lit("r:"), F.col("r_regionkey").cast("string")).alias("node"))


_EDGES_CUST = """SELECT 'n:' || CAST(n_nationkey AS VARCHAR) AS src, 'r:' || CAST(n_regionkey AS VARCHAR) AS dst FROM nation
                 UNION ALL SELECT 'c:' || CAST(c_custkey AS VARCHAR), 'n:' || CAST(c_nationkey AS VARCHAR) FROM customer"""
_EDGES_SUPP = """SELECT 'n:' || CAST(n_nationkey AS VARCHAR) AS src, 'r:' || CAST(n_regionkey AS VARCHAR) AS dst FROM nation
                 UNION ALL SELECT 's:' || CAST(s_suppkey AS VARCHAR), 'n:' || CAST(s_nationkey AS VARCHAR) FROM supplier"""


def _nodes_sql(edges):
    return f"""SELECT src AS node FROM ({edges}) UNION SELECT dst FROM ({edges})
               UNION SELECT 'r:' || CAST(r_regionkey AS VARCHAR) FROM region"""


@query("connected_components", ("V8",),
       sql=f"""WITH RECURSIVE e AS (SELECT src, dst FROM ({_EDGES_CUST}) UNION SELECT dst, src FROM ({_EDGES_CUST})),
                    lbl(node, label) AS (SELECT node, node FROM ({_nodes_sql(_EDGES_CUST)})
                                         UNION SELECT e.dst, l.label FROM lbl l JOIN e ON e.src = l.node)
               SELECT node, min(label) AS component FROM lbl GROUP BY node""")
def connected_components(spark, sf):
    e = _geo_edges(spark, sf, True, False)
    nodes = G.nodes_of(G.undirected(e)).unionByName(_region_nodes(spark, sf)).distinct()
    return G.connected_components(e, nodes)


# Brute-force oracle: paths from the region nodes enumerated up to 8 steps (the derived graph's diameter is 4).
_SP_SQL = f"""WITH RECURSIVE e AS (SELECT src, dst FROM ({_EDGES_CUST}) UNION SELECT dst, src FROM ({_EDGES_CUST})),
                   p(source, target, distance) AS (SELECT 'r:' || CAST(r_regionkey AS VARCHAR), 'r:' || CAST(r_regionkey AS VARCHAR), 0 FROM region
                      UNION SELECT p.source, e.dst, p.distance + 1 FROM p JOIN e ON p.target = e.src WHERE p.distance < 8)
              SELECT source, target, CAST(min(distance) AS INTEGER) AS distance FROM p GROUP BY source, target"""


def _sp(spark, sf):
    e = _geo_edges(spark, sf, True, False)
    return e, G.shortest_path_lengths(e, _region_nodes(spark, sf))


@query("shortest_paths", ("V9",), sql=_SP_SQL)
def shortest_paths(spark, sf):
    return _sp(spark, sf)[1]


@query("closeness", ("V10",),
       sql=f"""WITH d AS ({_SP_SQL}), per AS (SELECT source, count(*) AS r, sum(distance) AS total FROM d GROUP BY source),
                    nn AS (SELECT count(*) AS n FROM ({_nodes_sql(_EDGES_CUST)}))
               SELECT source AS node, round(CASE WHEN total > 0 AND n > 1
                   THEN (CAST(r - 1 AS DOUBLE) / (n - 1)) * (CAST(r - 1 AS DOUBLE) / total) ELSE 0.0 END, 6) AS closeness
               FROM per, nn""")
def closeness(spark, sf):
    e, d = _sp(spark, sf)
    n_nodes = G.nodes_of(G.undirected(e)).unionByName(_region_nodes(spark, sf)).distinct() \
        .select(F.count(F.lit(1))).scalar()
    return rounded(G.closeness(d, n_nodes))


_PAIRS_SQL = """SELECT c_custkey AS a, c_custkey * 7 % (SELECT count(*) FROM customer) AS b FROM customer"""


@query("pair_distances", ("V9",),
       sql=f"""SELECT 'c:' || CAST(p.a AS VARCHAR) AS source, 'c:' || CAST(p.b AS VARCHAR) AS target,
                      CASE WHEN t.c_custkey IS NULL THEN NULL WHEN p.a = p.b THEN 0 WHEN s.c_nationkey = t.c_nationkey THEN 2
                           WHEN m.n_regionkey = n.n_regionkey THEN 4 END AS distance
               FROM ({_PAIRS_SQL}) p JOIN customer s ON s.c_custkey = p.a LEFT JOIN customer t ON t.c_custkey = p.b
               LEFT JOIN nation m ON m.n_nationkey = s.c_nationkey LEFT JOIN nation n ON n.n_nationkey = t.c_nationkey""")
def pair_distances(spark, sf):
    """Each customer and one other: steps through nations and regions, by hub labels of all nodes."""
    e = _geo_edges(spark, sf, True, False)
    c = D.load(spark, sf, "customer").select("c_custkey")
    n = c.select(F.count(F.lit(1))).scalar()
    name = lambda k: F.concat(F.lit("c:"), k.cast("string"))
    pairs = c.select(name(F.col("c_custkey")).alias("source"), name(F.col("c_custkey") * 7 % n).alias("target"))
    return G.label_distances(pairs, G.hub_labels(e))


@query("closeness_all", ("V10",))
def closeness_all(spark, sf):
    """Every node's closeness, estimated (no SQL twin: sketches; held against exact distances in the tests)."""
    return rounded(G.closeness_estimates(_geo_edges(spark, sf, True, True)))
