"""Graph analyses on an edge DataFrame (V8-V10): components, distances from sources and of any pairs, closeness.

Iterative jobs: each round is a join + aggregate; the loop runs on the driver
but only one row per round reaches it.  Every round's state is
checkpointed (reliable checkpoint in ``spark.checkpoint.dir``) so lineage does
not grow and a lost executor recomputes one round, not the whole history.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import ordered as O


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Both directions of every edge, each once."""
    e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()


def _toward_minimum(pairs: DataFrame, keep: Column) -> DataFrame:
    """Per src the least of itself and its dst; every dst that ``keep`` selects is linked to that minimum."""
    least = (pairs.groupBy("src").agg(F.min("dst").alias("m"))
             .select(F.col("src").alias("center"), F.least("src", "m").alias("m")))
    return (pairs.filter(keep).join(least, F.col("src") == F.col("center"))
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")))


def connected_components(edges: DataFrame, nodes: DataFrame | None = None, src: str = "src",
                         dst: str = "dst") -> DataFrame:
    """V8: (node, component) where component is the smallest node id of the component.

    Alternating star contractions, until nothing changes.  A large star links every larger neighbour of a node to the
    least node around it, a small star does so with the smaller neighbours and the node itself; both keep the
    components, and together they turn each into one star around its least node in a number of rounds that grows with
    the logarithm of its size, whatever the order of the ids.  Each step is a minimum per node (partial aggregation)
    and a join that adaptive execution splits at hubs.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    given = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).filter("src is not null and dst is not null")
    e = (given.filter("src != dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
         .distinct().checkpoint())

    def state(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    before, now = None, state(e)
    while before != now:
        both = e.unionAll(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        large = (_toward_minimum(both, F.col("dst") > F.col("src")).filter("src != dst").distinct()).checkpoint()
        centers = large.groupBy("src").agg(F.min("dst").alias("dst"))
        small = _toward_minimum(large, F.lit(True)).filter("src != dst")
        e = small.unionAll(centers).distinct().checkpoint()
        before, now = now, state(e)
    n = nodes.select("node").distinct() if nodes is not None else nodes_of(given)
    return (n.join(e, n["node"] == e["src"], "left")
            .select("node", F.coalesce("dst", "node").alias("component")))


def shortest_path_lengths(edges: DataFrame, sources: DataFrame, src: str = "src",
                          dst: str = "dst") -> DataFrame:
    """V9 (re-aimed): (source, target, distance) from each node of ``sources`` (column ``node``) to every
    node it reaches in the undirected graph, the source itself at 0.

    Breadth-first from all given sources at once: each round expands the
    frontier by one edge, drops pairs already reached (anti join) and
    checkpoints the new ones.  The work is |sources| x reachable nodes; for single
    pairs among many nodes see :func:`hub_labels`, which never spells out the
    pairs of a component.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = undirected(edges, src, dst).checkpoint()
    visited = sources.select(F.col("node").alias("source"), F.col("node").alias("target"),
                             F.lit(0).alias("distance")).distinct().checkpoint()
    frontier = visited
    depth = 0
    while True:
        depth += 1
        nxt = (frontier.join(e, frontier.target == e.src)
               .select("source", F.col("dst").alias("target")).distinct()
               .join(visited.select("source", "target"), ["source", "target"], "left_anti")
               .select("source", "target", F.lit(depth).alias("distance"))).checkpoint()
        if nxt.limit(1).count() == 0:
            break
        visited = visited.unionByName(nxt)  # each round's pairs are stored once
        if depth % 20 == 0:
            visited = visited.checkpoint()
        frontier = nxt
    return visited


def closeness(distances: DataFrame, n_nodes: int | Column) -> DataFrame:
    """Wasserman-Faust closeness ((r-1)/(n-1)) * ((r-1)/sum d) of every source in ``distances``
    (output of :func:`shortest_path_lengths`); r = nodes reachable incl. itself, n = nodes of the graph
    (an int or a scalar column).  0 for an isolated node."""
    per = distances.groupBy("source").agg(F.count(F.lit(1)).alias("r"), F.sum("distance").alias("total"))
    n = F.lit(n_nodes) if isinstance(n_nodes, int) else n_nodes
    r1 = (F.col("r") - 1).cast("double")
    c = F.coalesce(F.try_divide(r1, (n - 1).cast("double")) * F.try_divide(r1, F.col("total").cast("double")),
                   F.lit(0.0))
    return per.select(F.col("source").alias("node"), c.alias("closeness"))


# ------------------------------------------------------------------ V10, all nodes

def closeness_estimates(edges: DataFrame, nodes: DataFrame | None = None, src: str = "src", dst: str = "dst",
                        precision: int = 12) -> DataFrame:
    """V10 for every node: (node, reachable, total_distance, closeness), estimated.

    Each node holds a HyperLogLog sketch of the nodes within t steps.  A round unites it with those of its neighbours, so
    that the sketch sizes of consecutive rounds give the number of nodes at each distance; only nodes with a neighbour
    that has changed take part, and rounds end when no sketch changes.  A sketch has 2 ** ``precision`` registers,
    whatever the size of the graph: no pair of nodes is ever spelled out.  A node with one neighbour has no sketch: it
    reaches what that neighbour reaches, itself in no step instead of one and all others in one step more.  Small neighbourhoods (up to some hundreds of
    nodes) are counted exactly; the standard error of larger ones is about 0.8 / sqrt(2 ** precision), 1.3 % at 12.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = undirected(edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()), src, dst).filter("src != dst")
    n = (nodes.select("node").distinct() if nodes is not None else nodes_of(edges)).filter("node is not null")
    if nodes is not None:
        e = (e.join(n.select(F.col("node").alias("src")), "src", "left_semi")
             .join(n.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst"))
    e = e.checkpoint()
    leaves = _leaves(e).checkpoint()
    # a hub's edges to its leaves go first, so that no hub is met with all of them
    inner = (e.join(leaves.select(F.col("node").alias("dst")), "dst", "left_anti")
             .join(leaves.select(F.col("node").alias("src")), "src", "left_anti").select("src", "dst").checkpoint())
    state = (n.join(leaves, "node", "left_anti").groupBy("node").agg(F.hll_sketch_agg(F.col("node"), F.lit(precision)).alias("sketch"))
             .select("node", "sketch", F.lit(1).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("total"),
                     F.lit(True).alias("changed")).checkpoint())
    ends = (leaves.groupBy("node", "hub").agg(F.hll_sketch_agg(F.col("node"), F.lit(precision)).alias("sketch"))
            .groupBy(F.col("hub").alias("to")).agg(F.hll_union_agg("sketch").alias("sketch")).checkpoint())
    steps = 0
    while not state.filter("changed").isEmpty():
        steps += 1
        news = state.filter("changed").select(F.col("node").alias("src"), "sketch")
        came = inner.join(news, "src").select(F.col("dst").alias("to"), "sketch")
        if steps <= 2:  # what leaves send in both rounds; the second changes no register, but how the sketch is estimated
            came = came.unionAll(ends)
        around = came.groupBy("to").agg(F.hll_union_agg("sketch").alias("more"))
        both = F.when(F.col("more").isNotNull(), F.hll_union("sketch", "more")).otherwise(F.col("sketch"))
        s = (state.join(around, F.col("node") == F.col("to"), "left").select("node", both.alias("sketch"), "size", "total")
             .withColumn("now", F.greatest(F.hll_sketch_estimate("sketch"), F.col("size"))))
        state = s.select("node", "sketch", F.col("now").alias("size"),
                         (F.col("total") + (F.col("now") - F.col("size")) * F.lit(steps)).alias("total"),
                         (F.col("now") > F.col("size")).alias("changed")).checkpoint()
    hubs = state.select(F.col("node").alias("hub"), "size", (F.col("total") + F.col("size") - 2).alias("total"))
    every = state.select("node", "size", "total").unionAll(leaves.join(hubs, "hub").select("node", "size", "total")).checkpoint()
    count = every.agg(F.count(F.lit(1)).alias("c")).first().c  # one number
    r1 = (F.col("size") - 1).cast("double")
    c = F.coalesce(F.try_divide(r1, F.lit(float(count - 1))) * F.try_divide(r1, F.col("total").cast("double")), F.lit(0.0))
    return every.select("node", F.col("size").alias("reachable"), F.col("total").alias("total_distance"), c.alias("closeness"))


def _leaves(e: DataFrame) -> DataFrame:
    """(node, hub): the nodes with one neighbour, and that neighbour; of two nodes that have only each other, the larger."""
    ones = (e.groupBy("src").agg(F.count(F.lit(1)).alias("degree"), F.min("dst").alias("dst")).filter("degree = 1")
            .groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.max("src").alias("node")))
    return ones.select("node", F.when(F.col("node") == F.col("b"), F.col("a")).otherwise(F.col("b")).alias("hub"))


# ------------------------------------------------------------------ V9, any pair

#: Hubs of the first batch, and how many times as many each later batch has.
FIRST_BATCH, BATCH_GROWTH = 16, 8


def hub_labels(edges: DataFrame, nodes: DataFrame | None = None, src: str = "src", dst: str = "dst") -> DataFrame:
    """V9: (node, hub, distance) labels such that the distance of any two nodes is the least sum over a hub that both
    have (:func:`label_distances`); nodes without a common hub are not connected.

    Pruned landmark labelling in batches: nodes are hubs in the order of their degree.  All hubs of a batch search breadth
    first at once; a search stops at a node whose distance the labels of earlier batches already give.  High-degree hubs
    cover most paths, so later batches, though larger, stop at once.  In an undirected graph a step back can only lead
    to the last two layers, so a round reads these and never all that has been reached.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = undirected(edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()), src, dst).filter("src != dst").checkpoint()
    n = (nodes.select("node").distinct() if nodes is not None else nodes_of(edges)).filter("node is not null")
    degree = e.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    ranked = n.join(degree, "node", "left").select("node", F.coalesce("degree", F.lit(0)).alias("degree"))
    order = O.in_order(ranked, [], [F.col("degree").desc(), "node"], "hub-order")
    hubs = O.scan(order, [], rank=O.position()).select("node", "rank").checkpoint()
    count = hubs.agg(F.max("rank").alias("c")).first().c or 0  # one number
    none = hubs.limit(0).select("node", F.col("node").alias("hub"), F.lit(0).alias("distance"))
    labels, low, high = none, 0, FIRST_BATCH
    while low < count:
        batch = hubs.filter((F.col("rank") > low) & (F.col("rank") <= high)).select(F.col("node").alias("hub"))
        layer = batch.select("hub", F.col("hub").alias("node")).checkpoint()
        found, last, depth = [layer.withColumn("distance", F.lit(0))], layer.limit(0), 0
        own = labels.join(batch.select(F.col("hub").alias("node")), "node", "left_semi").select(
            F.col("node").alias("hub"), F.col("hub").alias("via"), F.col("distance").alias("d1")).checkpoint()
        while not layer.isEmpty():
            depth += 1
            new = (layer.join(e, F.col("node") == F.col("src")).select("hub", F.col("dst").alias("node")).distinct()
                   .join(layer.unionAll(last), ["hub", "node"], "left_anti"))
            known = (new.join(own, "hub").join(labels.select("node", F.col("hub").alias("via"), F.col("distance").alias("d2")),
                                               ["node", "via"])
                     .filter(F.col("d1") + F.col("d2") <= depth).select("hub", "node").distinct())
            last, layer = layer, new.join(known, ["hub", "node"], "left_anti").checkpoint()
            found.append(layer.withColumn("distance", F.lit(depth)))
        labels = reduce(DataFrame.unionAll, [labels, *[f.select("node", "hub", "distance") for f in found]]).checkpoint()
        low, high = high, high * BATCH_GROWTH
    return labels


def label_distances(pairs: DataFrame, labels: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """``pairs`` with their ``distance`` by hub labels (NULL: not connected or not in the graph): one join of the pairs'
    labels on the hub."""
    distinct = pairs.select(F.col(source).alias("_s"), F.col(target).alias("_t")).distinct()
    a = labels.select(F.col("node").alias("_s"), "hub", F.col("distance").alias("_d1"))
    b = labels.select(F.col("node").alias("_t"), "hub", F.col("distance").alias("_d2"))
    best = (distinct.join(a, "_s").join(b, ["_t", "hub"]).groupBy("_s", "_t")
            .agg(F.min(F.col("_d1") + F.col("_d2")).alias("distance")))
    return (pairs.join(best, (F.col(source) == F.col("_s")) & (F.col(target) == F.col("_t")), "left")
            .select(*pairs.columns, "distance"))
