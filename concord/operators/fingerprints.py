"""Stored fingerprint trees: row match that reads only what differs.

``store`` keeps a table's row fingerprints in folders by hash range, and above them a tree of additive checksums: each node
has the row count and the sums of both fingerprint halves of its range.  Two trees are compared from the root down; ranges
with equal checksums hold the same multiset of rows, and only the rows of unequal leaves are read.  So a repeated comparison
of two large, nearly equal tables reads the tree and the few ranges that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N

#: Bits of a leaf's number, and of a level of the tree.
LEAF_BITS, LEVEL_BITS = 8, 4
CHECKSUMS = ("rows", "sum1", "sum2")
ROWS = "h1 long, h2 long, n long, leaf int"


def levels(bits: int) -> list[int]:
    """Bits of the nodes' numbers per level, from the root to the leaves."""
    return [*range(0, bits, LEVEL_BITS), bits]


def store(df: DataFrame, cols: Sequence[str], root: str, bits: int = LEAF_BITS) -> None:
    """Write the tree of the rows' ``cols`` under ``root``: ``rows/leaf=<n>`` (h1, h2, n) and ``tree/level=<bits>``.

    Copies of a row are one entry, so a value with many copies is one row of its leaf.  More leaves (``bits``) make the
    ranges finer: some hundred thousand rows a leaf are a good size."""
    h1, h2 = N.row_fingerprint(list(cols))
    leaf = F.shiftrightunsigned("h1", 64 - bits).cast("int")
    rows = df.select(h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).withColumn("leaf", leaf)
    rows.repartition("leaf").write.partitionBy("leaf").parquet(f"{root}/rows")
    stored = df.sparkSession.read.schema(ROWS).parquet(f"{root}/rows")
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)") * F.col("n"))
    nodes = stored.groupBy(F.col("leaf").alias("node")).agg(F.sum("n").alias("rows"), total("h1").alias("sum1"), total("h2").alias("sum2"))
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("level"), F.shiftright("node", bits - b).alias("node")) for b in levels(bits)]))
    (nodes.select(each.alias("at"), *CHECKSUMS).groupBy("at.level", "at.node").agg(*[F.sum(c).alias(c) for c in CHECKSUMS])
     .coalesce(1).write.partitionBy("level").parquet(f"{root}/tree"))


def unequal_leaves(spark: SparkSession, left: str, right: str) -> list[int]:
    """The leaves whose checksums differ, found from the root down: a level is read below unequal nodes only."""
    trees = [spark.read.schema("node int, rows long, sum1 decimal(38,0), sum2 decimal(38,0), level int").parquet(f"{p}/tree")
             for p in (left, right)]
    depth = sorted(r.level for r in trees[0].select("level").distinct().unionAll(trees[1].select("level").distinct()).distinct().collect())
    nodes: list[int] | None = None
    for above, b in zip([None, *depth], depth):
        l, r = (t.where(F.col("level") == b) for t in trees)
        if nodes is not None:
            below = F.shiftright("node", b - above).isin(nodes)
            l, r = l.where(below), r.where(below)
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in CHECKSUMS]
        j = l.alias("l").join(r.alias("r"), F.col("l.node") == F.col("r.node"), "full").where(~(same[0] & same[1] & same[2]))
        nodes = sorted(x[0] for x in j.select(F.coalesce("l.node", "r.node")).collect())  # at most 2 ** b numbers
        if not nodes:
            return []
    return nodes or []


def match_stored(spark: SparkSession, left: str, right: str) -> DataFrame:
    """left_rows, right_rows, matched_rows, only_left_rows, only_right_rows, leaves_read of two stored trees: the totals of
    a row match, from the checksums of equal ranges and the rows of unequal ones."""
    leaves = unequal_leaves(spark, left, right)
    sides = [spark.read.schema(ROWS).parquet(f"{p}/rows").where(F.col("leaf").isin(leaves)) for p in (left, right)]
    counted = (sides[0].select("h1", "h2", F.col("n").alias("l"), F.lit(0).alias("r"))
               .unionByName(sides[1].select("h1", "h2", F.lit(0).alias("l"), F.col("n").alias("r")))
               .groupBy("h1", "h2").agg(F.sum("l").alias("l"), F.sum("r").alias("r")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    unlike = counted.agg(zero(F.sum(F.least("l", "r"))).alias("matched"), zero(F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0)))).alias("ol"),
                         zero(F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0)))).alias("onr"))
    rows = lambda p: spark.read.schema("rows long, level int").parquet(f"{p}/tree").where("level = 0").agg(zero(F.sum("rows"))).scalar()
    l, r = rows(left), rows(right)
    return unlike.select(l.alias("left_rows"), r.alias("right_rows"), (l - F.col("ol")).alias("matched_rows"),
                         F.col("ol").alias("only_left_rows"), F.col("onr").alias("only_right_rows"), F.lit(len(leaves)).alias("leaves_read"))
