"""Ordered scans against Spark's plain windows, with one key over many partitions and a NULL key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from concord.operators import ordered as O


def rows_of(n, seed, hot):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rng.random() < hot else rng.choice([None, "a", "b", *[f"k{j}" for j in range(40)]])
        out.append((k, rng.randrange(n // 4), i, rng.choice([None, rng.randrange(100)])))
    return out


@pytest.mark.parametrize("n,hot,parts", [(600, 0.4, 13), (60, 0.9, 40), (7, 0.0, 3), (300, 1.0, 64), (0, 0.0, 4)])
def test_scan_equals_plain_windows(spark, n, hot, parts):
    df = spark.createDataFrame(rows_of(n, n + parts, hot), "k string, t int, i int, v int")
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = O.in_order(df, ["k"], ["t", "i"])
        got = O.scan(rows, ["k"], seq=O.position(), s=O.running_sum(F.col("v")), x=O.running_xor(F.col("v")),
                     f=O.carried(F.col("v")), l1=O.lag(F.col("v")), l3=O.lag(F.col("v"), 3), n1=O.lead(F.col("v")),
                     n2=O.lead(F.col("i"), 2)).collect()
        if n >= 300:
            assert rows.select("_part").distinct().count() > parts // 2
            assert rows.filter("k = 'hot'").select("_part").distinct().count() > 3
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    w = Window.partitionBy("k").orderBy("t", "i")
    u = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.row_number().over(w).alias("seq"), F.sum("v").over(u).alias("s"),
                     F.bit_xor("v").over(u).alias("x"), F.last("v", True).over(u).alias("f"), F.lag("v").over(w).alias("l1"),
                     F.lag("v", 3).over(w).alias("l3"), F.lead("v").over(w).alias("n1"),
                     F.lead("i", 2).over(w).alias("n2")).collect()
    key = lambda r: r.i
    assert [r.asDict() for r in sorted(got, key=key)] == [r.asDict() for r in sorted(want, key=key)]


def test_scan_without_keys(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 3)
    got = O.scan(O.in_order(df, [], ["id"]), [], s=O.running_sum(F.col("v")), p=O.position()).orderBy("id").collect()
    assert [r.p for r in got] == list(range(1, 51))
    assert got[-1].s == sum(i % 3 for i in range(50))
