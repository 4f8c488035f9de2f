"""Table access and the deterministic derivations used as the 'other side'.

The right side of a comparison, the change feed and the new snapshots are all
derived from the given tables by arithmetic on keys (never random), so every
derivation has an exact SQL twin in :mod:`concord.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _copies(df: DataFrame, n) -> DataFrame:
    """Each row ``n`` times (n is 1 or 2 here), in one scan."""
    return df.select("*", F.explode(F.array_repeat(F.lit(0), n)).alias("_copy")).drop("_copy")


def lineitem_right(li: DataFrame) -> DataFrame:
    """Altered copy: rows with l_orderkey % 97 = 0 dropped, rows with % 89 = 0 (after the drop) doubled."""
    k = F.col("l_orderkey")
    return _copies(li.where(k % 97 != 0), F.when(k % 89 == 0, 2).otherwise(1))


def orders_right(o: DataFrame) -> DataFrame:
    """Perturbed copy of orders for the scenario matrix.

    % 7 -> status lower-cased; % 11 -> priority with a trailing blank;
    % 13 -> price + 1e-7; % 17 -> order date + 1 second; % 19 -> row doubled.
    """
    k = F.col("o_orderkey")
    p = o.select(
        "o_orderkey", "o_custkey",
        F.when(k % 7 == 0, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 13 == 0, F.col("o_totalprice") + F.lit(1e-7)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 17 == 0, F.col("o_orderdate") + F.expr("INTERVAL 1 SECOND"))
        .otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        F.when(k % 11 == 0, F.concat("o_orderpriority", F.lit(" "))).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"))
    return _copies(p, F.when(k % 19 == 0, 2).otherwise(1))


def customer_right(c: DataFrame) -> DataFrame:
    """% 23 dropped, % 29 doubled, % 31 balance + 1 (for key and profile diagnostics)."""
    k = F.col("c_custkey")
    kept = c.where(k % 23 != 0).select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(k % 31 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment")
    return _copies(kept, F.when(k % 29 == 0, 2).otherwise(1))


# ------------------------------------------------------------------ change feed

FEED_BASE_TS = "2024-01-01 00:00:00"


def orders_change_feed(o: DataFrame) -> DataFrame:
    """Change feed of orders over three commit versions, derived in one scan (each order emits its changes).

    v1: every order inserted.  v2: keys % 3 = 1 updated (price + 1, status 'U')
    written as a delete of the old image and an insert of the new one.  v3:
    keys % 3 = 2 and % 5 = 0 deleted; keys % 3 = 1 and % 7 = 0 updated again
    (price + 2).  _commit_timestamp = base + version days.
    """
    k = F.col("o_orderkey")

    def img(status, price):
        return [F.col("o_orderkey"), F.col("o_custkey"), status.alias("o_orderstatus"), price.alias("o_totalprice"),
                F.col("o_orderdate"), F.col("o_orderpriority")]

    orig = img(F.col("o_orderstatus"), F.col("o_totalprice"))
    upd1 = img(F.lit("U"), F.col("o_totalprice") + 1)
    upd2 = img(F.lit("U"), F.col("o_totalprice") + 2)

    def change(cond, image, kind, version):
        return F.when(cond, F.struct(*image, F.lit(kind).alias("_change_type"),
                                     F.lit(version).cast("bigint").alias("_commit_version")))
    every = F.lit(True)
    changes = F.array(change(every, orig, "insert", 1),
                      change(k % 3 == 1, orig, "delete", 2), change(k % 3 == 1, upd1, "insert", 2),
                      change((k % 3 == 2) & (k % 5 == 0), orig, "delete", 3),
                      change((k % 3 == 1) & (k % 7 == 0), upd1, "delete", 3),
                      change((k % 3 == 1) & (k % 7 == 0), upd2, "insert", 3))
    return (o.select(F.explode(F.filter(changes, lambda x: x.isNotNull())).alias("c")).select("c.*")
            .withColumn("_commit_timestamp", F.to_timestamp_ntz(F.lit(FEED_BASE_TS))
                        + F.make_dt_interval(F.col("_commit_version"))))


def orders_snapshot2(o: DataFrame) -> DataFrame:
    """A second full snapshot of orders, in one scan: % 3 = 2 and % 5 = 0 gone, % 3 = 1 repriced, and a new
    order (key + 1e9, status 'N') for every key % 41 = 0."""
    k = F.col("o_orderkey")
    kept = F.struct(k.alias("o_orderkey"), F.col("o_custkey"),
                    F.when(k % 3 == 1, F.lit("U")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                    F.when(k % 3 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                    F.col("o_orderdate"), F.col("o_orderpriority"))
    new = F.struct((k + 1_000_000_000).alias("o_orderkey"), F.col("o_custkey"), F.lit("N").alias("o_orderstatus"),
                   F.col("o_totalprice"), F.col("o_orderdate"), F.col("o_orderpriority"))
    rows = F.array(F.when(~((k % 3 == 2) & (k % 5 == 0)), kept), F.when(k % 41 == 0, new))
    return o.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r")).select("r.*")


def anonymous(ev: DataFrame) -> DataFrame:
    """events of which one user in 40 is unknown: user_id NULL."""
    return ev.withColumn("user_id", F.when(F.col("user_id") % 40 != 0, F.col("user_id")))


def sensor_stream(ev: DataFrame) -> DataFrame:
    """events as a sensor stream: name = 'user_' || user_id (NULL for unknown users), timestamp = ts, value."""
    return anonymous(ev).select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("name"),
                     F.col("ts").alias("timestamp"), F.col("value"))


def orders_legacy(o: DataFrame) -> DataFrame:
    """Left (legacy) side for the drill-down: history from 1996 only, with current/deleted flags.

    current = 'N' for keys % 10 = 0; deleted = 'Y' for keys % 15 = 0.
    """
    k = F.col("o_orderkey")
    return o.where(F.year("o_orderdate") >= 1996).select(
        "*", F.when(k % 10 == 0, "N").otherwise("Y").alias("current_flag"),
        F.when(k % 15 == 0, "Y").otherwise("N").alias("deleted_flag"))


def with_modified(snap: DataFrame) -> DataFrame:
    """Snapshot 2 with a modification time: changed (% 3 = 1) and new rows at 2024-01-02, others at order date."""
    k = F.col("o_orderkey")
    return snap.withColumn("o_modified", F.when((k % 3 == 1) | (k >= 1_000_000_000),
                                                F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00")))
                           .otherwise(F.col("o_orderdate")))


def part_dim(p: DataFrame) -> DataFrame:
    """Part dimension with every 7th part missing (late-arriving members)."""
    return p.where(F.col("p_partkey") % 7 != 0)


def orders_left_gap(o: DataFrame) -> DataFrame:
    """Left side for the key-gap verdict: orders without the keys % 3 = 0 (a partial backfill)."""
    return o.where(F.col("o_orderkey") % 3 != 0)
