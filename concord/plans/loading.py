"""Registered change-capture and load queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup as DU
from ..operators import load as L
from . import data as D
from . import sqlparts as S
from .registry import query, rounded

_OC = ", ".join(S.ORDERS_COLS)
_CHANGED = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in S.ORDERS_COLS if c != "o_orderkey")
V2_TS = "TIMESTAMP '2024-01-02 00:00:00'"


def _sides(spark, sf):
    o = D.load(spark, sf, "orders")
    return o, D.orders_snapshot2(o)


@query("hash_merge", ("M1", "N15"),
       sql=f"""SELECT *, 'delete' AS _change_type FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM ({S.ORDERS_SNAPSHOT2}))
               UNION ALL
               SELECT *, 'insert' AS _change_type FROM (SELECT * FROM ({S.ORDERS_SNAPSHOT2}) EXCEPT ALL SELECT * FROM orders)""")
def hash_merge(spark, sf):
    t, s = _sides(spark, sf)
    return L.hash_merge(t, s)[1]


_MS = f"""WITH t AS (SELECT * FROM orders), s AS ({S.ORDERS_SNAPSHOT2})"""


@query("merge_split", ("J13",),
       sql=f"""{_MS}
               SELECT _merge, CAST(count(*) AS BIGINT) AS rows FROM (
                 SELECT CASE WHEN t.o_orderkey IS NULL THEN 'not_matched' WHEN s.o_orderkey IS NULL THEN 'not_matched_by_source'
                             WHEN {_CHANGED} THEN 'matched_changed' ELSE 'matched_unchanged' END AS _merge
                 FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey) GROUP BY _merge""")
def merge_split(spark, sf):
    t, s = _sides(spark, sf)
    return L.split_counts(L.merge_split(t, s, ["o_orderkey"]))


@query("full_merge_changes", ("M2", "M3", "N22"),
       sql=f"""{_MS}
               SELECT t.*, 'delete' AS _change_type, CAST(2 AS BIGINT) AS _commit_version, {V2_TS} AS _commit_timestamp
               FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
               WHERE (s.o_orderkey IS NULL AND t.o_orderpriority = '1-URGENT') OR (s.o_orderkey IS NOT NULL AND ({_CHANGED}))
               UNION ALL
               SELECT s.*, 'insert', CAST(2 AS BIGINT), {V2_TS}
               FROM s LEFT JOIN t ON t.o_orderkey = s.o_orderkey
               WHERE t.o_orderkey IS NULL OR ({_CHANGED})""")
def full_merge_changes(spark, sf):
    t, s = _sides(spark, sf)
    _, ch = L.full_merge(t, s, ["o_orderkey"], delete_scope=lambda col: col("o_orderpriority") == "1-URGENT",
                         version=2, commit_ts=F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00")))
    return ch


@query("full_merge_target", ("M2", "N22"),
       sql=f"""{_MS}
               SELECT s.* FROM s
               UNION ALL
               SELECT t.* FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
               WHERE s.o_orderkey IS NULL AND t.o_orderpriority <> '1-URGENT'""")
def full_merge_target(spark, sf):
    t, s = _sides(spark, sf)
    return L.full_merge(t, s, ["o_orderkey"], delete_scope=lambda col: col("o_orderpriority") == "1-URGENT")[0]


_LATEST = f"""(SELECT * EXCLUDE (rn) FROM (
   SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _commit_version DESC,
                                CASE WHEN _change_type = 'delete' THEN 0 ELSE 1 END DESC) AS rn
   FROM ({S.ORDERS_FEED}) WHERE _commit_version > 1 AND _change_type IN ('insert', 'update_postimage', 'delete'))
 WHERE rn = 1)"""


@query("latest_change", ("W3", "W2", "N13", "N14"), sql=f"SELECT * FROM {_LATEST}")
def latest_change(spark, sf):
    feed = D.orders_change_feed(D.load(spark, sf, "orders"))
    return DU.latest_change(feed.where(F.col("_commit_version") > 1), ["o_orderkey"])


@query("delta_load", ("M4", "M6", "S13"),
       sql=f"""SELECT {_OC} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_LATEST})
               UNION ALL SELECT {_OC} FROM {_LATEST} WHERE _change_type <> 'delete'""")
def delta_load(spark, sf):
    o = D.load(spark, sf, "orders")
    feed = D.orders_change_feed(o)
    # M6: an empty target (first run) or a forced reload takes the whole feed; version 1 is the last one applied
    start = 0 if L.load_mode(o) == "full" else 2
    return L.delta_load(o, feed, ["o_orderkey"], start_version=start)


@query("change_history", ("W7", "S14"),
       sql=f"""SELECT o_orderkey, _commit_version, _change_type, o_totalprice,
                      lag(_commit_version) OVER w AS prev_version, lag(_change_type) OVER w AS prev_change_type,
                      lag(o_totalprice) OVER w AS prev_o_totalprice, row_number() OVER w AS change_seq
               FROM ({S.ORDERS_FEED})
               WINDOW w AS (PARTITION BY o_orderkey ORDER BY _commit_version, CASE WHEN _change_type = 'delete' THEN 0 ELSE 1 END)""")
def change_history(spark, sf):
    feed = D.orders_change_feed(D.load(spark, sf, "orders"))
    h = DU.change_history(feed, ["o_orderkey"], value_cols=["o_totalprice"])
    return h.select("o_orderkey", "_commit_version", "_change_type", "o_totalprice", "prev_version",
                    "prev_change_type", "prev_o_totalprice", F.col("change_seq").cast("bigint").alias("change_seq"))


@query("change_counts", ("S14", "A21"),
       sql=f"""SELECT _commit_version, _change_type, CAST(count(*) AS BIGINT) AS changes
               FROM ({S.ORDERS_FEED}) WHERE _commit_timestamp >= TIMESTAMP '2024-01-02 00:00:00' GROUP BY ALL""")
def change_counts(spark, sf):
    feed = D.orders_change_feed(D.load(spark, sf, "orders"))
    return (feed.where(F.col("_commit_timestamp") >= F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00")))
            .groupBy("_commit_version", "_change_type").agg(F.count(F.lit(1)).cast("bigint").alias("changes")))


@query("dedup_documents", ("W1", "U3"),
       sql="""SELECT doc_id, lang, source, n_chars FROM (
                SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1""")
def dedup_documents(spark, sf):
    d = D.load(spark, sf, "documents")
    return DU.drop_exact_duplicates(d, ["text"], newest=F.col("doc_id"), keep=["doc_id", "lang", "source", "n_chars"])


_WM = "(SELECT max(o_orderdate) FROM orders)"


@query("watermark_load", ("M7",),
       sql=f"""WITH s AS (SELECT {_OC} FROM ({S.ORDERS_SNAPSHOT2_MOD}) WHERE o_modified > {_WM})
               SELECT * FROM s UNION ALL SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)""")
def watermark_load(spark, sf):
    o, _ = _sides(spark, sf)
    src = D.with_modified(D.orders_snapshot2(o))
    last = o.select(F.max("o_orderdate")).scalar()
    return L.watermark_load(o, src.select(*S.ORDERS_COLS, "o_modified"), ["o_orderkey"], "o_modified", last) \
        .select(*S.ORDERS_COLS)


@query("watermark_load_all_keys", ("M8",),
       sql=f"""WITH s AS (SELECT {_OC} FROM ({S.ORDERS_SNAPSHOT2_MOD}) WHERE o_modified > {_WM}),
                    n AS (SELECT * FROM s UNION ALL SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s))
               SELECT * FROM n WHERE o_orderkey IN (SELECT o_orderkey FROM ({S.ORDERS_SNAPSHOT2}))""")
def watermark_load_all_keys(spark, sf):
    o, _ = _sides(spark, sf)
    src = D.with_modified(D.orders_snapshot2(o))
    last = o.select(F.max("o_orderdate")).scalar()
    return L.watermark_load(o, src.select(*S.ORDERS_COLS, "o_modified"), ["o_orderkey"], "o_modified", last,
                            delete_missing=True).select(*S.ORDERS_COLS)


@query("forward_append", ("M9",),
       sql=f"""SELECT {_OC} FROM orders UNION ALL
               SELECT {_OC} FROM ({S.ORDERS_SNAPSHOT2_MOD}) WHERE o_modified > {_WM}""")
def forward_append(spark, sf):
    o, _ = _sides(spark, sf)
    src = D.with_modified(D.orders_snapshot2(o))
    last = o.select(F.max("o_orderdate")).scalar()
    return L.forward_append(o, src, "o_modified", last)


@query("ranged_reload", ("M10",),
       sql=f"""SELECT * FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01')
               UNION ALL
               SELECT * FROM ({S.ORDERS_SNAPSHOT2}) WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'""")
def ranged_reload(spark, sf):
    t, s = _sides(spark, sf)
    return L.ranged_reload(t, s, "o_orderdate", F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00")),
                           F.to_timestamp_ntz(F.lit("1998-07-01 00:00:00")))


_SCD_CH = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in ("o_totalprice", "o_orderstatus"))
_T0, _T1 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-02 00:00:00'"


@query("scd2", ("M11",),
       sql=f"""{_MS}
               SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, coalesce(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority,
                      {_T0} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current, FALSE AS is_deleted
               FROM t JOIN s ON t.o_orderkey = s.o_orderkey WHERE NOT ({_SCD_CH})
               UNION ALL
               SELECT t.*, {_T0}, {_T1}, FALSE, FALSE FROM t JOIN s ON t.o_orderkey = s.o_orderkey WHERE {_SCD_CH}
               UNION ALL
               SELECT s.*, {_T1}, CAST(NULL AS TIMESTAMP), TRUE, FALSE FROM s LEFT JOIN t ON t.o_orderkey = s.o_orderkey
               WHERE t.o_orderkey IS NULL OR ({_SCD_CH})
               UNION ALL
               SELECT t.*, {_T0}, {_T1}, FALSE, TRUE FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)""")
def scd2(spark, sf):
    t, s = _sides(spark, sf)
    init = L.scd2_initial(t, F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    return L.scd2(init, s, ["o_orderkey"], ["o_totalprice", "o_orderstatus"],
                  F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00")), scd1=["o_orderpriority"])


@query("stub_members", ("M12",),
       sql=f"""SELECT DISTINCT l_partkey AS p_partkey, 'Unknown' AS p_name, 'Unknown' AS p_brand, CAST(NULL AS VARCHAR) AS p_type,
                      CAST(-1 AS INTEGER) AS p_size, CAST(NULL AS DOUBLE) AS p_retailprice
               FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM ({S.PART_DIM}))""")
def stub_members(spark, sf):
    li, p = D.load(spark, sf, "lineitem"), D.part_dim(D.load(spark, sf, "part"))
    return L.stub_members(li, p, "l_partkey", "p_partkey",
                          {"p_name": F.lit("Unknown"), "p_brand": F.lit("Unknown"), "p_size": F.lit(-1)})


@query("first_seen", ("M13", "F13"),
       sql=f"""SELECT coalesce(e.o_orderkey, b.o_orderkey) AS o_orderkey, least(e.o_orderdate, b.t) AS first_seen
               FROM orders e FULL JOIN (SELECT o_orderkey, TIMESTAMP '1998-01-01 00:00:00' AS t FROM ({S.ORDERS_SNAPSHOT2})) b
               ON e.o_orderkey = b.o_orderkey""")
def first_seen(spark, sf):
    t, s = _sides(spark, sf)
    return L.first_seen(t.select("o_orderkey", F.col("o_orderdate").alias("first_seen")), s, ["o_orderkey"],
                        ingest_time=F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00")))


@query("hot_slice", ("M14", "F16"),
       sql="""SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders
              WHERE o_orderdate >= CAST((SELECT max(o_orderdate) FROM orders) AS DATE) - INTERVAL 6 MONTH GROUP BY 1""")
def hot_slice(spark, sf):
    o = D.load(spark, sf, "orders")
    h = L.hot_slice(o, "o_orderdate", o.select(F.max("o_orderdate")).scalar())
    return h.groupBy("o_orderpriority").agg(F.count(F.lit(1)).cast("bigint").alias("orders"),
                                            F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("guarded_dim_join", ("J11", "F8", "A20"),
       sql=f"""SELECT coalesce(d.p_brand, 'Unknown') AS p_brand, CAST(count(*) AS BIGINT) AS lines,
                      round(sum(l.l_quantity), 2) AS quantity
               FROM lineitem l LEFT JOIN (SELECT * FROM ({S.PART_DIM}) WHERE p_partkey > 0 OR p_partkey IS NULL) d
               ON l.l_partkey = d.p_partkey GROUP BY 1""")
def guarded_dim_join(spark, sf):
    li, p = D.load(spark, sf, "lineitem"), D.part_dim(D.load(spark, sf, "part"))
    j = L.guarded_dim_join(li, p, "l_partkey", "p_partkey", ["p_brand"])
    return j.groupBy("p_brand").agg(F.count(F.lit(1)).cast("bigint").alias("lines"),
                                    F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("conformed_dimension", ("U2", "F23", "P11", "Q15", "N23"),
       sql="""SELECT md5(src || '|' || coalesce(CAST(c_custkey AS VARCHAR), '-1')) AS hk, CAST(c_custkey AS VARCHAR) AS bk, c_name,
                     src AS loaded_from, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at, TRUE AS in_use,
                     CAST(NULL AS VARCHAR) AS remarks
              FROM (SELECT *, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'SRC_A' ELSE 'SRC_B' END AS src FROM customer)""")
def conformed_dimension(spark, sf):
    c = D.load(spark, sf, "customer")
    as_of = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    slices = []
    for name, segs in (("SRC_A", ["BUILDING", "MACHINERY"]), ("SRC_B", None)):
        seg = F.col("c_mktsegment").isin(*segs) if segs else ~F.coalesce(
            F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit(False))
        sl = c.where(seg).select(L.surrogate_key(name, ["c_custkey"], algorithm="md5").alias("hk"),
                                 F.col("c_custkey").cast("string").alias("bk"), "c_name")
        slices.append(L.add_system_columns(sl, {"loaded_from": F.lit(name), "loaded_at": as_of, "in_use": F.lit(True),
                                                "remarks": F.lit(None).cast("string")}))
    return slices[0].unionByName(slices[1])


@query("key_uniqueness_check", ("Q15",),
       sql="""SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT c_custkey) AS BIGINT) AS distinct_keys,
                     CAST(count(*) - count(DISTINCT c_custkey) AS BIGINT) AS duplicate_keys, min(c_acctbal) AS min_value,
                     max(c_acctbal) AS max_value FROM customer""")
def key_uniqueness_check(spark, sf):
    from ..operators.quality import load_smoke_check
    return rounded(load_smoke_check(D.load(spark, sf, "customer"), ["c_custkey"], "c_acctbal"))
