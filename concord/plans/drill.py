"""Registered drill-down queries (A10-A12, A15, P5-P7, Q10, Q12) over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drilldown as DD
from . import data as D
from . import sqlparts as S
from .registry import query, rounded


def _sides(spark, sf):
    o = D.load(spark, sf, "orders")
    left = DD.current_records(D.orders_legacy(o), "current_flag", "deleted_flag")
    return left, o


@query("filter_impact", ("A12", "P5"),
       sql=f"""SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count_if(current_flag = 'Y') AS BIGINT) AS current_rows,
                      CAST(count_if(deleted_flag = 'N') AS BIGINT) AS not_deleted_rows,
                      CAST(count_if(current_flag = 'Y' AND deleted_flag = 'N') AS BIGINT) AS current_not_deleted_rows,
                      CAST(count(*) - count_if(current_flag = 'Y') AS BIGINT) AS removed_by_current,
                      CAST(count(*) - count_if(deleted_flag = 'N') AS BIGINT) AS removed_by_deleted
               FROM ({S.ORDERS_LEGACY})""")
def filter_impact(spark, sf):
    return DD.filter_impact(D.orders_legacy(D.load(spark, sf, "orders")), "current_flag", "deleted_flag")


@query("date_scope", ("A11", "P7"),
       sql=f"""WITH l AS ({S.ORDERS_LEGACY_CURRENT}), r AS (SELECT * FROM orders)
               SELECT (SELECT min(o_orderdate) FROM l) AS left_min_date, (SELECT max(o_orderdate) FROM l) AS left_max_date,
                      (SELECT CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) FROM l) AS left_unique_dates,
                      (SELECT min(o_orderdate) FROM r) AS right_min_date, (SELECT max(o_orderdate) FROM r) AS right_max_date,
                      (SELECT CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) FROM r) AS right_unique_dates,
                      b AS right_rows_before_left_min,
                      round(CASE WHEN g = 0 THEN NULL ELSE CAST(b AS DOUBLE) * 100.0 / CAST(g AS DOUBLE) END, 6) AS share_of_gap_pct
               FROM (SELECT (SELECT CAST(count(*) AS BIGINT) FROM r WHERE o_orderdate < (SELECT min(o_orderdate) FROM l)) AS b,
                            (SELECT count(*) FROM r) - (SELECT count(*) FROM l) AS g)""")
def date_scope(spark, sf):
    left, right = _sides(spark, sf)
    return rounded(DD.date_scope(left, right, "o_orderdate"))


@query("yearly_counts", ("A10", "J3", "N5", "F15"),
       sql=f"""SELECT CAST(coalesce(l.y, r.y) AS INTEGER) AS year, CAST(coalesce(l.n, 0) AS BIGINT) AS left_rows,
                      CAST(coalesce(r.n, 0) AS BIGINT) AS right_rows, CAST(coalesce(r.n, 0) - coalesce(l.n, 0) AS BIGINT) AS diff,
                      round(CASE WHEN coalesce(l.n, 0) = 0 THEN NULL
                                 ELSE CAST(coalesce(r.n, 0) - coalesce(l.n, 0) AS DOUBLE) * 100.0 / CAST(l.n AS DOUBLE) END, 2) AS pct_diff
               FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM ({S.ORDERS_LEGACY_CURRENT}) GROUP BY 1) l
               FULL JOIN (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1) r ON l.y = r.y""")
def yearly_counts(spark, sf):
    left, right = _sides(spark, sf)
    return DD.yearly_counts(left, right, "o_orderdate")


_DC = ["o_custkey", "o_orderstatus", "o_orderpriority"]


@query("distinct_coverage", ("A3",),
       sql=" UNION ALL ".join(
           f"SELECT '{c}' AS column_name, (SELECT CAST(count(DISTINCT {c}) AS BIGINT) FROM ({S.ORDERS_LEGACY_CURRENT})) AS left_distinct, "
           f"(SELECT CAST(count(DISTINCT {c}) AS BIGINT) FROM orders) AS right_distinct" for c in _DC))
def distinct_coverage(spark, sf):
    left, right = _sides(spark, sf)
    return DD.distinct_coverage(left, right, _DC)


@query("key_gap_verdict", ("Q12", "J6", "A15", "P10"),
       sql=f"""WITH l AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0),
                    r AS ({S.ORDERS_LEGACY_CURRENT}),
                    lk AS (SELECT DISTINCT o_custkey, o_orderpriority FROM l),
                    rk AS (SELECT DISTINCT o_custkey, o_orderpriority FROM r),
                    ol AS (SELECT * FROM lk WHERE NOT EXISTS (SELECT 1 FROM rk WHERE rk.o_custkey = lk.o_custkey AND rk.o_orderpriority = lk.o_orderpriority)),
                    orr AS (SELECT * FROM rk WHERE NOT EXISTS (SELECT 1 FROM lk WHERE rk.o_custkey = lk.o_custkey AND rk.o_orderpriority = lk.o_orderpriority)),
                    rem AS (SELECT * FROM l WHERE EXISTS (SELECT 1 FROM ol WHERE ol.o_custkey = l.o_custkey AND ol.o_orderpriority = l.o_orderpriority))
               SELECT a AS left_distinct_keys, b AS keys_only_in_left, c AS keys_only_in_right,
                      (SELECT CAST(count(*) AS BIGINT) FROM rem) AS remainder_rows,
                      (SELECT CAST(count(DISTINCT o_orderstatus) AS BIGINT) FROM rem) AS remainder_distinct_o_orderstatus,
                      (SELECT CAST(count(DISTINCT year(o_orderdate)) AS BIGINT) FROM rem) AS remainder_distinct_year,
                      round(CASE WHEN a = 0 THEN 0.0 ELSE CAST(b AS DOUBLE) * 100.0 / CAST(a AS DOUBLE) END, 2) AS missing_pct,
                      CASE WHEN CAST(b AS DOUBLE) / a > 0.95 THEN 'critical_missing'
                           WHEN CAST(b AS DOUBLE) / a > 0.05 THEN 'significant_gap' ELSE 'mostly_covered' END AS verdict
               FROM (SELECT (SELECT CAST(count(*) AS BIGINT) FROM lk) AS a, (SELECT CAST(count(*) AS BIGINT) FROM ol) AS b,
                            (SELECT CAST(count(*) AS BIGINT) FROM orr) AS c)""")
def key_gap_verdict(spark, sf):
    o = D.load(spark, sf, "orders")
    left = D.orders_left_gap(o).withColumn("year", F.year("o_orderdate"))
    right = DD.current_records(D.orders_legacy(o), "current_flag", "deleted_flag")
    return DD.key_gap(left, right, ["o_custkey", "o_orderpriority"], ["o_orderstatus", "year"])


@query("window_sample", ("Q10", "P6", "N4", "F16"),
       sql="""WITH c AS (SELECT least(CAST((SELECT max(o_orderdate) FROM orders) AS DATE) - INTERVAL 1 MONTH,
                                      CAST((SELECT max(l_shipdate) FROM lineitem) AS DATE) - INTERVAL 30 DAY) AS cut)
              SELECT 'left' AS side, CAST(count(*) AS BIGINT) AS rows, min(o_orderdate) AS min_date FROM orders, c WHERE o_orderdate >= cut
              UNION ALL
              SELECT 'right', CAST(count(*) AS BIGINT), min(l_shipdate) FROM lineitem, c WHERE l_shipdate >= cut""")
def window_sample(spark, sf):
    o = D.load(spark, sf, "orders").select(F.col("o_orderdate").alias("d"))
    li = D.load(spark, sf, "lineitem").select(F.col("l_shipdate").alias("d"))
    l, r = DD.window_sample(o, li, "d")
    return (l.agg(F.lit("left").alias("side"), F.count(F.lit(1)).cast("bigint").alias("rows"), F.min("d").alias("min_date"))
            .unionByName(r.agg(F.lit("right").alias("side"), F.count(F.lit(1)).cast("bigint").alias("rows"),
                               F.min("d").alias("min_date"))))


@query("year_scope_test", ("Q12", "P7", "A10"),
       sql=f"""WITH l AS ({S.ORDERS_LEGACY_CURRENT}), f AS (SELECT min(year(o_orderdate)) AS y FROM l),
                    c AS (SELECT (SELECT count(*) FROM l) AS lr, (SELECT count(*) FROM orders, f WHERE year(o_orderdate) >= f.y) AS rr)
               SELECT CAST((SELECT y FROM f) AS INTEGER) AS first_left_year, CAST(lr AS BIGINT) AS left_rows,
                      CAST(rr AS BIGINT) AS right_rows_from_year, rr = lr AS matches, CAST(rr - lr AS BIGINT) AS remaining_diff,
                      round(CASE WHEN lr = 0 THEN 0.0 ELSE CAST(rr - lr AS DOUBLE) * 100.0 / CAST(lr AS DOUBLE) END, 2) AS remaining_pct
               FROM c""")
def year_scope_test(spark, sf):
    left, right = _sides(spark, sf)
    return DD.year_scope_test(left, right, "o_orderdate")


_CAUSE_ATTRS = ("status", "priority", "year", "segment")
_CAUSE_SETS = [(a,) for a in _CAUSE_ATTRS] + [(a, b) for i, a in enumerate(_CAUSE_ATTRS) for b in _CAUSE_ATTRS[i + 1:]]


@query("gap_causes", ("Q12", "A15"),
       sql=f"""WITH l AS (SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority,
                            CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(o_custkey % 5 AS VARCHAR) AS segment FROM orders),
                    r AS (SELECT o_orderkey FROM orders
                          WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AND o_orderkey % 50 <> 0),
                    t AS (SELECT l.*, CASE WHEN r.o_orderkey IS NULL THEN 1 ELSE 0 END AS gone FROM l LEFT JOIN r USING (o_orderkey)),
                    n AS (SELECT sum(gone) AS o, count(*) - sum(gone) AS i FROM t),
                    c AS (SELECT concat_ws(' & ', {", ".join(f"CASE WHEN grouping({a}) = 0 THEN '{a}=' || {a} END" for a in _CAUSE_ATTRS)}) AS cause,
                                 CAST(4 - {" - ".join(f"grouping({a})" for a in _CAUSE_ATTRS)} AS INTEGER) AS n_columns,
                                 CAST(sum(gone) AS BIGINT) AS missing, CAST(count(*) - sum(gone) AS BIGINT) AS present
                          FROM t GROUP BY GROUPING SETS ({", ".join("(" + ", ".join(s) + ")" for s in _CAUSE_SETS)})),
                    s AS (SELECT c.*, CAST(missing AS DOUBLE) / o AS support, CAST(missing AS DOUBLE) / (missing + present) AS precision,
                                 CASE WHEN o > missing THEN (CAST(missing AS DOUBLE) / (missing + present))
                                      / (CAST(o - missing AS DOUBLE) / (o - missing + i - present)) END AS risk_ratio FROM c, n),
                    f AS (SELECT *, 2 * support * precision / (support + precision) AS f1 FROM s
                          WHERE support >= 0.05 AND missing > 0 AND (risk_ratio IS NULL OR risk_ratio >= 2))
               SELECT cause, n_columns, missing, present, round(support, 6) AS support, round(precision, 6) AS precision,
                      round(risk_ratio, 6) AS risk_ratio, round(f1, 6) AS f1,
                      CAST(row_number() OVER (ORDER BY round(f1, 9) DESC, n_columns, cause) AS INTEGER) AS place FROM f""")
def gap_causes(spark, sf):
    """Which orders are missing: a copy without urgent finished orders (and a few others), the cause searched for."""
    o = D.load(spark, sf, "orders")
    left = o.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
                    F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 5).alias("segment"))
    lost = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT") | (F.col("o_orderkey") % 50 == 0)
    return rounded(DD.gap_causes(left, o.where(~lost), ["o_orderkey"], _CAUSE_ATTRS))
