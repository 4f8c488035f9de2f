"""Registered schema, sync, migration and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import types as TY
from ..operators import compare as C
from ..operators import quality as QY
from ..operators import sync as SY
from ..operators import usage as U
from ..session import scratch_path
from ..sources import catalog as CT
from . import data as D
from . import sqlparts as S
from .profiles import stats_compare_sql
from .registry import query

# DuckDB type names of the driver tables -> right-system (Spark) names
_DUCK_TO_RIGHT = ("CASE data_type WHEN 'BIGINT' THEN 'BIGINT' WHEN 'INTEGER' THEN 'INT' WHEN 'DOUBLE' THEN 'DOUBLE' "
                  "WHEN 'VARCHAR' THEN 'STRING' WHEN 'TIMESTAMP' THEN 'TIMESTAMP_NTZ' WHEN 'FLOAT' THEN 'FLOAT' "
                  "WHEN 'FLOAT[]' THEN 'ARRAY<FLOAT>' ELSE data_type END")
_FIRST_LEFT = ("CASE {x} WHEN 'BIGINT' THEN 'bigint' WHEN 'INT' THEN 'int' WHEN 'DOUBLE' THEN 'float' WHEN 'FLOAT' THEN 'real' "
               "WHEN 'STRING' THEN 'varchar' WHEN 'TIMESTAMP_NTZ' THEN 'datetime2' ELSE 'sql_variant' END")
_ALLOWED = ("CASE {r} WHEN 'BIGINT' THEN ['BIGINT'] WHEN 'INT' THEN ['INT', 'SMALLINT'] WHEN 'DOUBLE' THEN ['FLOAT', 'REAL'] "
            "WHEN 'STRING' THEN ['VARCHAR', 'NVARCHAR', 'VARBINARY'] WHEN 'TIMESTAMP_NTZ' THEN ['DATETIME2', 'DATETIME'] END")


def _right_cat(spark, li):
    cat = CT.column_catalogue(spark, {"lineitem": li}, upper=True).select("column_name", "data_type")
    extra = spark.createDataFrame([("SYS_ROW_HASH", "BIGINT"), ("L_EXTRA", "STRING")], "column_name string, data_type string")
    return cat.unionByName(extra)


def _left_cat(spark, li):
    base = CT.as_left_catalogue(CT.column_catalogue(spark, {"lineitem": li}, upper=True)).select("column_name", "data_type")
    base = (base.where(F.col("column_name") != "L_SHIPDATE")
            .select(F.when(F.col("column_name") == "L_LINESTATUS", "L_LINESTATUS_OLD").otherwise(F.col("column_name"))
                    .alias("column_name"),
                    F.when(F.col("column_name") == "L_TAX", "varchar").otherwise(F.col("data_type")).alias("data_type")))
    extra = spark.createDataFrame([("META_CURRENT_RECORD_INDICATOR", "varchar"), ("L_COMMENT", "nvarchar"),
                                   ("L_SUPPLIER_SK", "bigint")], "column_name string, data_type string")
    return base.unionByName(extra)


_SCHEMA_SQL = f"""
WITH r0 AS (SELECT upper(column_name) AS column_name, {_DUCK_TO_RIGHT} AS data_type
            FROM information_schema.columns WHERE table_name = 'lineitem'),
     r AS (SELECT * FROM (SELECT * FROM r0 UNION ALL SELECT 'SYS_ROW_HASH', 'BIGINT' UNION ALL SELECT 'L_EXTRA', 'STRING')
           WHERE NOT starts_with(column_name, 'SYS')),
     l0 AS (SELECT CASE column_name WHEN 'L_LINESTATUS' THEN 'L_LINESTATUS_OLD' ELSE column_name END AS column_name,
                   CASE WHEN column_name = 'L_TAX' THEN 'varchar' ELSE {_FIRST_LEFT.format(x='data_type')} END AS data_type
            FROM r0 WHERE column_name <> 'L_SHIPDATE'
            UNION ALL SELECT 'META_CURRENT_RECORD_INDICATOR', 'varchar' UNION ALL SELECT 'L_COMMENT', 'nvarchar'
            UNION ALL SELECT 'L_SUPPLIER_SK', 'bigint'),
     l AS (SELECT regexp_replace(column_name, '_OLD$', '') AS l_key, data_type AS left_type FROM l0
           WHERE NOT starts_with(column_name, 'META') AND NOT ends_with(column_name, '_SK'))
SELECT coalesce(l.l_key, r.column_name) AS column_name, l.left_type, r.data_type AS right_type,
       ({_ALLOWED.format(r='r.data_type')})[1] AS expected_left_type,
       CASE WHEN r.data_type IS NULL THEN 'left_only' WHEN l.left_type IS NULL THEN 'right_only'
            WHEN coalesce(list_contains({_ALLOWED.format(r='r.data_type')}, upper(trim(split_part(l.left_type, '(', 1)))), FALSE)
            THEN 'match' ELSE 'type_mismatch' END AS status
FROM l FULL JOIN r ON l.l_key = r.column_name
"""


@query("schema_diff", ("Q1", "S2", "P1", "P2", "P8", "U5", "F7", "J1", "J5", "X1", "X2", "N2"), sql=_SCHEMA_SQL)
def schema_diff(spark, sf):
    li = D.load(spark, sf, "lineitem")
    left = CT.filter_catalogue(_left_cat(spark, li), prefixes=["META"], suffixes=["_SK"])
    right = CT.filter_catalogue(_right_cat(spark, li), prefixes=["SYS"])
    return C.schema_diff(left, right, strip_suffix_regex="_OLD$")


@query("schema_drift", ("Q19",),
       sql=f"""WITH b AS (SELECT column_name, {_DUCK_TO_RIGHT} AS before_type FROM information_schema.columns WHERE table_name = 'lineitem'),
                    a AS (SELECT column_name, CASE WHEN column_name = 'l_tax' THEN 'DECIMAL(10,2)' ELSE before_type END AS after_type
                          FROM b WHERE column_name <> 'l_linestatus' UNION ALL SELECT 'l_comment', 'STRING')
               SELECT coalesce(b.column_name, a.column_name) AS column_name, before_type, after_type,
                      CASE WHEN before_type IS NULL THEN 'added' WHEN after_type IS NULL THEN 'dropped'
                           WHEN before_type <> after_type THEN 'retyped' ELSE 'unchanged' END AS change
               FROM b FULL JOIN a ON a.column_name = b.column_name""")
def schema_drift(spark, sf):
    li = D.load(spark, sf, "lineitem")
    after = (li.withColumn("l_comment", F.concat_ws(" ", "l_returnflag", "l_linestatus")).drop("l_linestatus")
             .withColumn("l_tax", F.col("l_tax").cast("decimal(10,2)")))
    return C.spark_schema_diff(spark, li, after)


_ALL = D.TABLES


@query("column_catalogue", ("S2", "T1"),
       sql=f"""SELECT table_name, column_name, {_DUCK_TO_RIGHT} AS data_type, CAST(NULL AS INTEGER) AS numeric_precision,
                      CAST(NULL AS INTEGER) AS numeric_scale, CAST(ordinal_position AS INTEGER) AS ordinal_position
               FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{t}'" for t in _ALL)})""")
def column_catalogue(spark, sf):
    return CT.column_catalogue(spark, {t: D.load(spark, sf, t) for t in _ALL})


_DDL = ("CASE lower(dt) WHEN 'bigint' THEN 'BIGINT' WHEN 'int' THEN 'INT' WHEN 'float' THEN 'DOUBLE' WHEN 'real' THEN 'FLOAT' "
        "WHEN 'varchar' THEN 'STRING' WHEN 'datetime2' THEN 'TIMESTAMP' ELSE 'STRING' END")


_SYNC_DDL = _DDL.replace("lower(dt)", _FIRST_LEFT.format(x=_DUCK_TO_RIGHT))
_PK_PRIO = "CASE WHEN col = table_name || 'id' THEN '0' WHEN ends_with(col, 'id') THEN '1' ELSE '2' END"


@query("sync_config", ("M17", "M18", "F26", "S9", "F5"),
       sql=f"""WITH c AS (SELECT table_name, lower(column_name) AS col, {_SYNC_DDL} AS ddl
                          FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{t}'" for t in _ALL)}))
               SELECT table_name || 's' AS sync_table_name, '' AS last_sync_timestamp, 'lake.raw.' || table_name AS target_table,
                      string_agg(col, ', ' ORDER BY col) AS column_list,
                      arg_min(col, {_PK_PRIO} || col) AS primary_key_column,
                      'SELECT ' || string_agg('CAST(NULL AS ' || ddl || ') AS ' || col, ', ' ORDER BY col) || ' WHERE 1=0' AS phantom_row_sql
               FROM c GROUP BY table_name""")
def sync_config(spark, sf):
    cat = CT.as_left_catalogue(CT.column_catalogue(spark, {t: D.load(spark, sf, t) for t in _ALL}))
    return SY.sync_config(cat, "lake.raw").drop("column_mapping")


_MIGRATE = ("region", "nation", "supplier", "customer", "lineitem")


def _migration_tables(spark, sf):
    """The tables to copy: lineitem with values that are no numbers, one copy that fails while it runs, one table
    without columns."""
    tables = {t: D.load(spark, sf, t) for t in _MIGRATE}
    k = F.col("l_orderkey")
    tables["lineitem"] = tables["lineitem"].withColumn(
        "l_tax", F.when(k % 50 == 0, F.lit(float("nan"))).when(k % 50 == 1, F.lit(float("inf")))
        .when(k % 50 == 2, F.lit(float("-inf"))).otherwise(F.col("l_tax")))
    tables["broken"] = tables["supplier"].withColumn(
        "s_name", F.when(F.col("s_suppkey") >= 0, F.raise_error(F.lit("unreadable row"))).otherwise(F.col("s_name")))
    tables["bare"] = tables["region"].select()
    return tables


_MIGRATED_SQL = " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, count(*) AS rows, round(sum({c}), 2) AS checksum, 0 AS null_values FROM {t}"
     for t, c in (("region", "r_regionkey"), ("nation", "n_nationkey + n_regionkey"),
                  ("supplier", "s_suppkey + s_nationkey + s_acctbal"), ("customer", "c_custkey + c_nationkey + c_acctbal"))]
    + ["""SELECT 'lineitem', count(*), round(sum(l_orderkey + l_partkey + l_suppkey + l_linenumber + l_quantity + l_extendedprice
                 + l_discount + CASE WHEN l_orderkey % 50 IN (0, 1, 2) THEN 0 ELSE l_tax END), 2),
                 count_if(l_orderkey % 50 IN (0, 1, 2)) FROM lineitem"""])


@query("migration_report", ("M16", "S7", "S8", "A21", "F10", "F25"),
       sql=f"""SELECT environment, table_name, status, CAST(rows AS BIGINT) AS rows, CAST(rows AS BIGINT) AS rows_read_back,
                      CAST(null_values AS BIGINT) AS null_values, CAST(checksum AS DOUBLE) AS checksum, error
               FROM (SELECT unnest(['dev', 'test']) AS environment),
                    (SELECT table_name, 'ok' AS status, rows, null_values, checksum, CAST(NULL AS VARCHAR) AS error FROM ({_MIGRATED_SQL})
                     UNION ALL SELECT 'bare', 'skipped', 0, NULL, NULL, NULL
                     UNION ALL SELECT 'broken', 'error', 0, NULL, NULL, 'unreadable row')""")
def migration_report(spark, sf):
    report = SY.migrate_tables(spark, _migration_tables(spark, sf), scratch_path(spark, "migration"), ("dev", "test"))
    # the engine's error text also names classes and plans: what the failing row said is what counts here
    said = F.when(F.col("error").contains("unreadable row"), "unreadable row").otherwise(F.col("error"))
    return report.drop("types").withColumn("error", said)


@query("migration_status_counts", ("A21",),
       sql=f"""SELECT env AS environment,
                      (SELECT CAST(count(DISTINCT table_name) AS BIGINT) FROM information_schema.columns
                       WHERE table_name IN ({", ".join(f"'{t}'" for t in _MIGRATE)})) AS ok,
                      CAST(1 AS BIGINT) AS error, CAST(1 AS BIGINT) AS skipped
               FROM (SELECT unnest(['dev', 'test']) AS env)""")
def migration_status_counts(spark, sf):
    return U.status_counts(migration_report(spark, sf))


@query("remainder_head", ("T3", "Q21", "U4"),
       sql=f"""SELECT * FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM ({S.LINEITEM_RIGHT}))
               ORDER BY {", ".join(S.LINEITEM_COLS)} LIMIT 10""")
def remainder_head(spark, sf):
    li = D.load(spark, sf, "lineitem")
    return li.exceptAll(D.lineitem_right(li)).orderBy(*S.LINEITEM_COLS).limit(10)


_LI_TYPES = {**dict.fromkeys(S.LINEITEM_COLS, "double"), **dict.fromkeys(("l_orderkey", "l_partkey", "l_suppkey"), "bigint"),
             "l_linenumber": "int", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


def _head_cells_sql(a: str, b: str, side: str) -> str:
    order = ", ".join(S.LINEITEM_COLS)
    cells = " UNION ALL ".join(f"SELECT position, '{c}' AS column_name, '{t}' AS {side}_type, CAST({c} AS VARCHAR) AS {side}_value FROM h"
                               for c, t in _LI_TYPES.items())
    return f"""(WITH h AS (SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position
                          FROM (SELECT * FROM ({a}) EXCEPT ALL SELECT * FROM ({b})) ORDER BY position LIMIT 10) {cells})"""


_LI_WHOLE = "SELECT * FROM lineitem"


@query("remainder_cells", ("Q21", "T3"),
       sql=f"""SELECT coalesce(l.position, r.position) AS position, coalesce(l.column_name, r.column_name) AS column_name,
                      left_type, left_value, right_type, right_value
               FROM {_head_cells_sql(_LI_WHOLE, S.LINEITEM_RIGHT, "left")} l
               FULL JOIN {_head_cells_sql(S.LINEITEM_RIGHT, _LI_WHOLE, "right")} r
                 ON l.position = r.position AND l.column_name = r.column_name""")
def remainder_cells(spark, sf):
    """The first rows that only lineitem and only its copy have, with their types, beside each other."""
    li = D.load(spark, sf, "lineitem")
    return C.remainder_cells(li, D.lineitem_right(li), S.LINEITEM_COLS)


_PARITY_SQL = f"""WITH l AS (SELECT date_trunc('month', l_shipdate) AS period, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY 1),
     r AS (SELECT date_trunc('month', l_shipdate) AS period, sum(l_quantity) AS q, count(*) AS n FROM ({S.LINEITEM_RIGHT}) GROUP BY 1),
     j AS (SELECT coalesce(l.period, r.period) AS period, l.q AS left_quantity, r.q AS right_quantity, l.n AS left_rows, r.n AS right_rows
           FROM l FULL JOIN r ON l.period = r.period),
     d AS (SELECT *, CASE WHEN coalesce(left_quantity, 0) = coalesce(right_quantity, 0) THEN 0.0
                          WHEN coalesce(left_quantity, 0) = 0 THEN NULL
                          ELSE round((coalesce(right_quantity, 0) - coalesce(left_quantity, 0)) * 100.0 / coalesce(left_quantity, 0), 6) END AS quantity_diff_pct,
                     CASE WHEN coalesce(left_rows, 0) = coalesce(right_rows, 0) THEN 0.0
                          WHEN coalesce(left_rows, 0) = 0 THEN NULL
                          ELSE round((coalesce(right_rows, 0) - coalesce(left_rows, 0)) * 100.0 / coalesce(left_rows, 0), 6) END AS rows_diff_pct FROM j),
     o AS (SELECT *, coalesce(abs(quantity_diff_pct) <= 0.5, FALSE) AS quantity_ok, coalesce(abs(rows_diff_pct) <= 0.5, FALSE) AS rows_ok FROM d)
SELECT period, round(left_quantity, 4) AS left_quantity, round(right_quantity, 4) AS right_quantity, round(quantity_diff_pct, 4) AS quantity_diff_pct, quantity_ok,
       CAST(left_rows AS BIGINT) AS left_rows, CAST(right_rows AS BIGINT) AS right_rows, round(rows_diff_pct, 4) AS rows_diff_pct, rows_ok,
       quantity_ok AND rows_ok AS within_tolerance,
       (quantity_ok AND rows_ok) AND coalesce(lag(quantity_ok AND rows_ok) OVER (ORDER BY period), FALSE) AS clean_streak
FROM o"""


def _parity(spark, sf):
    li = D.load(spark, sf, "lineitem")
    return QY.measure_parity(li, D.lineitem_right(li), F.date_trunc("month", F.col("l_shipdate")).cast("timestamp_ntz"),
                             {"quantity": F.sum("l_quantity"), "rows": F.count(F.lit(1)).cast("bigint")},
                             tolerance_pct=0.5)


@query("measure_parity", ("Q14", "A23"), sql=_PARITY_SQL)
def measure_parity(spark, sf):
    p = _parity(spark, sf)
    return p.select("period", F.round("left_quantity", 4).alias("left_quantity"),
                    F.round("right_quantity", 4).alias("right_quantity"),
                    F.round("quantity_diff_pct", 4).alias("quantity_diff_pct"), "quantity_ok",
                    "left_rows", "right_rows", F.round("rows_diff_pct", 4).alias("rows_diff_pct"), "rows_ok",
                    "within_tolerance", "clean_streak")


@query("parity_verdict", ("Q16",),
       sql=f"""SELECT bool_and(within_tolerance) AS all_passed, CAST(count(*) AS BIGINT) AS checks,
                      CAST(count_if(NOT within_tolerance) AS BIGINT) AS failed,
                      '{{"tolerance_pct":0.5,"checks":[' || string_agg('{{"check":"' || strftime(period, '%Y-%m') || '","passed":'
                        || CASE WHEN within_tolerance THEN 'true' ELSE 'false' END || '}}', ',' ORDER BY period) || ']}}' AS details
               FROM ({_PARITY_SQL})""")
def parity_verdict(spark, sf):
    p = _parity(spark, sf).select(F.date_format("period", "yyyy-MM").alias("check"),
                                  F.col("within_tolerance").alias("passed"))
    return QY.verdict(p, tolerance_pct=0.5)


_RULES_SQL = [("positive_price", "o_totalprice > 0"), ("known_status", "o_orderstatus IN ('F', 'O', 'P')"),
              ("recent", "o_orderdate >= TIMESTAMP '1996-01-01'")]


def _rules():
    return {"positive_price": F.col("o_totalprice") > 0,
            "known_status": F.col("o_orderstatus").isin("F", "O", "P"),
            "recent": F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit("1996-01-01 00:00:00"))}


@query("expectation_counts", ("Q17",),
       sql=" UNION ALL ".join(f"SELECT '{n}' AS rule, CAST(count_if(NOT coalesce({e}, FALSE)) AS BIGINT) AS failed_rows, "
                              f"CAST(count(*) AS BIGINT) AS rows FROM ({S.ORDERS_RIGHT})" for n, e in _RULES_SQL))
def expectation_counts(spark, sf):
    return QY.expectation_counts(D.orders_right(D.load(spark, sf, "orders")), _rules())


@query("quarantine", ("Q18", "Q17"),
       sql=f"""SELECT o_orderkey, o_orderstatus, list_filter([{", ".join(f"CASE WHEN NOT coalesce({e}, FALSE) THEN '{n}' END" for n, e in _RULES_SQL)}],
                      lambda x: x IS NOT NULL) AS failed_rules
               FROM ({S.ORDERS_RIGHT}) WHERE NOT ({" AND ".join(f"coalesce({e}, FALSE)" for _, e in _RULES_SQL)})""")
def quarantine(spark, sf):
    _, bad = QY.quarantine(D.orders_right(D.load(spark, sf, "orders")), _rules())
    return bad.select("o_orderkey", "o_orderstatus", "failed_rules")


# ------------------------------------------------------------------ batch runner, views, metadata

from ..functions import normalize as N  # noqa: E402
from ..operators import load as L  # noqa: E402


def _retyped(o):
    """Orders' altered copy without a column and with another one as text."""
    return D.orders_right(o).drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("string"))


def _pairs(spark, sf):
    li, o, c, n = (D.load(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation"))
    return {"lineitem": (li, li.transform(D.lineitem_right)), "orders": (o, o.transform(_retyped)),
            "customer": (c, c.transform(D.customer_right)), "nation": (n, n),
            "dates": (o.select("o_orderkey", "o_orderdate"),
                      o.select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 10 MICROSECONDS")).alias("o_orderdate")))}


_ORDERS_SHIFTED = "SELECT o_orderkey, o_orderdate + INTERVAL 10 MICROSECONDS AS o_orderdate FROM orders"
_LINE_FAM = dict.fromkeys(S.LINEITEM_COLS, "numeric") | dict.fromkeys(("l_returnflag", "l_linestatus"), "string") | {
    "l_shipdate": "date"}
_BATCH = (  # pair, left, right, families of the columns that are compared, columns on one side, retyped columns
    ("lineitem", "SELECT * FROM lineitem", S.LINEITEM_RIGHT, _LINE_FAM, "", ""),
    ("orders", "SELECT * FROM orders", S.ORDERS_RIGHT,
     {"o_orderkey": "numeric", "o_orderstatus": "string", "o_totalprice": "numeric", "o_orderdate": "date"},
     "o_orderpriority", "o_custkey"),
    ("customer", "SELECT * FROM customer", S.CUSTOMER_RIGHT,
     {"c_custkey": "numeric", "c_name": "string", "c_nationkey": "numeric", "c_acctbal": "numeric", "c_mktsegment": "string"},
     "", ""),
    ("nation", "SELECT * FROM nation", "SELECT * FROM nation",
     {"n_nationkey": "numeric", "n_name": "string", "n_regionkey": "numeric"}, "", ""),
    ("dates", "SELECT o_orderkey, o_orderdate FROM orders", _ORDERS_SHIFTED, {"o_orderkey": "numeric", "o_orderdate": "date"},
     "", ""))
_BATCH_SQL = " UNION ALL ".join(f"""
  SELECT '{name}' AS pair_name, (SELECT count(*) FROM ({left})) AS l, (SELECT count(*) FROM ({right})) AS r,
         '{missing}' AS missing_columns, '{retyped}' AS type_mismatches, count(*) AS stats_compared,
         coalesce(string_agg(CASE WHEN NOT stats_match THEN column_name END, ',' ORDER BY column_name), '') AS stats_mismatches
  FROM ({stats_compare_sql(left, right, fam)})""" for name, left, right, fam, missing, retyped in _BATCH)


@query("batch_compare", ("Q13", "X3", "U5"),
       sql=f"""SELECT pair_name, l AS left_row_count, r AS right_row_count, l = r AS row_count_matches, missing_columns,
                      type_mismatches, missing_columns = '' AND type_mismatches = '' AS schema_matches, stats_compared,
                      stats_mismatches, CAST(NULL AS VARCHAR) AS error,
                      CASE WHEN l <> r THEN 'row_mismatch' WHEN missing_columns || type_mismatches <> '' THEN 'schema_mismatch'
                           WHEN stats_mismatches <> '' THEN 'stats_mismatch' ELSE 'match' END AS status
               FROM ({_BATCH_SQL})""")
def batch_compare(spark, sf):
    return C.compare_tables(_pairs(spark, sf))


@query("conditional_upsert", ("M5",),
       sql=f"""WITH t AS (SELECT * FROM orders), s AS ({S.ORDERS_SNAPSHOT2})
               SELECT CASE WHEN t.o_orderstatus <> s.o_orderstatus THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
                      CASE WHEN t.o_orderstatus <> s.o_orderstatus THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
                      CASE WHEN t.o_orderstatus <> s.o_orderstatus THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
                      CASE WHEN t.o_orderstatus <> s.o_orderstatus THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
                      CASE WHEN t.o_orderstatus <> s.o_orderstatus THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
                      CASE WHEN t.o_orderstatus <> s.o_orderstatus THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
               FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
               WHERE NOT (s.o_orderkey IS NOT NULL AND s.o_totalprice > 400000)
               UNION ALL
               SELECT s.* FROM s LEFT JOIN t ON t.o_orderkey = s.o_orderkey WHERE t.o_orderkey IS NULL AND s.o_orderpriority <> '5-LOW'""")
def conditional_upsert(spark, sf):
    o = D.load(spark, sf, "orders")
    s = D.orders_snapshot2(o)
    return L.conditional_upsert(o, s, ["o_orderkey"],
                                delete_when=F.col("s.o_totalprice") > 400000,
                                update_when=F.col("t.o_orderstatus") != F.col("s.o_orderstatus"),
                                insert_when=F.col("s.o_orderpriority") != "5-LOW")


@query("labelled_pairs", ("P9", "J4"),
       sql="""SELECT quality, toxic, CAST(count(*) AS BIGINT) AS docs FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
              WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY ALL""")
def labelled_pairs(spark, sf):
    d, lab = D.load(spark, sf, "documents").select("doc_id"), D.load(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left").dropna(subset=["quality", "toxic"])
    return j.groupBy("quality", "toxic").agg(F.count(F.lit(1)).cast("bigint").alias("docs"))


@query("role_playing_views", ("P12",),
       sql="""SELECT sn.n_name AS supplier_nation, cn.n_name AS customer_nation, CAST(count(*) AS BIGINT) AS lines
              FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN orders o ON l.l_orderkey = o.o_orderkey
              JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey
              JOIN nation cn ON c.c_nationkey = cn.n_nationkey GROUP BY ALL""")
def role_playing_views(spark, sf):
    """One nation dimension in two roles, exposed as contract views with only the referenced columns."""
    nat = D.load(spark, sf, "nation")
    nat.select(F.col("n_nationkey").alias("supplier_nationkey"), F.col("n_name").alias("supplier_nation")) \
        .createOrReplaceTempView("dim_supplier_nation")
    nat.select(F.col("n_nationkey").alias("customer_nationkey"), F.col("n_name").alias("customer_nation")) \
        .createOrReplaceTempView("dim_customer_nation")
    D.load(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").createOrReplaceTempView("fact_line")
    D.load(spark, sf, "supplier").select("s_suppkey", "s_nationkey").createOrReplaceTempView("dim_supplier")
    D.load(spark, sf, "orders").select("o_orderkey", "o_custkey").createOrReplaceTempView("fact_order")
    D.load(spark, sf, "customer").select("c_custkey", "c_nationkey").createOrReplaceTempView("dim_customer")
    return spark.sql("""
        SELECT sn.supplier_nation, cn.customer_nation, CAST(count(*) AS BIGINT) AS lines
        FROM fact_line l JOIN dim_supplier s ON l.l_suppkey = s.s_suppkey
        JOIN fact_order o ON l.l_orderkey = o.o_orderkey JOIN dim_customer c ON o.o_custkey = c.c_custkey
        JOIN dim_supplier_nation sn ON s.s_nationkey = sn.supplier_nationkey
        JOIN dim_customer_nation cn ON c.c_nationkey = cn.customer_nationkey
        GROUP BY sn.supplier_nation, cn.customer_nation""")


@query("shared_columns", ("J14", "P10"),
       sql=f"""SELECT a.table_name, a.column_name FROM information_schema.columns a
               WHERE a.table_name IN ({", ".join(f"'{t}'" for t in _ALL)})
                 AND EXISTS (SELECT 1 FROM information_schema.columns b WHERE b.table_name IN ({", ".join(f"'{t}'" for t in _ALL)})
                             AND b.column_name = a.column_name AND b.table_name <> a.table_name)""")
def shared_columns(spark, sf):
    cat = CT.column_catalogue(spark, {t: D.load(spark, sf, t) for t in _ALL}).select("table_name", "column_name")
    other = cat.select(F.col("table_name").alias("other_table"), F.col("column_name").alias("other_column"))
    return cat.join(other, (cat.column_name == other.other_column) & (cat.table_name != other.other_table), "left_semi")


@query("entity_metadata", ("S19", "F24"),
       sql=f"""SELECT table_name AS logical_name, CASE WHEN length(table_name) > 5 THEN upper(table_name) END AS display_name,
                      table_name || 's' AS entity_set_name, ends_with(table_name, 's') AS is_custom
               FROM (SELECT DISTINCT table_name FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{t}'" for t in _ALL)}))
               WHERE NOT starts_with(table_name, 'r')""")
def entity_metadata(spark, sf):
    """Entity metadata documents (nested, optional label) derived from the table catalogue, landed as JSON
    and flattened."""
    cat = CT.column_catalogue(spark, {t: D.load(spark, sf, t) for t in _ALL}).select("table_name").distinct()
    t = F.col("table_name")
    docs = cat.select(t.alias("LogicalName"),
                      F.when(F.length(t) > 5, F.struct(F.struct(F.upper(t).alias("Label")).alias("UserLocalizedLabel")))
                      .alias("DisplayName"),
                      F.when(~t.startswith("r"), F.concat(t, F.lit("s"))).alias("EntitySetName"),
                      t.endswith("s").alias("IsCustomEntity"))
    path = scratch_path(spark, "entity-metadata")
    docs.write.json(path)
    raw = spark.read.schema("LogicalName string, DisplayName struct<UserLocalizedLabel: struct<Label: string>>, "
                            "EntitySetName string, IsCustomEntity boolean").json(path)
    return CT.entity_metadata(raw)


@query("metric_layers", ("A23", "A20", "F12"),
       sql="""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 4) AS quantity, round(sum(l_extendedprice), 4) AS revenue,
                     CAST(count(*) AS BIGINT) AS lines, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS orders,
                     round(sum(l_extendedprice) / sum(l_quantity), 6) AS price_per_unit,
                     round(CAST(count(*) AS DOUBLE) / count(DISTINCT l_orderkey), 6) AS lines_per_order
              FROM lineitem GROUP BY ALL""")
def metric_layers(spark, sf):
    li = D.load(spark, sf, "lineitem")
    out = QY.metric_layers(li, ["l_returnflag", "l_linestatus"],
                           {"quantity": F.sum("l_quantity"), "revenue": F.sum("l_extendedprice"),
                            "lines": F.count(F.lit(1)).cast("bigint"), "orders": F.count_distinct("l_orderkey").cast("bigint")},
                           {"price_per_unit": ("revenue", "quantity"), "lines_per_order": ("lines", "orders")})
    return out.select("l_returnflag", "l_linestatus", F.round("quantity", 4).alias("quantity"),
                      F.round("revenue", 4).alias("revenue"), "lines", "orders",
                      F.round("price_per_unit", 6).alias("price_per_unit"),
                      F.round("lines_per_order", 6).alias("lines_per_order"))
