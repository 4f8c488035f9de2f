"""SQL twins of the derivations in :mod:`concord.plans.data` (DuckDB dialect)."""

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

LINEITEM_RIGHT = """
  SELECT * FROM lineitem WHERE l_orderkey % 97 <> 0
  UNION ALL
  SELECT * FROM lineitem WHERE l_orderkey % 97 <> 0 AND l_orderkey % 89 = 0
"""

ORDERS_RIGHT_ONE = """
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 7 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + CAST(1e-7 AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate + INTERVAL 1 SECOND ELSE o_orderdate END AS o_orderdate,
         CASE WHEN o_orderkey % 11 = 0 THEN o_orderpriority || ' ' ELSE o_orderpriority END AS o_orderpriority
  FROM orders
"""
ORDERS_RIGHT = f"""
  SELECT * FROM ({ORDERS_RIGHT_ONE})
  UNION ALL
  SELECT * FROM ({ORDERS_RIGHT_ONE}) WHERE o_orderkey % 19 = 0
"""

CUSTOMER_RIGHT_ONE = """
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_custkey % 31 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 23 <> 0
"""
CUSTOMER_RIGHT = f"""
  SELECT * FROM ({CUSTOMER_RIGHT_ONE})
  UNION ALL
  SELECT * FROM ({CUSTOMER_RIGHT_ONE}) WHERE c_custkey % 29 = 0
"""

_FEED_COLS = ", ".join(ORDERS_COLS)
_UPD1 = "SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 3 = 1"
_UPD2 = "SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 2 AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 3 = 1 AND o_orderkey % 7 = 0"


def _tag(src: str, change: str, version: int) -> str:
    return (f"SELECT {_FEED_COLS}, '{change}' AS _change_type, CAST({version} AS BIGINT) AS _commit_version, "
            f"TIMESTAMP '2024-01-01 00:00:00' + INTERVAL {version} DAY AS _commit_timestamp FROM ({src})")


ORDERS_FEED = "\n  UNION ALL\n".join([
    _tag("SELECT * FROM orders", "insert", 1),
    _tag("SELECT * FROM orders WHERE o_orderkey % 3 = 1", "delete", 2),
    _tag(_UPD1, "insert", 2),
    _tag("SELECT * FROM orders WHERE o_orderkey % 3 = 2 AND o_orderkey % 5 = 0", "delete", 3),
    _tag(_UPD1 + " AND o_orderkey % 7 = 0", "delete", 3),
    _tag(_UPD2, "insert", 3),
])

ORDERS_SNAPSHOT2 = """
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 3 = 1 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderkey % 3 = 2 AND o_orderkey % 5 = 0)
  UNION ALL
  SELECT o_orderkey + 1000000000 AS o_orderkey, o_custkey, 'N' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 41 = 0
"""

ANONYMOUS = "SELECT * REPLACE (CASE WHEN user_id % 40 <> 0 THEN user_id END AS user_id) FROM events"
SENSOR = f"SELECT 'user_' || CAST(user_id AS VARCHAR) AS name, ts AS timestamp, value FROM ({ANONYMOUS})"


def match_metrics(counts_cte: str, group: str | None = None) -> str:
    """Metric SELECT over a CTE with l_cnt, r_cnt (and optionally a group column)."""
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"""
  SELECT {g}left_rows, right_rows, matched_rows, only_left_rows, only_right_rows,
         round(CASE WHEN left_rows = 0 THEN 100.0 ELSE CAST(matched_rows AS DOUBLE) * 100.0 / CAST(left_rows AS DOUBLE) END, 6) AS pct_of_left,
         round(CASE WHEN right_rows = 0 THEN 100.0 ELSE CAST(matched_rows AS DOUBLE) * 100.0 / CAST(right_rows AS DOUBLE) END, 6) AS pct_of_right,
         round(CASE WHEN greatest(left_rows, right_rows) = 0 THEN 100.0
                    ELSE CAST(matched_rows AS DOUBLE) * 100.0 / CAST(greatest(left_rows, right_rows) AS DOUBLE) END, 6) AS pct_overall,
         (only_left_rows = 0 AND only_right_rows = 0) AS exact_match
  FROM (
    SELECT {g}CAST(coalesce(sum(l_cnt), 0) AS BIGINT) AS left_rows, CAST(coalesce(sum(r_cnt), 0) AS BIGINT) AS right_rows,
           CAST(coalesce(sum(least(l_cnt, r_cnt)), 0) AS BIGINT) AS matched_rows,
           CAST(coalesce(sum(greatest(l_cnt - r_cnt, 0)), 0) AS BIGINT) AS only_left_rows,
           CAST(coalesce(sum(greatest(r_cnt - l_cnt, 0)), 0) AS BIGINT) AS only_right_rows
    FROM {counts_cte}{gb}
  )
"""


def multiset_counts(left_sql: str, right_sql: str, cols: list[str]) -> str:
    c = ", ".join(cols)
    return f"""(SELECT {c}, sum(_l) AS l_cnt, sum(_r) AS r_cnt FROM (
      SELECT {c}, 1 AS _l, 0 AS _r FROM ({left_sql})
      UNION ALL
      SELECT {c}, 0 AS _l, 1 AS _r FROM ({right_sql})) GROUP BY {c})"""

ORDERS_LEGACY = """
  SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN 'N' ELSE 'Y' END AS current_flag,
            CASE WHEN o_orderkey % 15 = 0 THEN 'Y' ELSE 'N' END AS deleted_flag
  FROM orders WHERE year(o_orderdate) >= 1996
"""
ORDERS_LEGACY_CURRENT = f"SELECT * FROM ({ORDERS_LEGACY}) WHERE current_flag = 'Y' AND deleted_flag = 'N'"

ORDERS_SNAPSHOT2_MOD = f"""
  SELECT *, CASE WHEN o_orderkey % 3 = 1 OR o_orderkey >= 1000000000 THEN TIMESTAMP '2024-01-02 00:00:00'
                 ELSE o_orderdate END AS o_modified
  FROM ({ORDERS_SNAPSHOT2})
"""
PART_DIM = "SELECT * FROM part WHERE p_partkey % 7 <> 0"
