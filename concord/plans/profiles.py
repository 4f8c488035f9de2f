"""Registered profile queries (A2-A4, A13, A14, Q3, Q11) over customer vs its altered copy."""

from __future__ import annotations

from ..operators import profile as P
from . import data as D
from . import sqlparts as S
from .registry import query, rounded

_FAM = {"c_custkey": "numeric", "c_name": "string", "c_nationkey": "numeric", "c_acctbal": "numeric",
        "c_mktsegment": "string"}
_ORDER_FAM = {"o_orderkey": "numeric", "o_custkey": "numeric", "o_orderstatus": "string", "o_totalprice": "numeric",
              "o_orderdate": "date", "o_orderpriority": "string"}
_STATS = ["nulls", "distinct_values", "num_min", "num_max", "num_avg", "date_min", "date_max", "len_min", "len_max"]


def _stats_sql(src: str, prefix: str, fam: dict[str, str]) -> str:
    parts = []
    for c, f in fam.items():
        num = (f"min(CAST({c} AS DOUBLE)), max(CAST({c} AS DOUBLE)), avg(CAST({c} AS DOUBLE))" if f == "numeric"
               else "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)")
        day = (f"strftime(min({c}), '%Y-%m-%d %H:%M:%S.%f'), strftime(max({c}), '%Y-%m-%d %H:%M:%S.%f')" if f == "date"
               else "CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)")
        ln = (f"CAST(min(length({c})) AS BIGINT), CAST(max(length({c})) AS BIGINT)" if f == "string"
              else "CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)")
        parts.append(f"SELECT '{c}' AS column_name, '{f}' AS type_family, CAST(count_if({c} IS NULL) AS BIGINT),"
                     f" CAST(count(DISTINCT {c}) AS BIGINT), {num}, {day}, {ln} FROM ({src})")
    cols = ", ".join(f"{k} AS {prefix}{k}" for k in _STATS)
    names = ", ".join(["column_name", "type_family", *_STATS])
    return f"SELECT column_name, type_family, {cols} FROM (SELECT * FROM (" + " UNION ALL ".join(parts) + f")) t({names})"


def stats_compare_sql(left: str, right: str, fam: dict[str, str]) -> str:
    l, r = _stats_sql(left, "left_", fam), _stats_sql(right, "right_", fam)
    cols = ", ".join([f"round(l.left_{k}, 6) AS left_{k}" if k.startswith("num") else f"l.left_{k}" for k in _STATS]
                     + [f"round(r.right_{k}, 6) AS right_{k}" if k.startswith("num") else f"r.right_{k}" for k in _STATS])
    same = " AND ".join(f"l.left_{k} IS NOT DISTINCT FROM r.right_{k}" for k in _STATS if k != "num_avg")
    avg = ("(l.left_num_avg IS NOT DISTINCT FROM r.right_num_avg OR coalesce(abs(l.left_num_avg - r.right_num_avg) <= "
           "1e-9 * greatest(abs(l.left_num_avg), abs(r.right_num_avg)), FALSE))")
    return (f"SELECT l.column_name, l.type_family, {cols}, ({same} AND {avg}) AS stats_match "
            f"FROM ({l}) l JOIN ({r}) r ON l.column_name = r.column_name")


@query("column_stats", ("Q3", "A2", "A3", "A4", "J4", "F6"), sql=f"""{stats_compare_sql("SELECT * FROM customer", S.CUSTOMER_RIGHT, _FAM)}
               UNION ALL {stats_compare_sql("SELECT * FROM orders", S.ORDERS_RIGHT, _ORDER_FAM)}""")
def column_stats(spark, sf):
    c, o = D.load(spark, sf, "customer"), D.load(spark, sf, "orders")
    both = P.column_stats_compare(c, D.customer_right(c)).unionByName(P.column_stats_compare(o, D.orders_right(o)))
    return rounded(both)


def _numeric_sql(src: str, side: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, min(v) AS {side}_min,
              max(CASE WHEN i = CAST(round(CAST(n - 1 AS DOUBLE) * 0.25) AS BIGINT) THEN v END) AS {side}_q1,
              median(v) AS {side}_median,
              max(CASE WHEN i = CAST(round(CAST(n - 1 AS DOUBLE) * 0.75) AS BIGINT) THEN v END) AS {side}_q3,
              max(v) AS {side}_max, avg(v) AS {side}_mean, stddev_samp(v) AS {side}_std,
              (SELECT CAST(count_if({c} IS NULL) AS BIGINT) FROM ({src})) AS {side}_null_count
            FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n
                  FROM (SELECT CAST({c} AS DOUBLE) AS v FROM ({src}) WHERE {c} IS NOT NULL))""")
    return " UNION ALL ".join(parts)


_NUM = ["c_acctbal", "c_nationkey"]
_STR = ["c_mktsegment", "c_name"]


def _round_cols(side, names):
    return ", ".join(f"round({side}.{side}_{n}, 6) AS {side}_{n}" if n not in ("null_count",) else f"{side}.{side}_{n}"
                     for n in names)


_NUM_NAMES = ["min", "q1", "median", "q3", "max", "mean", "std", "null_count"]
_NUM_SQL = (f"SELECT l.column_name, {_round_cols('l', _NUM_NAMES).replace('l.l_', 'l.left_').replace('AS l_', 'AS left_')}, "
            f"{_round_cols('r', _NUM_NAMES).replace('r.r_', 'r.right_').replace('AS r_', 'AS right_')} "
            f"FROM ({_numeric_sql('SELECT * FROM customer', 'left', _NUM)}) l "
            f"JOIN ({_numeric_sql(S.CUSTOMER_RIGHT, 'right', _NUM)}) r ON l.column_name = r.column_name")


@query("numeric_profile", ("A13", "Q11", "N7"), sql=_NUM_SQL)
def numeric_profile(spark, sf):
    c = D.load(spark, sf, "customer")
    return rounded(P.profile_compare(c, D.customer_right(c), "numeric", _NUM))


def _string_sql(src: str, side: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name,
              (SELECT min({c}) FROM ({src})) AS {side}_lex_min, (SELECT max({c}) FROM ({src})) AS {side}_lex_max,
              (SELECT CAST(count(DISTINCT {c}) AS BIGINT) FROM ({src})) AS {side}_n_unique,
              (SELECT CAST(count_if({c} IS NULL) AS BIGINT) FROM ({src})) AS {side}_null_count,
              CAST(min(v) AS BIGINT) AS {side}_len_min, CAST(max(v) AS BIGINT) AS {side}_len_max,
              (SELECT {c} FROM ({src}) WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1) AS {side}_mode,
              CAST(max(CASE WHEN i = CAST(round(CAST(n - 1 AS DOUBLE) * 0.25) AS BIGINT) THEN v END) AS BIGINT) AS {side}_len_q1,
              round(median(CAST(v AS DOUBLE)), 6) AS {side}_len_median,
              CAST(max(CASE WHEN i = CAST(round(CAST(n - 1 AS DOUBLE) * 0.75) AS BIGINT) THEN v END) AS BIGINT) AS {side}_len_q3
            FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n
                  FROM (SELECT length({c}) AS v FROM ({src}) WHERE {c} IS NOT NULL))""")
    return " UNION ALL ".join(parts)


_STR_SQL = (f"SELECT l.*, r.* EXCLUDE (column_name) FROM ({_string_sql('SELECT * FROM customer', 'left', _STR)}) l "
            f"JOIN ({_string_sql(S.CUSTOMER_RIGHT, 'right', _STR)}) r ON l.column_name = r.column_name")


@query("string_profile", ("A14", "Q11", "N8"), sql=_STR_SQL)
def string_profile(spark, sf):
    c = D.load(spark, sf, "customer")
    return rounded(P.profile_compare(c, D.customer_right(c), "string", _STR))
