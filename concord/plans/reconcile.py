"""Registered reconciliation queries (Q1-Q9, A1, A5-A9, U4) over lineitem / orders / customer."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import compare as C
from ..operators import fingerprints as FP
from ..session import scratch_path
from . import data as D
from . import sqlparts as S
from .registry import query, rounded

_LI = ", ".join(S.LINEITEM_COLS)
_OR = ", ".join(S.ORDERS_COLS)


@query("row_match", ("Q4", "Q5", "A5", "A6", "J2", "F22", "F10", "F12", "P3", "P4"),
       sql=f"WITH counts AS {S.multiset_counts('SELECT * FROM lineitem', S.LINEITEM_RIGHT, S.LINEITEM_COLS)}"
           + S.match_metrics("counts"))
def row_match(spark, sf):
    li = D.load(spark, sf, "lineitem")
    return rounded(C.row_match(li, D.lineitem_right(li)))


@query("row_match_exact", ("Q5", "A5", "A6", "N1"),
       sql=f"WITH counts AS {S.multiset_counts('SELECT * FROM orders', S.ORDERS_RIGHT, S.ORDERS_COLS)}"
           + S.match_metrics("counts"))
def row_match_exact(spark, sf):
    o = D.load(spark, sf, "orders")
    return rounded(C.row_match(o, D.orders_right(o), method="exact"))


def _scenario_sql() -> str:
    strs = {"o_orderstatus", "o_orderpriority"}
    flts = {"o_totalprice"}
    dts = {"o_orderdate"}

    def sel(fn, cols):
        return ", ".join(f"{fn(c)} AS {c}" for c in cols)
    allc = S.ORDERS_COLS
    parts = []

    def add(name, fn, cols=allc, right=S.ORDERS_RIGHT):
        s = sel(fn, cols)
        counts = S.multiset_counts(f"SELECT {s} FROM orders", f"SELECT {s} FROM ({right})", cols)
        parts.append(f"SELECT '{name}' AS scenario, * FROM ({S.match_metrics(counts)})")
    add("baseline", lambda c: c)
    add("trim_strings", lambda c: f"trim({c})" if c in strs else c)
    add("trim_upper_strings", lambda c: f"upper(trim({c}))" if c in strs else c)
    add("baseline_excluding_datetime_float", lambda c: c, [c for c in allc if c not in flts | dts])
    for d in (6, 3):
        add(f"round_float_{d}dp", lambda c, d=d: f"round({c}, {d})" if c in flts else c)
    add("right_deduped", lambda c: c, right=f"SELECT DISTINCT * FROM ({S.ORDERS_RIGHT})")
    return "\nUNION ALL\n".join(parts)


@query("row_match_scenarios", ("Q6", "F1", "F11", "P13", "W1"), sql=_scenario_sql())
def row_match_scenarios(spark, sf):
    o = D.load(spark, sf, "orders")
    return rounded(C.row_match_scenarios(o, D.orders_right(o)))


@query("row_match_set_ops", ("U4",),
       sql=f"""SELECT CAST((SELECT count(*) FROM (SELECT * FROM lineitem INTERSECT ALL SELECT * FROM ({S.LINEITEM_RIGHT}))) AS BIGINT) AS matched_rows,
                     CAST((SELECT count(*) FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM ({S.LINEITEM_RIGHT}))) AS BIGINT) AS only_left_rows,
                     CAST((SELECT count(*) FROM (SELECT * FROM ({S.LINEITEM_RIGHT}) EXCEPT ALL SELECT * FROM lineitem)) AS BIGINT) AS only_right_rows""")
def row_match_set_ops(spark, sf):
    li = D.load(spark, sf, "lineitem")
    return C.row_match_set_ops(li, D.lineitem_right(li), S.LINEITEM_COLS)


@query("row_counts", ("Q2", "A1", "F12"),
       sql=f"""SELECT l AS left_row_count, r AS right_row_count, r - l AS row_diff,
                      round(CASE WHEN l = 0 THEN 0.0 ELSE CAST(r - l AS DOUBLE) * 100.0 / CAST(l AS DOUBLE) END, 2) AS row_diff_pct,
                      (r = l) AS row_count_matches
               FROM (SELECT CAST((SELECT count(*) FROM lineitem) AS BIGINT) AS l,
                            CAST((SELECT count(*) FROM ({S.LINEITEM_RIGHT})) AS BIGINT) AS r)""")
def row_counts(spark, sf):
    li = D.load(spark, sf, "lineitem")
    return C.row_counts(li, D.lineitem_right(li))


def _dup_sql(name, src, cols):
    c = ", ".join(cols)
    return f"""SELECT '{name}' AS dataset, total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows,
                  round(CASE WHEN total_rows = 0 THEN 0.0 ELSE CAST(total_rows - distinct_rows AS DOUBLE) * 100.0 / CAST(total_rows AS DOUBLE) END, 6) AS duplicate_pct
           FROM (SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS distinct_rows
                 FROM (SELECT count(*) AS n FROM ({src}) GROUP BY {c}))"""


@query("duplicate_profile", ("Q7", "A7"),
       sql=_dup_sql("left", "SELECT * FROM orders", S.ORDERS_COLS) + "\nUNION ALL\n"
           + _dup_sql("right", S.ORDERS_RIGHT, S.ORDERS_COLS))
def duplicate_profile(spark, sf):
    o = D.load(spark, sf, "orders")
    return rounded(C.duplicate_profile(o, D.orders_right(o)))


@query("copies_histogram", ("A8",),
       sql=f"""SELECT 'right' AS dataset, CAST(copies AS BIGINT) AS copies, CAST(count(*) AS BIGINT) AS distinct_rows,
                      CAST(copies * count(*) AS BIGINT) AS rows
               FROM (SELECT count(*) AS copies FROM ({S.LINEITEM_RIGHT}) GROUP BY {_LI}) GROUP BY copies""")
def copies_histogram(spark, sf):
    li = D.load(spark, sf, "lineitem")
    return C.copies_histogram(D.lineitem_right(li), dataset="right")


_KEYSETS = [["l_orderkey", "l_linenumber"], ["l_orderkey"], ["l_partkey", "l_suppkey"]]


def _key_sql() -> str:
    parts = []
    for ks in _KEYSETS:
        k = ", ".join(ks)
        on = " AND ".join(f"a.{c} = b.{c}" for c in ks)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in ks)
        parts.append(f"""SELECT '{' + '.join(ks)}' AS key_name,
          CAST((SELECT count(*) FROM (SELECT DISTINCT {k} FROM lineitem)) AS BIGINT) AS left_distinct_keys,
          CAST((SELECT count(*) FROM (SELECT DISTINCT {k} FROM ({S.LINEITEM_RIGHT}))) AS BIGINT) AS right_distinct_keys,
          CAST((SELECT count(*) FROM (SELECT DISTINCT {k} FROM lineitem) a
                WHERE NOT EXISTS (SELECT 1 FROM ({S.LINEITEM_RIGHT}) b WHERE {on})) AS BIGINT) AS keys_only_in_left,
          CAST((SELECT count(*) FROM (SELECT DISTINCT {k} FROM ({S.LINEITEM_RIGHT})) a
                WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE {on})) AS BIGINT) AS keys_only_in_right,
          CAST(count_if(l_n > 1) AS BIGINT) AS keys_where_left_has_duplicates,
          CAST(count_if(r_n > 1) AS BIGINT) AS keys_where_right_has_duplicates,
          CAST(count_if(r_n > l_n) AS BIGINT) AS keys_where_right_has_more_rows,
          CAST(coalesce(sum(greatest(r_n - l_n, 0)), 0) AS BIGINT) AS extra_right_rows_by_key_multiplicity
        FROM (SELECT {k}, count(*) AS l_n FROM lineitem WHERE {nn} GROUP BY {k}) a
        JOIN (SELECT {k}, count(*) AS r_n FROM ({S.LINEITEM_RIGHT}) WHERE {nn} GROUP BY {k}) b ON {on}""")
    return "\nUNION ALL\n".join(parts)


@query("key_diagnostics", ("Q8", "Q9", "A9", "J6", "U3", "F13"), sql=_key_sql())
def key_diagnostics(spark, sf):
    li = D.load(spark, sf, "lineitem")
    return C.key_diagnostics(li, D.lineitem_right(li), _KEYSETS)


@query("key_uniqueness", ("P14", "A3"),
       sql="""SELECT column_name, rows, non_null, distinct_values, (distinct_values = rows AND non_null = rows) AS is_unique FROM (
                SELECT 'event_id' AS column_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(event_id) AS BIGINT) AS non_null,
                       CAST(count(DISTINCT event_id) AS BIGINT) AS distinct_values FROM events
                UNION ALL
                SELECT 'user_id', CAST(count(*) AS BIGINT), CAST(count(user_id) AS BIGINT), CAST(count(DISTINCT user_id) AS BIGINT) FROM events
                UNION ALL
                SELECT 'event_type', CAST(count(*) AS BIGINT), CAST(count(event_type) AS BIGINT), CAST(count(DISTINCT event_type) AS BIGINT) FROM events)""")
def key_uniqueness(spark, sf):
    ev = D.load(spark, sf, "events")
    return C.key_uniqueness(ev, C.candidate_keys(ev))


@query("copies_describe", ("A8",),
       sql=f"""SELECT 'right' AS dataset, CAST(count(*) AS BIGINT) AS count, round(avg(copies), 6) AS mean,
                      round(stddev_samp(copies), 6) AS std, CAST(min(copies) AS BIGINT) AS min, CAST(max(copies) AS BIGINT) AS max
               FROM (SELECT count(*) AS copies FROM ({S.LINEITEM_RIGHT}) GROUP BY {_LI})""")
def copies_describe(spark, sf):
    li = D.load(spark, sf, "lineitem")
    return rounded(C.copies_describe(C.copies_histogram(D.lineitem_right(li), dataset="right")))


_KEY_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]
_KEY_SETS = [s for n in (1, 2, 3) for s in combinations(_KEY_COLS, n)]


def _smaller(s: tuple[str, ...]) -> str:
    inside = [",".join(t) for n in range(1, len(s)) for t in combinations(s, n)]
    return ", ".join(f"'{t}'" for t in inside) or "''"


@query("composite_keys", ("P14", "A3"),
       sql="WITH k AS (" + " UNION ALL ".join(
           f"SELECT '{','.join(s)}' AS key_columns, CAST({len(s)} AS INTEGER) AS n_columns, [{_smaller(s)}] AS inside FROM lineitem "
           f"HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM lineitem WHERE {' AND '.join(c + ' IS NOT NULL' for c in s)}))"
           for s in _KEY_SETS) + ") SELECT key_columns, n_columns FROM k "
           "WHERE NOT EXISTS (SELECT 1 FROM k j WHERE list_contains(k.inside, j.key_columns))")
def composite_keys(spark, sf):
    """The smallest sets of lineitem columns that identify a line."""
    return C.composite_keys(D.load(spark, sf, "lineitem"), _KEY_COLS)


_NEARLY = """SELECT * FROM orders WHERE o_orderkey % 4999 <> 0
             UNION ALL SELECT * FROM orders WHERE o_orderkey % 7919 = 0"""


@query("row_match_stored", ("Q5", "A6", "A5"),
       sql=f"""WITH counts AS {S.multiset_counts('SELECT * FROM orders', _NEARLY, S.ORDERS_COLS)}
               SELECT left_rows, right_rows, matched_rows, only_left_rows, only_right_rows FROM ({S.match_metrics("counts")})""")
def row_match_stored(spark, sf):
    """Orders against a copy that differs in a few rows, by stored fingerprint trees."""
    o = D.load(spark, sf, "orders")
    k = F.col("o_orderkey")
    right = o.where(k % 4999 != 0).unionByName(o.where(k % 7919 == 0))
    roots = [scratch_path(spark, f"fingerprints-{side}") for side in ("left", "right")]
    for df, root in zip((o, right), roots):
        FP.store(df, sorted(o.columns), root, bits=6)
    return FP.match_stored(spark, *roots).drop("leaves_read")
