"""Registered smaller analyses: returns (V6, V7), usage (V11, A19, A22, Q20), event groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import returns as R
from . import data as D
from . import sqlparts as S
from .registry import query, rounded

DAILY_SQL = """SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS price
               FROM orders GROUP BY ALL"""


def _daily(spark, sf):
    return (D.load(spark, sf, "orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("date"))
            .agg(F.avg("o_totalprice").alias("price")))


@query("series_cagr", ("V6", "T2", "F14"),
       sql=f"""SELECT o_orderpriority, first_date, last_date, round(first_price, 6) AS first_price, round(last_price, 6) AS last_price,
                      round(years, 6) AS years, round(CASE WHEN years > 0 THEN pow(last_price / first_price, 1 / years) - 1 END, 6) AS cagr,
                      round(last_price / first_price - 1, 6) AS total_return
               FROM (SELECT o_orderpriority, min(date) AS first_date, max(date) AS last_date, arg_min(price, date) AS first_price,
                            arg_max(price, date) AS last_price, CAST(max(date) - min(date) AS DOUBLE) / 365.25 AS years
                     FROM ({DAILY_SQL}) GROUP BY 1)""")
def series_cagr(spark, sf):
    return rounded(R.series_cagr(_daily(spark, sf), ["o_orderpriority"]))


@query("lookback_returns", ("V7", "J12", "N21"),
       sql=f"""WITH d AS ({DAILY_SQL}),
                    e AS (SELECT o_orderpriority, max(date) AS end_date, arg_max(price, date) AS end_price FROM d GROUP BY 1),
                    t AS (SELECT e.*, y AS period_years, CAST(end_date - CAST(floor(y * 365.25) AS INTEGER) AS TIMESTAMP) AS target_date
                          FROM e, (SELECT unnest([1, 2, 3, 4, 5]) AS y)),
                    a AS (SELECT t.*, (SELECT max(date) FROM d WHERE d.o_orderpriority = t.o_orderpriority AND d.date <= t.target_date) AS start_date FROM t)
               SELECT a.o_orderpriority, CAST(period_years AS INTEGER) AS period_years, target_date, CAST(start_date AS TIMESTAMP) AS start_date,
                      round(d.price, 6) AS start_price, end_date, round(end_price, 6) AS end_price,
                      round(end_price / d.price - 1, 6) AS total_return,
                      round(CASE WHEN end_date - start_date > 0 THEN pow(end_price / d.price, 1 / (CAST(end_date - start_date AS DOUBLE) / 365.25)) - 1 END, 6) AS annualized_return
               FROM a JOIN d ON d.o_orderpriority = a.o_orderpriority AND d.date = a.start_date""")
def lookback_returns(spark, sf):
    out = R.lookback_returns(_daily(spark, sf), ["o_orderpriority"])
    return rounded(out.withColumn("start_date", F.col("start_date").cast("timestamp_ntz")))


# ------------------------------------------------------------------ events / usage

from ..operators import events as EV  # noqa: E402
from ..operators import usage as U  # noqa: E402


def _with_finish(ev):
    return ev.select("event_id", "user_id", "ts",
                     (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value"))).alias("finish"))


@query("event_groups", ("W5", "W6", "N19", "F16"),
       sql=f"""WITH e AS (SELECT event_id, user_id, ts, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS finish FROM ({S.ANONYMOUS})),
                   f AS (SELECT *, lead(ts) OVER w AS next_start, lag(finish, 2) OVER w AS lag2_finish FROM e
                         WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
              SELECT event_id, user_id, ts, finish, next_start, lag2_finish,
                     CAST(CASE WHEN next_start IS NOT NULL
                               AND 10 > (CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag2_finish)) AS BIGINT)) / 60.0
                          THEN 0 ELSE 1 END AS TINYINT) AS group_start
              FROM f""")
def event_groups(spark, sf):
    ev = _with_finish(D.anonymous(D.load(spark, sf, "events")))
    return EV.event_groups(ev, "user_id", "ts", "finish", tie_break=["event_id"])


@query("asof_purchases", ("J12",),
       sql=f"""WITH e AS ({S.ANONYMOUS}),
                    p AS (SELECT user_id, ts, max(value) AS last_value FROM e WHERE event_type = 'purchase' GROUP BY ALL)
               SELECT e.event_id, e.user_id, e.ts, p.ts AS asof_ts, p.last_value
               FROM e ASOF LEFT JOIN p ON coalesce(e.user_id, -1) = coalesce(p.user_id, -1) AND e.ts >= p.ts""")
def asof_purchases(spark, sf):
    """Each event with its user's latest purchase up to then (unknown users as one)."""
    from ..operators.fill import asof_join

    ev = D.anonymous(D.load(spark, sf, "events"))
    bought = ev.where(F.col("event_type") == "purchase").select("user_id", "ts", F.col("value").alias("last_value"))
    return asof_join(ev.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "ts", ["last_value"])


@query("usage_summary", ("V11", "A19", "F24"),
       sql="""SELECT CAST(user_id AS VARCHAR) AS user_id, coalesce(json_extract_string(props, '$.user'), 'Unknown') AS user_email,
                     CAST(count(*) AS BIGINT) AS total_activities, min(ts) AS first_access, max(ts) AS last_access
              FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY ALL""")
def usage_summary(spark, sf):
    ev = D.load(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), U.json_field(F.col("props"), "$.user").alias("user_email"),
        "ts", U.json_field(F.col("props"), "$.k", None).alias("dataset_name"), F.lit(None).alias("dataset_id"))
    f = U.usage_filter(ev, "dataset_id", "dataset_name", "none", mode="reference")
    return U.user_summary(f, ["user_id", "user_email"], "ts")


@query("dataset_usage", ("V11", "A19", "F24"),
       sql="""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(count(*) AS BIGINT) AS total_activities, min(ts) AS first_access,
                     max(ts) AS last_access
              FROM events WHERE json_extract_string(props, '$.k') = '42' GROUP BY ALL""")
def dataset_usage(spark, sf):
    """Who used one dataset, by its id alone."""
    ev = D.load(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), "ts", U.json_field(F.col("props"), "$.k", None).alias("dataset_id"),
        F.col("event_type").alias("dataset_name"))
    return U.user_summary(U.usage_filter(ev, "dataset_id", "dataset_name", "42"), ["user_id"], "ts")


@query("top_users", ("T4", "T1", "A19"),
       sql="""SELECT user_id, CAST(count(*) AS BIGINT) AS total_activities, min(ts) AS first_access, max(ts) AS last_access
              FROM events GROUP BY user_id ORDER BY total_activities DESC, user_id LIMIT 10""")
def top_users(spark, sf):
    return U.top_users(U.user_summary(D.load(spark, sf, "events"), ["user_id"], "ts"), 10)


@query("load_summary", ("A22",),
       sql="""SELECT round(sum(value), 4) AS total, round(avg(value), 6) AS mean, CAST(count(DISTINCT user_id) AS BIGINT) AS n_groups,
                     round(CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1e6, 6) AS range_seconds FROM events""")
def load_summary(spark, sf):
    s = U.load_summary(D.load(spark, sf, "events"), "value", "user_id", "ts")
    return s.select(F.round("total", 4).alias("total"), F.round("mean", 6).alias("mean"), "n_groups",
                    F.round("range_seconds", 6).alias("range_seconds"))


_ACCESS_SQL = """SELECT 'view_' || CAST(event_id AS VARCHAR) AS view_name,
                        CASE WHEN event_type = 'error' THEN 'error' ELSE 'accessible' END AS access_status,
                        CASE WHEN event_type <> 'error' THEN NULL
                             WHEN event_id % 3 = 0 THEN 'Invalid object name ''v_' || CAST(user_id AS VARCHAR) || ''''
                             WHEN event_id % 3 = 1 THEN 'The SELECT permission was denied on object v_' || CAST(user_id AS VARCHAR)
                             ELSE 'Login timeout expired' END AS error_message FROM events"""


def access_log(ev):
    k = F.col("event_id") % 3
    uid = F.col("user_id").cast("string")
    msg = (F.when(F.col("event_type") != "error", F.lit(None))
           .when(k == 0, F.concat(F.lit("Invalid object name 'v_"), uid, F.lit("'")))
           .when(k == 1, F.concat(F.lit("The SELECT permission was denied on object v_"), uid))
           .otherwise(F.lit("Login timeout expired")))
    return ev.select(F.concat(F.lit("view_"), F.col("event_id").cast("string")).alias("view_name"),
                     F.when(F.col("event_type") == "error", "error").otherwise("accessible").alias("access_status"),
                     msg.alias("error_message"))


@query("error_classes", ("Q20", "F4", "F9", "N18"),
       sql=f"""SELECT CASE WHEN access_status = 'accessible' THEN NULL
                           WHEN contains(error_message, 'Invalid object name') THEN 'Invalid object name'
                           WHEN contains(error_message, 'permission') THEN 'Permission Denied' ELSE 'Others' END AS error_type,
                      CAST(count(*) AS BIGINT) AS views FROM ({_ACCESS_SQL}) GROUP BY 1""")
def error_classes(spark, sf):
    return U.error_counts(U.classify_errors(access_log(D.load(spark, sf, "events")), "access_status", "error_message"))


# ------------------------------------------------------------------ scalar functions

from ..functions import scalars as SC  # noqa: E402

# Fixed values for the example: zone per customer-key class.
_ZONES = {"0": "Australia/Perth", "1": "Europe/Paris", "2": "America/New_York"}


@query("scalar_functions", ("F3", "F5", "F12", "F13", "F18", "F19", "F10", "F11", "F15", "N16"),
       sql="""SELECT o_orderkey,
                     TRY_CAST(nullif(regexp_extract(o_orderpriority, '(\\d+)', 1), '') AS BIGINT) AS sort_key,
                     concat_ws(' - ', upper(trim(o_orderstatus)), trim(o_orderpriority)) AS display,
                     CAST((o_orderdate AT TIME ZONE CASE CAST(o_custkey % 3 AS VARCHAR) WHEN '0' THEN 'Australia/Perth'
                          WHEN '1' THEN 'Europe/Paris' ELSE 'America/New_York' END) AT TIME ZONE 'UTC' AS TIMESTAMP) AS utc_time,
                     CAST(o_orderdate AS DATE) AS date_key, strftime(o_orderdate, '%H%M') AS time_key,
                     CAST(strptime(CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS VARCHAR), '%Y%m%d') AS DATE) AS from_int,
                     round(CASE WHEN o_custkey = 0 THEN NULL ELSE CAST(o_orderkey AS DOUBLE) * 100.0 / CAST(o_custkey AS DOUBLE) END, 3) AS key_ratio_pct,
                     least(o_totalprice, 100000.0) AS capped_price
              FROM orders""")
def scalar_functions(spark, sf):
    o = D.load(spark, sf, "orders")
    k = F.col("o_orderdate")
    ymd = F.year(k) * 10000 + F.month(k) * 100 + F.dayofmonth(k)
    return o.select("o_orderkey", SC.first_number(F.col("o_orderpriority")).alias("sort_key"),
                    SC.display_name(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("display"),
                    SC.local_to_utc(k, (F.col("o_custkey") % 3).cast("string"), _ZONES).alias("utc_time"),
                    SC.date_key(k).alias("date_key"), SC.time_key(k).alias("time_key"),
                    SC.int_to_date(ymd).alias("from_int"),
                    F.round(SC.safe_pct(F.col("o_orderkey"), F.col("o_custkey")), 3).alias("key_ratio_pct"),
                    F.least(F.col("o_totalprice"), F.lit(100000.0)).alias("capped_price"))


@query("event_rollup", ("A20", "W6", "W5"),
       sql=f"""WITH e AS (SELECT event_id, user_id, ts, value, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS finish FROM ({S.ANONYMOUS})),
                   f AS (SELECT *, lead(ts) OVER w AS next_start, lag(finish, 2) OVER w AS lag2_finish FROM e
                         WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
                   g AS (SELECT *, CASE WHEN next_start IS NOT NULL
                               AND 10 > (CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag2_finish)) AS BIGINT)) / 60.0
                          THEN 0 ELSE 1 END AS gs FROM f),
                   h AS (SELECT *, sum(gs) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_group FROM g)
              SELECT user_id, CAST(event_group AS BIGINT) AS event_group, min(ts) AS group_start_time, max(finish) AS group_finish_time,
                     CAST(count(*) AS BIGINT) AS events, round(sum(value), 6) AS sum_value
              FROM h GROUP BY user_id, event_group""")
def event_rollup(spark, sf):
    ev = D.anonymous(D.load(spark, sf, "events"))
    ev = ev.select("event_id", "user_id", "ts", "value",
                   (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value"))).alias("finish"))
    flagged = EV.event_groups(ev, "user_id", "ts", "finish", tie_break=["event_id"])
    return rounded(EV.event_rollup(flagged, "user_id", "ts", "finish", ["value"], tie_break=["event_id"]))
