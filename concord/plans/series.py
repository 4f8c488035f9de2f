"""Registered time-series queries (V1-V5, M15, A16-A18, W4, J7-J10) over events as a sensor stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timeseries as TS
from ..session import scratch_path
from . import data as D
from . import sqlparts as S
from .registry import query, rounded

GRAIN, STEP, CHUNK = "hour", "1 hour", "1 day"

LONG_SQL = f"""
WITH s AS (SELECT name, date_trunc('hour', timestamp) AS timestamp,
                  list_sort(list(CAST(value AS DOUBLE)) FILTER (WHERE value IS NOT NULL)) AS values
           FROM ({S.SENSOR}) GROUP BY ALL),
m AS (SELECT name, timestamp, values,
             CASE WHEN len(values) = 0 THEN NULL
                  WHEN len(values) % 2 = 1 THEN values[len(values) // 2 + 1]
                  ELSE (values[len(values) // 2] + values[len(values) // 2 + 1]) / 2.0 END AS median FROM s),
g AS (SELECT name, unnest(generate_series(start, (SELECT max(timestamp) FROM s), INTERVAL 1 HOUR)) AS timestamp
      FROM (SELECT name, min(timestamp) AS start FROM s GROUP BY name)),
j AS (SELECT g.name, g.timestamp, m.values, m.median FROM g LEFT JOIN m ON g.name IS NOT DISTINCT FROM m.name AND g.timestamp = m.timestamp)
SELECT name, timestamp, CASE WHEN values IS NULL THEN 1 ELSE 0 END AS forward_filled,
       last_value(values IGNORE NULLS) OVER w AS values, round(last_value(median IGNORE NULLS) OVER w, 6) AS median,
       trim(regexp_replace(regexp_replace(name, '[^a-zA-Z0-9_]', '_', 'g'), '_+', '_', 'g')) AS name_cleaned
FROM j WINDOW w AS (PARTITION BY name ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""


def _long(spark, sf):
    return TS.sensor_long(D.sensor_stream(D.load(spark, sf, "events")), GRAIN, STEP, CHUNK)


@query("sensor_long", ("V1", "V2", "V3", "V5", "W4", "A16", "A17", "J9", "J10", "F2", "F20", "F21", "N9", "N10"),
       sql=LONG_SQL)
def sensor_long(spark, sf):
    return rounded(_long(spark, sf))


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
BY_TYPE_SQL = LONG_SQL.replace(f"({S.SENSOR})", "(SELECT event_type AS name, ts AS timestamp, value FROM events)")


@query("sensor_wide", ("V4", "A18", "N12"),
       sql="SELECT timestamp, " + ", ".join(f"max(CASE WHEN name_cleaned = '{t}' THEN median END) AS {t}" for t in EVENT_TYPES)
           + f" FROM ({BY_TYPE_SQL}) GROUP BY timestamp")
def sensor_wide(spark, sf):
    """The events' types as tags: a bounded set of names, each a column."""
    st = D.load(spark, sf, "events").select(F.col("event_type").alias("name"), F.col("ts").alias("timestamp"), "value")
    return rounded(TS.sensor_wide(TS.sensor_long(st, GRAIN, STEP, CHUNK), EVENT_TYPES))


@query("sensor_name_map", ("V4", "U3"),
       sql=f"SELECT DISTINCT name, name_cleaned FROM ({LONG_SQL})")
def sensor_name_map(spark, sf):
    return TS.name_map(D.sensor_stream(D.load(spark, sf, "events")))


def _added():
    return (F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-18 00:00:00"))) & (F.col("event_id") % 3 == 0)


@query("sensor_incremental", ("M15", "V5", "J7", "J8", "U1", "S12", "N11"), sql=LONG_SQL)
def sensor_incremental(spark, sf):
    """Previous output from the events outside ``_added()`` + the added events == full run over all events."""
    ev = D.load(spark, sf, "events")
    added = _added()
    # the previous output is a stored dataset, as in a real incremental run: written once, then read back
    path = scratch_path(spark, "sensor-long-previous")
    TS.sensor_long(D.sensor_stream(ev.where(~added)), GRAIN, STEP, CHUNK,
                   keep="runs").write.parquet(path)
    prev = spark.read.parquet(path)
    out = TS.sensor_incremental(prev, D.sensor_stream(ev.where(added)), GRAIN, STEP, CHUNK)
    return rounded(out)


MEDIANS_SQL = LONG_SQL.replace("last_value(values IGNORE NULLS) OVER w AS values",
                               "CAST(last_value(len(values) IGNORE NULLS) OVER w AS BIGINT) AS n_values")


@query("sensor_long_medians", ("V1", "V3", "A17", "W4"), sql=MEDIANS_SQL)
def sensor_long_medians(spark, sf):
    """The long output without value lists: exact medians from running value counts (no gathered group)."""
    return rounded(TS.sensor_long(D.sensor_stream(D.load(spark, sf, "events")), GRAIN, STEP, CHUNK, keep="count"))
