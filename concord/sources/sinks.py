"""Writers: CSV / Parquet sinks, partitioned facts, versioned outputs and the run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import latest_per_key
from .readers import CSV_FORMAT


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, written in parallel (one file per partition); :func:`.readers.read_csv` gives every value
    back, NULL and the empty string, line ends and outer blanks included."""
    marked = lambda c: F.when(c.startswith("\\"), F.concat(F.lit("\\"), c)).otherwise(c)
    out = df.select(*[marked(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                      else F.col(f"`{f.name}`") for f in df.schema.fields])
    out.write.mode(mode).options(**CSV_FORMAT).option("emptyValue", '""').option("header", True).csv(path)


def write_partitioned_fact(df: DataFrame, path: str, date_col: str, extra_keys: Sequence[str] = (),
                           mode: str = "overwrite") -> None:
    """Fact written partitioned by event month (and optionally a source key); dynamic partition
    overwrite replaces only the months present in ``df``.  Rows are rebalanced by the partition columns
    first, so each task writes few files and adaptive execution splits a month that holds much of the fact."""
    out = df.withColumn("event_month", F.date_format(F.col(date_col), "yyyy-MM"))
    keys = [*extra_keys, "event_month"]
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        out.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def write_outputs(outputs: Mapping[str, DataFrame], root: str, mode: str = "append") -> dict[str, str]:
    """Write several outputs together (e.g. long, wide, name map); ``append`` = modify,
    ``overwrite`` = replace.  Returns the paths."""
    paths = {}
    for name, df in outputs.items():
        p = f"{root.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(p)
        paths[name] = p
    return paths


def run_log_entries(runs: DataFrame, started: str = "started_at", finished: str = "finished_at") -> DataFrame:
    """S22 writer side: a 'Started' entry and a finish entry per run (append-only, no updates)."""
    start = runs.select("flow", "run_id", F.lit("Started").alias("status"), F.col(started).alias("started_at"),
                        F.lit(None).cast("timestamp_ntz").alias("finished_at"), F.lit(None).cast("string").alias("message"),
                        F.lit(None).cast("bigint").alias("row_count"), F.col(started).alias("logged_at"))
    end = runs.where(F.col(finished).isNotNull()).select(
        "flow", "run_id", F.col("status"), F.col(started).alias("started_at"), F.col(finished).alias("finished_at"),
        F.col("message"), F.col("row_count").cast("bigint"), F.col(finished).alias("logged_at"))
    return start.unionByName(end)


def run_log_current(log: DataFrame) -> DataFrame:
    """S22 reader side: latest entry per (flow, run_id) = the 'update' of the original design."""
    rank = F.when(F.col("status") == "Started", 0).otherwise(1)
    return latest_per_key(log, ["flow", "run_id"], [F.col("logged_at"), rank])
