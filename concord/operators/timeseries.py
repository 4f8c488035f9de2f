"""Sensor time-series shaping.

Long form (name, timestamp, value) -> value counts per (name, grain) -> exact median from cumulative counts -> one row per
step from a name's first reading to the last of all, forward filled -> wide pivot and name map.

* Readings are counted per (name, grain, value) and never collected: a grain's state is its sorted *runs* of (value, n).
  Runs of two outputs merge by adding the counts of equal values, so an incremental run needs no reading of the old one.
* The grid is not joined to the states and filled: each state is carried forward to the next state of its name (one ordered
  scan over the states, see :mod:`.ordered`) and then unfolded to its steps, a day or so of steps at a time.  Grid, join and
  fill are one step, windows run over the states alone, and a NULL name is a name like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import ordered as O


# ------------------------------------------------------------------ F2 names

#: Fixed value: a run of characters that a cleaned name does not hold (or of marks) becomes one mark.
NAME_PATTERN = "([^a-zA-Z0-9_]|_)+"


def clean_name(c: Column, strip_edges: bool = False) -> Column:
    """Each run of other characters and marks becomes one mark (N12: edge marks stay unless asked)."""
    one = F.regexp_replace(c, NAME_PATTERN, "_")
    return F.trim(F.lit("_"), one) if strip_edges else one


def add_cleaned_name(df: DataFrame, strip_edges: bool = False) -> DataFrame:
    return df.withColumn("name_cleaned", clean_name(F.col("name"), strip_edges))


# ------------------------------------------------------------------ V1 / A16 / A17

def truncate(c: Column, grain: str, ntz: bool = True) -> Column:
    """``date_trunc`` keeping a wall-clock (timestamp_ntz) column wall-clock."""
    t = F.date_trunc(grain, c)
    return t.cast("timestamp_ntz") if ntz else t


def _is_ntz(df: DataFrame, col: str) -> bool:
    from pyspark.sql import types as T
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


RUNS = "array<struct<value:double,n:bigint>>"


def median_of_runs(runs: Column) -> Column:
    """Exact median of sorted (value, n) runs: the mean of the values at both middle ranks; NULL without values.

    Two walks over the runs: one adds them up, one picks the first run whose cumulative count reaches each middle rank
    (from 1).  The total is bound to a name, so that it is not added up again at every step of the second walk.
    """
    total = F.aggregate(runs, F.lit(0).cast("bigint"), lambda acc, r: acc + r["n"])

    def middle(n: Column) -> Column:
        low, high = F.floor((n + 1) / 2), F.floor(n / 2) + 1
        none = F.lit(None).cast("double")
        start = F.struct(F.lit(0).cast("bigint").alias("upto"), none.alias("a"), none.alias("b"))

        def step(acc: Column, r: Column) -> Column:
            holds = lambda rank: (acc["upto"] < rank) & (acc["upto"] + r["n"] >= rank)
            return F.struct((acc["upto"] + r["n"]).alias("upto"), F.when(holds(low), r["value"]).otherwise(acc["a"]).alias("a"),
                            F.when(holds(high), r["value"]).otherwise(acc["b"]).alias("b"))

        return F.aggregate(runs, start, step, lambda acc: F.when(low == high, acc["a"]).otherwise((acc["a"] + acc["b"]) / 2.0))

    return F.transform(F.array(total), middle)[0]


def values_of_runs(runs: Column) -> Column:
    """The readings of sorted runs, one by one."""
    return F.flatten(F.transform(runs, lambda r: F.array_repeat(r["value"], r["n"].cast("int"))))


def value_counts(stream: DataFrame, grain: str = "second") -> DataFrame:
    """(name, timestamp, value, n): how often a name had a value in a grain; a NULL value is counted too."""
    return (stream.select("name", truncate(F.col("timestamp"), grain, _is_ntz(stream, "timestamp")).alias("timestamp"),
                          F.col("value").cast("double").alias("value"))
            .groupBy("name", "timestamp", "value").agg(F.count(F.lit(1)).alias("n")))


def runs_of(counts: DataFrame) -> DataFrame:
    """V1: (name, timestamp, runs, median) of value counts; a grain whose values are all NULL has no runs."""
    g = counts.groupBy("name", "timestamp").agg(F.sort_array(F.collect_list(
        F.when(F.col("value").isNotNull(), F.struct("value", "n")))).cast(RUNS).alias("runs"))
    return g.withColumn("median", median_of_runs(F.col("runs")))


def grain_medians(stream: DataFrame, grain: str = "second") -> DataFrame:
    """V1 without runs: (name, timestamp, n_values, median) per grain.

    For grains with millions of different values no group is gathered at all: the counts are put in order of
    (name, grain, value) and the middle ranks are found from their running sums, so one grain may span many partitions.
    """
    key = ["name", "timestamp"]
    counts = value_counts(stream, grain)
    rows = O.in_order(counts.filter("value is not null"), key, ["value"], "grain-values")
    upto = O.scan(rows, key, upto=O.running_sum(F.col("n")))
    totals = counts.groupBy(*key).agg(F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))),
                                                 F.lit(0)).alias("n_values"))
    same = F.col("name").eqNullSafe(F.col("_n")) & F.col("timestamp").eqNullSafe(F.col("_t"))
    ranked = upto.join(totals.select(F.col("name").alias("_n"), F.col("timestamp").alias("_t"), "n_values"), same)
    low, high = F.floor((F.col("n_values") + 1) / 2), F.floor(F.col("n_values") / 2) + 1
    holds = lambda rank: (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
    middle = (ranked.where(holds(low) | holds(high)).groupBy(F.col("_n"), F.col("_t"))
              .agg(F.max(F.when(holds(low), F.col("value"))).alias("a"), F.max(F.when(holds(high), F.col("value"))).alias("b")))
    return totals.join(middle, same, "left").select(
        *key, "n_values", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((F.col("a") + F.col("b")) / 2.0).alias("median"))


# ------------------------------------------------------------------ V2 / V3 / V5 steps, filled

def unfold(states: DataFrame, end: Column, step: str = "1 hour", chunk: str = "1 day", cols: Sequence[str] = (),
           emit: str | None = None) -> DataFrame:
    """V2, V3 (J9, J10, F20, W4): a row per step from each state (name, timestamp, ``cols``, median) to the next state of
    its name, or to ``end`` after the last one.  The state's own row has ``forward_filled`` 0, those after it repeat it
    with 1; a NULL median is the one before it.  States where ``emit`` is false give only the rows after them.

    States of one name must be different whole steps apart.  A state is unfolded to chunks first, which are spread over
    the cluster, and then each chunk to its steps, so that a name that falls silent for years is no single task's work.
    """
    st, ck = F.expr(f"INTERVAL {step}"), F.expr(f"INTERVAL {chunk}")
    extra = [emit] if emit else []
    rows = O.in_order(states.select("name", "timestamp", *cols, "median", *extra), ["name"], ["timestamp"], "sensor-states")
    s = O.scan(rows, ["name"], _next=O.lead(F.col("timestamp")), _median=O.carried(F.col("median")))
    last = F.coalesce(F.col("_next") - st, end)
    s = s.withColumn("_last", last).where(F.col("timestamp") <= F.col("_last"))
    chunks = s.withColumn("_chunk", F.explode(F.sequence(F.col("timestamp"), F.col("_last"), ck)))
    n = int(states.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(n, "name", "_chunk")
    upto = F.least(F.col("_chunk") + ck - st, F.col("_last"))
    out = chunks.withColumn("_step", F.explode(F.sequence(F.col("_chunk"), upto, st)))
    own = F.col("_step") == F.col("timestamp")
    if emit:
        out = out.where(~own | F.col(emit))
    return out.select("name", F.col("_step").alias("timestamp"), F.when(own, 0).otherwise(1).alias("forward_filled"),
                      *cols, F.col("_median").alias("median"))


def sensor_long(stream: DataFrame, grain: str = "second", step: str = "1 second", chunk: str = "1 hour",
                strip_edges: bool = False, keep: str = "values") -> DataFrame:
    """V5 full run -> (name, timestamp, forward_filled, values, median, name_cleaned).

    A name's rows run from its own first reading to the last reading of all.  ``keep`` says what stands for a grain's
    readings: "values" (the sorted readings), "runs" (sorted (value, n), which :func:`sensor_incremental` merges) or
    "count" (``n_values`` alone, for grains with too many different values to gather).
    """
    if keep not in ("values", "runs", "count"):
        raise ValueError(f"unknown keep: {keep!r}")
    states = grain_medians(stream, grain) if keep == "count" else runs_of(value_counts(stream, grain))
    end = truncate(stream.select(F.max("timestamp")).scalar(), grain, _is_ntz(stream, "timestamp"))
    column = "n_values" if keep == "count" else "runs"
    return finished(unfold(states, end, step, chunk, [column]), keep, strip_edges)


def finished(long: DataFrame, keep: str, strip_edges: bool = False) -> DataFrame:
    column = {"values": values_of_runs(F.col("runs")).alias("values") if keep == "values" else None,
              "runs": F.col("runs") if keep == "runs" else None,
              "count": F.col("n_values") if keep == "count" else None}[keep]
    return add_cleaned_name(long.select("name", "timestamp", "forward_filled", column, "median"), strip_edges)


# ------------------------------------------------------------------ V4 wide + map

def sensor_wide(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per timestamp, one column per cleaned name (max on collisions, N12).

    ``names`` are the expected columns (a fixed, bounded set: for unbounded tags keep the long form).  A name
    outside them raises when the query runs; it does not vanish.
    """
    unknown = F.raise_error(F.concat(F.lit("unexpected sensor name: "), F.coalesce("name_cleaned", F.lit("NULL"))))
    known = F.when(F.col("name_cleaned").isin(*names), F.col("name_cleaned")).otherwise(unknown.cast("string"))
    return (long.select("timestamp", known.alias("name_cleaned"), "median")
            .groupBy("timestamp").pivot("name_cleaned", list(names)).agg(F.max("median")))


def name_map(names: DataFrame, strip_edges: bool = False) -> DataFrame:
    """V4: distinct (name, name_cleaned) of a stream or an output (a scan, no grid)."""
    return add_cleaned_name(names.select("name").distinct(), strip_edges)


# ------------------------------------------------------------------ M15 incremental

def sensor_incremental(prev_long: DataFrame, added: DataFrame, grain: str = "second", step: str = "1 second",
                       chunk: str = "1 hour", strip_edges: bool = False, keep: str = "values") -> DataFrame:
    """New long output equal to a full run over old + added input.

    ``prev_long`` is the stored previous output with ``keep="runs"``; the added value counts are stored in the shared
    folder, as they are read several times.

    A name's rows before its first added reading are kept (all of them, without added readings).  After them the states
    of the old output (its rows that were not filled, J7) and the added counts are merged: the counts of equal values
    of a (name, grain) are added up.  They are unfolded together with the name's last kept row (J8), which carries the
    fill in and gives no row itself.
    """
    spark = prev_long.sparkSession
    path = scratch_path(spark, "sensor-added")
    value_counts(added, grain).write.parquet(path)
    new = spark.read.parquet(path)
    end = F.greatest(prev_long.select(F.max("timestamp")).scalar(), new.select(F.max("timestamp")).scalar())
    region = new.groupBy(F.col("name").alias("_name")).agg(F.min("timestamp").alias("_from"))
    prev = prev_long.join(region, F.col("name").eqNullSafe(F.col("_name")), "left")
    later = F.coalesce(F.col("timestamp") >= F.col("_from"), F.lit(False))
    kept = prev.where(~later).select("name", "timestamp", "forward_filled", "runs", "median")
    old = prev.where(later & (F.col("forward_filled") == 0))
    # a grain without values is one NULL value, so that it stays a state
    no_value = F.array(F.struct(F.lit(None).cast("double").alias("value"), F.lit(1).cast("bigint").alias("n"))).cast(RUNS)
    old = old.select("name", "timestamp", F.inline(F.when(F.size("runs") > 0, F.col("runs")).otherwise(no_value)))
    merged = old.unionByName(new).groupBy("name", "timestamp", "value").agg(F.sum("n").alias("n"))
    states = runs_of(merged).withColumn("_emit", F.lit(True))
    seeds = (kept.groupBy("name").agg(F.max_by(F.struct("timestamp", "runs", "median"), "timestamp").alias("s"))
             .select("name", "s.*", F.lit(False).alias("_emit")))
    grown = unfold(states.unionByName(seeds), end, step, chunk, ["runs"], "_emit")
    return finished(kept.unionByName(grown), keep, strip_edges)
