"""Column profiles: one-pass summary statistics (A2-A4), numeric and string profiles.

Scale notes.  The summary of all columns comes from one scan that counts each
column's distinct values; profiles take their scalar statistics from one ``agg``.  Exact quantiles and the mode are NOT computed with
``percentile``/``mode`` on a global group (their buffers would hold every
distinct value in one task): values are first counted per distinct value
(map-side combine collapses hot values), range-partitioned, checkpointed to the
shared checkpoint folder, and ranks are obtained from per-partition running
sums plus partition offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as TY
from ..session import ensure_checkpoint_dir

STAT_SCHEMA = ("column_name string, type_family string, nulls bigint, distinct_values bigint, "
               "num_min double, num_max double, num_avg double, date_min string, date_max string, "
               "len_min bigint, len_max bigint")
STAT_COLS = ["nulls", "distinct_values", "num_min", "num_max", "num_avg", "date_min", "date_max",
             "len_min", "len_max"]
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _kind(dt: T.DataType, family: str) -> str:
    """What stands for a value of the type in :func:`_value_counts`."""
    if family == "numeric" and isinstance(dt, _WHOLE):
        return "whole"
    if family == "numeric" and isinstance(dt, (T.FloatType, T.DoubleType)):
        return "num"
    if family == "date" and isinstance(dt, (T.DateType, T.TimestampNTZType)):
        return "day"
    return "hash"


def _value_counts(df: DataFrame, cols: Sequence[str], fam: dict) -> DataFrame:
    """(column number, value, occurrences) of all columns in one scan.  Numbers and times are grouped by themselves (8
    bytes to shuffle): ``h1`` holds a whole number, ``num`` a floating one, ``day`` a time.  Any other value is its 128-bit
    fingerprint, with what the statistics need of it: its number, time or length.  Equal values of a task are one row
    before the shuffle."""
    types = {f.name: f.dataType for f in df.schema.fields}
    kinds = [_kind(types[c], fam[c]) for c in cols]

    def entry(i: int, c: str) -> Column:
        x, f, kind = _c(c), fam[c], kinds[i]
        hashed, none = kind == "hash", F.lit(None)
        return F.struct(F.lit(i).alias("i"),
                        (x.cast("bigint") if kind == "whole" else F.xxhash64(F.lit(1), x) if hashed else none.cast("bigint")).alias("h1"),
                        (F.xxhash64(F.lit(2), x) if hashed else none.cast("bigint")).alias("h2"), x.isNull().alias("null"),
                        (x.cast("double") if f == "numeric" and kind != "whole" else none.cast("double")).alias("num"),
                        (x.cast("timestamp_ntz") if f == "date" else none.cast("timestamp_ntz")).alias("day"),
                        (F.char_length(x) if f == "string" else none.cast("int")).alias("len"))

    values = df.select(F.explode(F.array(*[entry(i, c) for i, c in enumerate(cols)])).alias("v")).select("v.*")
    counts = values.groupBy("i", "h1", "h2", "null", "num", "day").agg(F.count(F.lit(1)).alias("n"), F.min("len").alias("len"))
    whole = [i for i, kind in enumerate(kinds) if kind == "whole"]
    return counts.withColumn("num", F.when(F.col("i").isin(whole), F.col("h1").cast("double")).otherwise(F.col("num")))


def _column_profile(df: DataFrame, cols: Sequence[str], fam: dict) -> DataFrame:
    """column_name, type_family, rows and STAT_COLS of :func:`_value_counts`; a column of an empty table has zeros."""
    there, valued = F.col("n"), F.col("num").isNotNull()
    g = _value_counts(df, cols, fam).groupBy("i").agg(
        F.sum(there).alias("rows"), F.coalesce(F.sum(F.when(F.col("null"), there)), F.lit(0)).alias("nulls"),
        F.count_if(~F.col("null")).alias("distinct_values"), F.min("num").alias("num_min"), F.max("num").alias("num_max"),
        F.try_divide(F.sum(F.col("num") * there), F.sum(F.when(valued, there))).alias("num_avg"),
        F.date_format(F.min("day"), TS_FMT).alias("date_min"), F.date_format(F.max("day"), TS_FMT).alias("date_max"),
        F.min("len").cast("bigint").alias("len_min"), F.max("len").cast("bigint").alias("len_max"))
    names = df.sparkSession.createDataFrame([(i, c, fam[c]) for i, c in enumerate(cols)],
                                            "i int, column_name string, type_family string")
    zero = {k: F.coalesce(k, F.lit(0)).alias(k) for k in ("rows", "nulls", "distinct_values")}
    return names.join(g, "i", "left").select("column_name", "type_family",
                                             *[zero.get(k, F.col(k)) for k in ("rows", *STAT_COLS)])


def column_stats(df: DataFrame, cols: Sequence[str] | None = None, families: dict | None = None,
                 distinct: str = "exact") -> DataFrame:
    """Long-form per-column summary (A2, A3, A4).

    nulls and distinct for every column; numeric min/max/avg as double; date
    min/max (as text); string length min/max.  ``families`` may force a type
    family per column (e.g. the left system's types).

    The input is read once, whatever the number of columns: its distinct
    values are counted per column, and every statistic follows from these
    counts.  What is shuffled is one row per task, column and distinct value.
    ``distinct="approx"`` uses HyperLogLog++ in one plain aggregate instead
    and shuffles one row per task.
    """
    cols = list(cols or df.columns)
    fam = {f.name: TY.spark_family(f.dataType) for f in df.schema.fields}
    fam.update(families or {})
    if distinct != "approx":
        return _column_profile(df, cols, fam).drop("rows")
    aggs, rows = [], []
    null = F.lit(None)
    for i, c in enumerate(cols):
        x = _c(c)
        a = {"nulls": F.count_if(x.isNull()).cast("bigint"), "distinct_values": F.approx_count_distinct(x).cast("bigint"),
             "num_min": null.cast("double"), "num_max": null.cast("double"), "num_avg": null.cast("double"),
             "date_min": null.cast("string"), "date_max": null.cast("string"),
             "len_min": null.cast("bigint"), "len_max": null.cast("bigint")}
        f = fam[c]
        if f == "numeric":
            a.update(num_min=F.min(x.cast("double")), num_max=F.max(x.cast("double")), num_avg=F.avg(x.cast("double")))
        elif f == "date":
            a.update(date_min=F.date_format(F.min(x), TS_FMT), date_max=F.date_format(F.max(x), TS_FMT))
        elif f == "string":
            a.update(len_min=F.min(F.char_length(x)).cast("bigint"), len_max=F.max(F.char_length(x)).cast("bigint"))
        for k in STAT_COLS:
            aggs.append(a[k].alias(f"s{i}__{k}"))
        rows.append((c, f))
    wide = df.agg(*aggs)
    st = F.stack(F.lit(len(cols)), *[e for i, (c, f) in enumerate(rows)
                                     for e in [F.lit(c), F.lit(f)] + [F.col(f"s{i}__{k}") for k in STAT_COLS]])
    return wide.select(st.alias("column_name", "type_family", *STAT_COLS))


def column_stats_compare(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None,
                         distinct: str = "exact") -> DataFrame:
    """Q3: stats of every common column on both sides, joined on the column (J4), with per-stat equality.

    Averages count as equal within a relative 1e-9: the order of a distributed sum of doubles is not fixed.
    """
    cols = list(cols or sorted(set(left.columns) & set(right.columns)))
    fam = {f.name: TY.spark_family(f.dataType) for f in left.schema.fields}
    return _stats_side_by_side(column_stats(left, cols, fam, distinct), column_stats(right, cols, fam, distinct))


def _stats_side_by_side(l: DataFrame, r: DataFrame) -> DataFrame:
    also = [c for c in l.columns if c == "rows"]
    l = l.select("column_name", "type_family", *[F.col(k).alias(f"left_{k}") for k in [*also, *STAT_COLS]])
    r = r.select("column_name", *[F.col(k).alias(f"right_{k}") for k in [*also, *STAT_COLS]])
    same = None
    for k in STAT_COLS:
        a, b = F.col(f"left_{k}"), F.col(f"right_{k}")
        e = a.eqNullSafe(b)
        if k == "num_avg":
            e = e | F.coalesce(F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.abs(b)), F.lit(False))
        same = e if same is None else same & e
    return l.join(r, "column_name", "inner").withColumn("stats_match", same)


def table_comparison(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """:func:`column_stats_compare` with each side's rows, left_rows and right_rows: still one scan per side."""
    fam = {f.name: TY.spark_family(f.dataType) for f in left.schema.fields}
    return _stats_side_by_side(_column_profile(left, cols, fam), _column_profile(right, cols, fam))


# ------------------------------------------------------------------ exact ranks

def _ranked_value_counts(vc: DataFrame, partitions: int | None = None, group: Sequence[str] = ()) -> DataFrame:
    """(group..., v, c) distinct value counts -> adds cum_before, cum (running counts within the group) and
    n (the group's total).

    Range partitioning on (group, v) keeps every partition a contiguous range,
    so a group with a third of all values is spread over many partitions; the
    checkpoint (shared checkpoint folder, lineage cut) makes both uses of the
    partition ids consistent; per-(group, partition) totals give the offsets.
    """
    spark = vc.sparkSession
    ensure_checkpoint_dir(spark)
    group = list(group)
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rp = (vc.repartitionByRange(p, *group, "v").select(*group, "v", "c", F.spark_partition_id().alias("pid"))
          .checkpoint())
    part = rp.groupBy(*group, "pid").agg(F.sum("c").alias("pc"))
    wo = Window.partitionBy(*group).orderBy("pid") if group else Window.orderBy("pid")
    offs = part.select(*group, "pid",
                       F.coalesce(F.sum("pc").over(wo.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"),
                       F.sum("pc").over(wo.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
    # offs has one row per (group, partition it spans): with no group it is bounded by the partition count
    offs = F.broadcast(offs) if not group else offs
    w = Window.partitionBy(*group, "pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (rp.join(offs, [*group, "pid"])
            .select(*group, "v", "c", "n", (F.col("off") + F.sum("c").over(w)).alias("cum"))
            .withColumn("cum_before", F.col("cum") - F.col("c")))


def grouped_median(df: DataFrame, group: Sequence[str], value_col: str) -> DataFrame:
    """Exact (interpolated) median of ``value_col`` per group without collecting any group's values.

    Values are counted per (group, value) (map-side combine), ranked with
    :func:`_ranked_value_counts`, and the two middle ranks are picked by an
    aggregate.  Groups whose values are all NULL do not appear.
    """
    vc = (df.select(*group, F.col(value_col).alias("v")).where(F.col("v").isNotNull())
          .groupBy(*group, "v").agg(F.count(F.lit(1)).alias("c")))
    r = _ranked_value_counts(vc, group=group)
    nm1 = (F.col("n") - 1).cast("double")
    lo, hi = F.floor(nm1 / 2).cast("bigint"), F.ceil(nm1 / 2).cast("bigint")

    def at(k):
        return F.max(F.when((F.col("cum_before") <= k) & (k < F.col("cum")), F.col("v")))
    return r.groupBy(*group).agg(((at(lo).cast("double") + at(hi).cast("double")) / 2).alias("median"))


def grouped_quantiles(values: DataFrame, group: Sequence[str], qs: Sequence[float], col: str = "v") -> DataFrame:
    """Exact quantiles per group, "nearest" rule (N7), plus the interpolated median.

    Quantile q is the element at 0-based index round((n-1)*q) of the group's
    sorted non-null values; the median averages the two middle elements when
    n is even.  Output: group columns, q_<i> for each q, median.
    """
    group = list(group)
    vc = (values.select(*group, F.col(col).alias("v")).where(F.col("v").isNotNull())
          .groupBy(*group, "v").agg(F.count(F.lit(1)).alias("c")))
    r = _ranked_value_counts(vc, group=group)
    nm1 = (F.col("n") - 1).cast("double")

    def at(k: Column) -> Column:
        return F.max(F.when((F.col("cum_before") <= k) & (k < F.col("cum")), F.col("v")))
    aggs = [at(F.round(nm1 * F.lit(q)).cast("bigint")).alias(f"q_{i}") for i, q in enumerate(qs)]
    lo, hi = at(F.floor(nm1 / 2).cast("bigint")), at(F.ceil(nm1 / 2).cast("bigint"))
    aggs.append(((lo.cast("double") + hi.cast("double")) / 2).alias("median"))
    return r.groupBy(*group).agg(*aggs) if group else r.agg(*aggs)


def nearest_quantiles(values: DataFrame, qs: Sequence[float], col: str = "v") -> DataFrame:
    """Exact quantiles of a single column (one row: q_<i>, median); see :func:`grouped_quantiles`."""
    return grouped_quantiles(values, [], qs, col)


def _long_values(df: DataFrame, cols: Sequence[str], value: Callable[[Column], Column]) -> DataFrame:
    """(column_name, v) for every row and column: one scan feeds the per-column ranks of all columns."""
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), value(_c(c)).alias("v")) for c in cols])
    return df.select(F.explode(arr).alias("x")).select("x.column_name", "x.v")


def _stacked(df: DataFrame, cols: Sequence[str], stats: dict) -> DataFrame:
    """One aggregate over all columns, unfolded to one row per column."""
    aggs = [fn(_c(c)).alias(f"s{i}__{k}") for i, c in enumerate(cols) for k, fn in stats.items()]
    wide = df.agg(*aggs)
    st = F.stack(F.lit(len(cols)), *[e for i, c in enumerate(cols)
                                     for e in [F.lit(c)] + [F.col(f"s{i}__{k}") for k in stats]])
    return wide.select(st.alias("column_name", *stats))


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None, side: str | None = None) -> DataFrame:
    """A13 per numeric column: min, q1, median, q3, max, mean, std (sample), null_count.

    Three jobs whatever the number of columns: one aggregate for the moments,
    one ranked value-count pass (all columns at once, grouped by column) for
    the quantiles, and their join on the column name.
    """
    cols = list(cols or [f.name for f in df.schema.fields
                         if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.BooleanType)])
    base = _stacked(df, cols, {
        "min": lambda x: F.min(x.cast("double")), "max": lambda x: F.max(x.cast("double")),
        "mean": lambda x: F.avg(x.cast("double")), "std": lambda x: F.stddev_samp(x.cast("double")),
        "null_count": lambda x: F.count_if(x.isNull()).cast("bigint")})
    q = grouped_quantiles(_long_values(df, cols, lambda x: x.cast("double")), ["column_name"], (0.25, 0.75))
    out = base.join(q, "column_name", "left").select(
        "column_name", "min", F.col("q_0").alias("q1"), "median", F.col("q_1").alias("q3"), "max", "mean", "std",
        "null_count")
    return _side(out, side)


def string_profile(df: DataFrame, cols: Sequence[str] | None = None, side: str | None = None) -> DataFrame:
    """A14 per string column: lex_min, lex_max, mode (smallest of ties), n_unique, null_count,
    length min / q1 / median / q3 / max.

    Constant number of jobs in the number of columns: one aggregate (lexical
    bounds, nulls, length bounds), one count per (column, value) giving both
    n_unique and the mode, one ranked pass over (column, length).
    """
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    base = _stacked(df, cols, {
        "lex_min": lambda x: F.min(x.cast("string")), "lex_max": lambda x: F.max(x.cast("string")),
        "null_count": lambda x: F.count_if(x.isNull()).cast("bigint"),
        "len_min": lambda x: F.min(F.char_length(x.cast("string"))).cast("bigint"),
        "len_max": lambda x: F.max(F.char_length(x.cast("string"))).cast("bigint")})
    counts = (_long_values(df, cols, lambda x: x.cast("string")).where(F.col("v").isNotNull())
              .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n")))
    # mode: largest count, smallest value on ties
    modes = counts.groupBy("column_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_unique"),
        F.min_by("v", F.struct((-F.col("n")).alias("nn"), F.col("v").alias("vv"))).alias("mode"))
    q = grouped_quantiles(_long_values(df, cols, lambda x: F.char_length(x.cast("string"))), ["column_name"],
                          (0.25, 0.75))
    out = (base.join(modes, "column_name", "left").join(q, "column_name", "left")
           .select("column_name", "lex_min", "lex_max", "mode", F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
                   "null_count", "len_min", F.col("q_0").cast("bigint").alias("len_q1"),
                   F.col("median").alias("len_median"), F.col("q_1").cast("bigint").alias("len_q3"), "len_max"))
    return _side(out, side)


def _side(df: DataFrame, side: str | None) -> DataFrame:
    if not side:
        return df
    return df.select("column_name", *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c != "column_name"])


def profile_compare(left: DataFrame, right: DataFrame, kind: str = "numeric",
                    cols: Sequence[str] | None = None) -> DataFrame:
    """Q11: numeric or string profile of both sides joined on the column."""
    fn = numeric_profile if kind == "numeric" else string_profile
    return fn(left, cols, "left").join(fn(right, cols, "right"), "column_name", "inner")
