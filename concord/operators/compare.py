"""Two-table reconciliation: schema, counts, multiset row match, duplicates, keys.

Plan shape for the row-level operators: each side is scanned once, reduced to
a 128-bit NULL-masked fingerprint per row, the two sides are unioned with a
side tag and grouped once.  Partial (map-side) aggregation collapses repeated
rows before the shuffle, so a single row value that holds a third of the table
costs one record per map task, not one per copy.  Only metric rows come back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import combinations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize as N
from ..functions import types as TY


# ------------------------------------------------------------------ helpers

def pct(num: Column, den: Column, empty: float | None = 100.0) -> Column:
    """100*num/den as double; ``empty`` when den is 0."""
    v = F.try_divide(num.cast("double") * 100.0, den.cast("double"))
    return F.coalesce(v, F.lit(empty).cast("double")) if empty is not None else v


def _fingerprinted(df: DataFrame, cols: Sequence[str], side: int) -> DataFrame:
    h1, h2 = N.row_fingerprint(cols)
    return df.select(h1.alias("h1"), h2.alias("h2"),
                     F.lit(1 if side == 0 else 0).alias("_l"),
                     F.lit(1 if side == 1 else 0).alias("_r"))


def multiset_counts(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None,
                    method: str = "hash") -> DataFrame:
    """Per distinct row value: (l_cnt, r_cnt) (A5 + J2 in one shuffle).

    ``method="hash"`` groups by a 128-bit fingerprint; ``method="exact"``
    groups by the columns themselves (NULL equals NULL in grouping).
    """
    cols = list(cols if cols is not None else sorted(set(left.columns) & set(right.columns)))
    if method == "exact":
        keys = [F.col(f"`{c}`") for c in cols]
        tagged = (left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
                  .unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
        return tagged.groupBy(*keys).agg(F.sum("_l").alias("l_cnt"), F.sum("_r").alias("r_cnt"))
    tagged = _fingerprinted(left, cols, 0).unionByName(_fingerprinted(right, cols, 1))
    return tagged.groupBy("h1", "h2").agg(F.sum("_l").alias("l_cnt"), F.sum("_r").alias("r_cnt"))


def _match_metrics(counts: DataFrame, l: str = "l_cnt", r: str = "r_cnt",
                   group: Sequence[str] = ()) -> DataFrame:
    lc, rc = F.col(l), F.col(r)
    agg = [F.sum(lc).cast("bigint").alias("left_rows"),
           F.sum(rc).cast("bigint").alias("right_rows"),
           F.sum(F.least(lc, rc)).cast("bigint").alias("matched_rows"),
           F.sum(F.greatest(lc - rc, F.lit(0))).cast("bigint").alias("only_left_rows"),
           F.sum(F.greatest(rc - lc, F.lit(0))).cast("bigint").alias("only_right_rows")]
    out = counts.groupBy(*group).agg(*agg) if group else counts.agg(*agg)
    out = out.na.fill(0, ["left_rows", "right_rows", "matched_rows", "only_left_rows", "only_right_rows"])
    m, lr, rr = F.col("matched_rows"), F.col("left_rows"), F.col("right_rows")
    return out.select(
        *group, "left_rows", "right_rows", "matched_rows", "only_left_rows", "only_right_rows",
        pct(m, lr).alias("pct_of_left"),
        pct(m, rr).alias("pct_of_right"),
        pct(m, F.greatest(lr, rr)).alias("pct_overall"),
        ((F.col("only_left_rows") == 0) & (F.col("only_right_rows") == 0)).alias("exact_match"),
    )


# ------------------------------------------------------------ Q4/Q5 row match

def row_match(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None,
              normalise: bool = True, method: str = "hash") -> DataFrame:
    """Multiset row match of two tables over their common columns.

    One row: left_rows, right_rows, matched_rows (sum of min counts),
    only_left_rows, only_right_rows, pct_of_left / pct_of_right / pct_overall
    (100 when the base is 0) and exact_match (multiset equality, no sort).
    """
    cols = list(cols if cols is not None else sorted(set(left.columns) & set(right.columns)))
    l, r = left.select(*[F.col(f"`{c}`") for c in cols]), right.select(*[F.col(f"`{c}`") for c in cols])
    if normalise:
        l, r = N.normalise_types(l), N.normalise_types(r)
    return _match_metrics(multiset_counts(l, r, cols, method))


def row_match_set_ops(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Same totals through ``intersectAll`` / ``exceptAll`` (U4); a cross-check of A6."""
    l, r = left.select(*cols), right.select(*cols)
    parts = [(l.intersectAll(r), "matched_rows"), (l.exceptAll(r), "only_left_rows"),
             (r.exceptAll(l), "only_right_rows")]
    u = None
    for df, name in parts:
        t = df.select(F.lit(name).alias("metric"))
        u = t if u is None else u.unionByName(t)
    return u.agg(*[F.count_if(F.col("metric") == n).cast("bigint").alias(n) for _, n in parts])


# ------------------------------------------------------------ Q6 scenarios

DEFAULT_ROUNDINGS = (6, 3)


def row_match_scenarios(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None,
                        round_decimals: Sequence[int] = DEFAULT_ROUNDINGS) -> DataFrame:
    """Row match under several normalisations, each side scanned once (Q6).

    Scenarios: baseline, trim_strings, trim_upper_strings,
    baseline_excluding_datetime_float, right_deduped (exact duplicates on the
    right removed), round_float_<d>dp.

    Rows are grouped by their plain fingerprint first, with the fingerprints
    of the other scenarios beside it.  What both sides have of a plain row is
    matched in every scenario, so only the unmatched copies go on to be
    grouped by scenario; for two nearly equal tables that is next to nothing.
    """
    cols = list(cols if cols is not None else sorted(set(left.columns) & set(right.columns)))
    l = N.normalise_types(left.select(*[F.col(f"`{c}`") for c in cols]))
    r = N.normalise_types(right.select(*[F.col(f"`{c}`") for c in cols]))
    strs = set(N.string_columns(l))
    flts = set(N.float_columns(l))
    dts = set(N.datetime_columns(l))

    def variant(transform: Callable[[str], Column], use: Sequence[str]) -> Column:
        exprs = [transform(c).alias(c) for c in use]
        mask = F.concat(*[F.when(e.isNull(), F.lit("1")).otherwise(F.lit("0")) for e in exprs]) if exprs else F.lit("")
        return F.struct(F.xxhash64(*exprs, mask).alias("h1"),
                        F.xxhash64(F.lit("concord-fp2"), *exprs, mask).alias("h2"))

    def col(c):
        return F.col(f"`{c}`")
    scen = [("baseline", variant(col, cols)),
            ("trim_strings", variant(lambda c: F.trim(col(c)) if c in strs else col(c), cols)),
            ("trim_upper_strings", variant(lambda c: F.upper(F.trim(col(c))) if c in strs else col(c), cols))]
    keep = [c for c in cols if c not in flts and c not in dts]
    if keep:
        scen.append(("baseline_excluding_datetime_float", variant(col, keep)))
    for d in round_decimals:
        scen.append((f"round_float_{d}dp", variant(lambda c, d=d: F.round(col(c), d) if c in flts else col(c), cols)))

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        fps = [e[h].alias(f"{h}_{i}") for i, (_, e) in enumerate(scen) for h in ("h1", "h2")]
        return df.select(*fps, F.lit(1 if is_left else 0).alias("_l"), F.lit(0 if is_left else 1).alias("_r"))

    others = range(1, len(scen))
    plain = (side(l, True).unionByName(side(r, False)).groupBy("h1_0", "h2_0")
             .agg(*[F.first(f"{h}_{i}").alias(f"{h}_{i}") for i in others for h in ("h1", "h2")],  # the same for equal rows
                  F.sum("_l").alias("l"), F.sum("_r").alias("r")))
    dedup_id = len(scen)
    zero = F.lit(0).cast("bigint")

    def entry(scenario: int, h1: Column, h2: Column, lc: Column, rc: Column) -> Column:
        """Copies of a group; groups that cannot meet others share the fingerprints 0 (matched), 1 and 2 (one side)."""
        return F.struct(F.lit(scenario).cast("tinyint").alias("scenario"), h1.cast("bigint").alias("h1"),
                        h2.cast("bigint").alias("h2"), lc.alias("l_cnt"), rc.alias("r_cnt"))

    def settled(scenario: int, lc: Column, rc: Column) -> list[Column]:
        m = F.least(lc, rc)
        return [entry(scenario, zero, zero, m, m), F.when(lc > m, entry(scenario, zero + 1, zero, lc - m, zero)),
                F.when(rc > m, entry(scenario, zero + 2, zero, zero, rc - m))]

    lc, rc = F.col("l"), F.col("r")
    both = F.least(lc, rc)
    entries = [*settled(0, lc, rc), *settled(dedup_id, lc, F.least(rc, F.lit(1)))]
    for i in others:
        entries += [entry(i, zero, zero, both, both),
                    F.when(lc != rc, entry(i, F.col(f"h1_{i}"), F.col(f"h2_{i}"), lc - both, rc - both))]
    groups = (plain.select(F.explode(F.array_compact(F.array(*entries))).alias("g")).select("g.*")
              .groupBy("scenario", "h1", "h2").agg(F.sum("l_cnt").alias("l_cnt"), F.sum("r_cnt").alias("r_cnt")))
    names = F.create_map(*[x for i, (n, _) in enumerate(scen) for x in (F.lit(i).cast("tinyint"), F.lit(n))],
                         F.lit(dedup_id).cast("tinyint"), F.lit("right_deduped"))
    m = _match_metrics(groups, group=["scenario"])
    return m.withColumn("scenario", names[F.col("scenario")])


# ------------------------------------------------------------ Q21 remainders side by side

def remainder_cells(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """Q21: the first ``n`` rows (by value) that only one side has, cell by cell and both sides beside each other:
    (position, column_name, left_type, left_value, right_type, right_value), values as text."""
    cols = list(cols if cols is not None else sorted(set(left.columns) & set(right.columns)))

    def head(a: DataFrame, b: DataFrame, side: str) -> DataFrame:
        a, b = (d.select(*[F.col(f"`{c}`") for c in cols]) for d in (a, b))
        types = {f.name: f.dataType.simpleString() for f in a.schema.fields}
        top = a.exceptAll(b).orderBy(*[F.col(f"`{c}`") for c in cols]).limit(n)
        placed = top.withColumn("position", F.row_number().over(Window.orderBy(*[F.col(f"`{c}`") for c in cols])))  # n rows
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias(f"{side}_type"),
                                   F.col(f"`{c}`").cast("string").alias(f"{side}_value")) for c in cols])
        return placed.select("position", F.explode(cells).alias("x")).select("position", "x.*")

    return head(left, right, "left").join(head(right, left, "right"), ["position", "column_name"], "full")


# ------------------------------------------------------------ Q7/A7/A8 duplicates

def duplicate_profile(left: DataFrame, right: DataFrame | None = None,
                      cols: Sequence[str] | None = None, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Per side: total_rows, distinct_rows, duplicate_rows = total - distinct, duplicate_pct."""
    sides = [(names[0], left)] + ([(names[1], right)] if right is not None else [])
    cols = list(cols if cols is not None else (sorted(set(left.columns) & set(right.columns)) if right is not None
                                               else left.columns))
    parts = []
    for name, df in sides:
        h1, h2 = N.row_fingerprint(cols)
        parts.append(N.normalise_types(df.select(*[F.col(f"`{c}`") for c in cols]))
                     .select(F.lit(name).alias("dataset"), h1.alias("h1"), h2.alias("h2")))
    u = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    g = u.groupBy("dataset", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return (g.groupBy("dataset").agg(F.sum("n").cast("bigint").alias("total_rows"),
                                     F.count(F.lit(1)).cast("bigint").alias("distinct_rows"))
            .select("dataset", "total_rows", "distinct_rows",
                    (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
                    pct(F.col("total_rows") - F.col("distinct_rows"), F.col("total_rows"), 0.0).alias("duplicate_pct")))


def copies_histogram(df: DataFrame, cols: Sequence[str] | None = None, dataset: str = "left") -> DataFrame:
    """How many distinct rows occur 1x, 2x, 3x ... (A8): (dataset, copies, distinct_rows, rows)."""
    cols = list(cols or df.columns)
    h1, h2 = N.row_fingerprint(cols)
    g = (N.normalise_types(df.select(*[F.col(f"`{c}`") for c in cols]))
         .select(h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies")))
    return (g.groupBy("copies").agg(F.count(F.lit(1)).cast("bigint").alias("distinct_rows"))
            .select(F.lit(dataset).alias("dataset"), F.col("copies").cast("bigint").alias("copies"),
                    "distinct_rows", (F.col("copies") * F.col("distinct_rows")).cast("bigint").alias("rows")))


def copies_describe(hist: DataFrame) -> DataFrame:
    """describe() of the copies-per-distinct-row distribution from a histogram."""
    w = F.col("distinct_rows")
    n = F.sum(w)
    mean = F.sum(F.col("copies") * w) / n
    return (hist.groupBy("dataset").agg(
        n.cast("bigint").alias("count"), mean.alias("mean"),
        F.sqrt(F.try_divide(F.sum(w * F.col("copies") * F.col("copies")) - n * mean * mean, n - 1)).alias("std"),
        F.min("copies").alias("min"), F.max("copies").alias("max")))


# ------------------------------------------------------------ Q8/Q9 keys

#: Types of which the value itself, at most 8 bytes, is grouped by, which is less to shuffle than a fingerprint.
_SHORT = (T.LongType, T.DoubleType, T.DateType, T.TimestampNTZType)


def key_diagnostics(left: DataFrame, right: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Key overlap (Q8) and key multiplicity (Q9) for several candidate keys, with one shuffle of both sides each.

    Both sides are counted together, by a key's values where they are short and of one type on both sides, and by its
    128-bit fingerprint otherwise.  A key holding a NULL never matches (as in an anti join), but counts as one
    distinct key on its side.  Output per key set: key_name,
    left_distinct_keys, right_distinct_keys, keys_only_in_left,
    keys_only_in_right, keys_where_left_has_duplicates,
    keys_where_right_has_duplicates, keys_where_right_has_more_rows,
    extra_right_rows_by_key_multiplicity (the last four over keys present on
    both sides, as an inner join gives them).
    """
    usable = [list(k) for k in key_sets if set(k) <= set(left.columns) and set(k) <= set(right.columns)]
    if not usable:
        raise ValueError("no usable key set")
    return reduce(DataFrame.unionAll, [_key_overlap(left, right, ks) for ks in usable])


def _key_overlap(left: DataFrame, right: DataFrame, ks: Sequence[str]) -> DataFrame:
    """The row of one key set; none if both sides are empty."""
    l, r = (N.normalise_types(df.select(*[F.col(f"`{c}`") for c in ks])) for df in (left, right))
    plain = all(l.schema[c].dataType == r.schema[c].dataType and isinstance(l.schema[c].dataType, _SHORT) for c in ks)
    cols = [F.col(f"`{c}`") for c in ks]

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        mask = N.null_mask(ks)
        key = cols if plain else [F.xxhash64(*cols, mask), F.xxhash64(F.lit("concord-fp2"), *cols, mask), _any_null(cols)]
        return df.select(*[k.alias(f"k{i}") for i, k in enumerate(key)],
                         F.lit(1 if is_left else 0).alias("_l"), F.lit(0 if is_left else 1).alias("_r"))

    u = side(l, True).unionByName(side(r, False))
    keys = [c for c in u.columns if c not in ("_l", "_r")]
    g = u.groupBy(*keys).agg(F.sum("_l").alias("l_n"), F.sum("_r").alias("r_n"))
    has_null = _any_null([F.col(k) for k in keys]) if plain else F.col("k2")
    both = (F.col("l_n") > 0) & (F.col("r_n") > 0) & ~has_null
    return g.groupBy(F.lit(" + ".join(ks)).alias("key_name")).agg(
        F.count_if(F.col("l_n") > 0).cast("bigint").alias("left_distinct_keys"),
        F.count_if(F.col("r_n") > 0).cast("bigint").alias("right_distinct_keys"),
        F.count_if((F.col("l_n") > 0) & ~both).cast("bigint").alias("keys_only_in_left"),
        F.count_if((F.col("r_n") > 0) & ~both).cast("bigint").alias("keys_only_in_right"),
        F.count_if(both & (F.col("l_n") > 1)).cast("bigint").alias("keys_where_left_has_duplicates"),
        F.count_if(both & (F.col("r_n") > 1)).cast("bigint").alias("keys_where_right_has_duplicates"),
        F.count_if(both & (F.col("r_n") > F.col("l_n"))).cast("bigint").alias("keys_where_right_has_more_rows"),
        F.coalesce(F.sum(F.when(both, F.greatest(F.col("r_n") - F.col("l_n"), F.lit(0)))), F.lit(0))
        .cast("bigint").alias("extra_right_rows_by_key_multiplicity"),
    )


def _any_null(cols: Sequence[Column]) -> Column:
    out = cols[0].isNull()
    for c in cols[1:]:
        out = out | c.isNull()
    return out


def candidate_keys(df: DataFrame, tokens: Sequence[str] = ("id", "key", "event")) -> list[str]:
    """Columns whose (lower-case) name contains one of ``tokens`` (P14, name rule)."""
    return [c for c in df.columns if any(t in c.lower() for t in tokens)]


def key_uniqueness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Data test of P14: per candidate column rows, non-null, distinct, is_unique, in one pass."""
    aggs = []
    for c in cols:
        aggs += [F.count(F.col(f"`{c}`")).alias(f"{c}__nn"), F.count_distinct(F.col(f"`{c}`")).alias(f"{c}__d")]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    st = F.stack(F.lit(len(cols)), *[x for c in cols for x in
                                     (F.lit(c), F.col(f"`{c}__nn`"), F.col(f"`{c}__d`"))])
    return (row.select(F.col("__rows").alias("rows"), st.alias("column_name", "non_null", "distinct_values"))
            .select("column_name", F.col("rows").cast("bigint").alias("rows"),
                    F.col("non_null").cast("bigint").alias("non_null"),
                    F.col("distinct_values").cast("bigint").alias("distinct_values"),
                    ((F.col("distinct_values") == F.col("rows")) & (F.col("non_null") == F.col("rows")))
                    .alias("is_unique")))


#: Of the values of a set of columns one in SLICE is looked at before all of them are.
SLICE = 64


def composite_keys(df: DataFrame, cols: Sequence[str], max_columns: int = 3) -> DataFrame:
    """(key_columns, n_columns) of the minimal keys of at most ``max_columns`` of ``cols``: sets of columns without
    NULLs in which no two rows agree, none of which holds a smaller key.  An empty table has no key.

    Level by level: a set is no candidate if it holds a known key or if one of its columns has NULLs.  Two rows that agree
    prove that a candidate is no key, so all candidates of a size are first held against one value in SLICE, chosen by
    fingerprint (rows that agree have the same one), and only those without a repeat there are held against all rows.  A
    key is always one by all rows.
    """
    cols = list(cols)
    filled = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    open_cols = [c for i, c in enumerate(cols) if filled["rows"] and filled[f"n{i}"] == filled["rows"]]
    keys = []
    for size in range(1, max_columns + 1):
        sets = [s for s in combinations(open_cols, size) if not any(set(k) <= set(s) for k in keys)]
        for share in (SLICE, 1):
            repeated = _repeated(df, sets, share)
            sets = [s for i, s in enumerate(sets) if i not in repeated]
        keys += sets
    return df.sparkSession.createDataFrame([(",".join(k), len(k)) for k in keys], "key_columns string, n_columns int")


def _repeated(df: DataFrame, sets: Sequence[Sequence[str]], share: int) -> set[int]:
    """Numbers of the ``sets`` of columns of which two rows agree, among the rows whose fingerprint ``share`` divides.  All
    sets are counted in one scan by 128-bit fingerprints; equal ones of a task are one row before the shuffle."""
    if not sets:
        return set()
    entries = F.array(*[F.struct(F.lit(i).alias("i"), *[F.xxhash64(F.lit(k), *[F.col(f"`{c}`") for c in s]).alias(f"h{k}") for k in (1, 2)])
                        for i, s in enumerate(sets)])
    if share > 1:
        entries = F.filter(entries, lambda e: e["h1"] % share == 0)
    marked = df.select(F.explode(entries).alias("e")).select("e.*")
    counted = marked.groupBy("i", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return {r["i"] for r in counted.where("n > 1").select("i").distinct().collect()}  # one row a set


# ------------------------------------------------------------ Q1 schema diff

def schema_frame(spark: SparkSession, df: DataFrame, case: str = "upper") -> DataFrame:
    """Column catalogue of a DataFrame: (column_name, data_type, ordinal_position) (S2, metadata only)."""
    rows = [((f.name.upper() if case == "upper" else f.name), TY.spark_type_name(f.dataType), i + 1)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, data_type string, ordinal_position int")


def schema_diff(left_schema: DataFrame, right_schema: DataFrame, strip_suffix_regex: str | None = None,
                mode: str = "compatible") -> DataFrame:
    """Full outer join of two column catalogues on the normalised name.

    Inputs have (column_name, data_type) with left types in the left system's
    names and right types in Spark/lakehouse names.  Output: column_name,
    left_type, right_type, expected_left_type, status in {match,
    type_mismatch, left_only, right_only}.  Unknown right types are reported
    as type_mismatch (never silently accepted).
    """
    l = left_schema.select(F.col("column_name").alias("l_name"), F.col("data_type").alias("left_type"))
    if strip_suffix_regex:
        l = l.withColumn("l_key", F.regexp_replace("l_name", strip_suffix_regex, ""))
    else:
        l = l.withColumn("l_key", F.col("l_name"))
    r = right_schema.select(F.col("column_name").alias("r_key"), F.col("data_type").alias("right_type"))
    tmap = TY.type_map_column(mode)
    j = l.join(r, l.l_key == r.r_key, "full")
    allowed = tmap[TY.base_type_col(F.col("right_type"))]
    ok = F.coalesce(F.array_contains(allowed, TY.base_type_col(F.col("left_type"))), F.lit(False))
    return j.select(
        F.coalesce("l_key", "r_key").alias("column_name"),
        "left_type", "right_type",
        F.get(allowed, 0).alias("expected_left_type"),
        F.when(F.col("right_type").isNull(), "left_only")
        .when(F.col("left_type").isNull(), "right_only")
        .when(ok, "match").otherwise("type_mismatch").alias("status"))


def spark_schema_diff(spark: SparkSession, before: DataFrame, after: DataFrame) -> DataFrame:
    """Schema drift between two versions of one table (Q19): added / dropped / retyped / unchanged."""
    a = schema_frame(spark, before, case="none").select(F.col("column_name"), F.col("data_type").alias("before_type"))
    b = schema_frame(spark, after, case="none").select(F.col("column_name"), F.col("data_type").alias("after_type"))
    return (a.join(b, "column_name", "full")
            .select("column_name", "before_type", "after_type",
                    F.when(F.col("before_type").isNull(), "added")
                    .when(F.col("after_type").isNull(), "dropped")
                    .when(F.col("before_type") != F.col("after_type"), "retyped")
                    .otherwise("unchanged").alias("change")))


# ------------------------------------------------------------ Q2 counts

def row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """left_row_count, right_row_count, row_diff (right-left), row_diff_pct (2 dp, 0 when left is 0) (Q2, A1).

    Both counts come from one pass over the union of the two (column-less) sides.
    """
    u = left.select(F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    c = u.agg(F.coalesce(F.sum("_l"), F.lit(0)).cast("bigint").alias("left_row_count"),
              F.coalesce(F.sum("_r"), F.lit(0)).cast("bigint").alias("right_row_count"))
    d = F.col("right_row_count") - F.col("left_row_count")
    return c.select("left_row_count", "right_row_count", d.alias("row_diff"),
                    F.round(pct(d, F.col("left_row_count"), 0.0), 2).alias("row_diff_pct"),
                    (d == 0).alias("row_count_matches"))


# ------------------------------------------------------------ Q13 batch

STATUS_ORDER = ("error", "row_mismatch", "schema_mismatch", "match")


PAIR_REPORT = ("pair_name string, left_row_count bigint, right_row_count bigint, row_count_matches boolean, "
               "missing_columns string, type_mismatches string, schema_matches boolean, stats_compared bigint, "
               "stats_mismatches string, error string")


def _compare_pair(name: str, left: DataFrame, right: DataFrame) -> tuple:
    from .profile import table_comparison

    l_types, r_types = ({f.name: f.dataType.simpleString() for f in d.schema.fields} for d in (left, right))
    missing = sorted(l_types.keys() ^ r_types.keys())
    retyped = sorted(c for c in l_types.keys() & r_types.keys() if l_types[c] != r_types[c])
    same = sorted(c for c in l_types.keys() & r_types.keys() if c not in retyped)
    schema = [",".join(missing), ",".join(retyped), not missing and not retyped]
    try:
        if same:  # the rows of a side are those of any of its columns
            stats = table_comparison(left, right, same).select("column_name", "stats_match", "left_rows", "right_rows").collect()
            l_rows, r_rows = stats[0]["left_rows"], stats[0]["right_rows"]
        else:
            stats = []
            l_rows, r_rows = row_counts(left, right).select("left_row_count", "right_row_count").first()
        unlike = sorted(r["column_name"] for r in stats if not r["stats_match"])
        return (name, l_rows, r_rows, l_rows == r_rows, *schema, len(stats), ",".join(unlike), None)
    except PySparkException as e:  # this pair only
        return (name, None, None, None, *schema, None, None, e.getMessage() or str(e))


def compare_tables(pairs: Mapping[str, tuple[DataFrame, DataFrame]], at_once: int = 4) -> DataFrame:
    """Q13: one row per pair: counts, columns on one side only, common columns of different type, and common columns
    whose statistics differ; the lists are sorted and joined by commas.

    ``at_once`` pairs run at a time, each with one scan per side; what fails while a pair runs is that pair's error.
    """
    if not pairs:
        raise ValueError("no pairs to compare")
    spark = next(iter(pairs.values()))[0].sparkSession
    with ThreadPoolExecutor(at_once) as pool:
        report = list(pool.map(lambda p: _compare_pair(p[0], *p[1]), pairs.items()))
    return batch_summary(spark.createDataFrame(report, PAIR_REPORT))


def batch_summary(results: DataFrame) -> DataFrame:
    """Status per pair with precedence error -> row mismatch -> schema mismatch -> statistics mismatch -> match (Q13)."""
    return results.select(
        "*",
        F.when(F.col("error").isNotNull(), "error")
        .when(~F.col("row_count_matches"), "row_mismatch")
        .when(~F.col("schema_matches"), "schema_mismatch")
        .when(F.col("stats_mismatches") != "", "stats_mismatch")
        .otherwise("match").alias("status"))
