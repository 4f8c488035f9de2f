"""Data-quality checks: measure parity, load smoke checks, verdicts, row expectations (Q14-Q18)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered as O
from .compare import pct


def load_smoke_check(df: DataFrame, keys: Sequence[str], value_col: str) -> DataFrame:
    """Q15: rows, distinct keys, duplicate keys, min/max of a value (e.g. update time) in one pass."""
    k = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.count_distinct(k).cast("bigint").alias("distinct_keys"),
                  (F.count(F.lit(1)) - F.count_distinct(k)).cast("bigint").alias("duplicate_keys"),
                  F.min(value_col).alias("min_value"), F.max(value_col).alias("max_value"))


def measure_parity(left: DataFrame, right: DataFrame, period: Column | str, measures: dict[str, Column],
                   tolerance_pct: float = 0.0) -> DataFrame:
    """Q14: base measures per period on both sides, diff %, within tolerance, and 'two clean cycles in a row'.

    ``measures`` maps a name to an aggregate expression.  Both sides are
    unioned with a tag and grouped once per period (full outer by
    construction).  ``clean_streak`` is true when this and the previous
    period are both within tolerance for every measure (a ``lag`` over the
    periods by an ordered scan, so any number of periods will do).
    """
    p = F.col(period) if isinstance(period, str) else period
    l = left.select(p.alias("period"), F.lit("left").alias("_side"), "*")
    r = right.select(p.alias("period"), F.lit("right").alias("_side"), "*")
    aggs = []
    for name, e in measures.items():
        aggs += [F.max(F.when(F.col("_side") == "left", F.col(f"_{name}"))).alias(f"left_{name}"),
                 F.max(F.when(F.col("_side") == "right", F.col(f"_{name}"))).alias(f"right_{name}")]
    per_side = (l.unionByName(r, allowMissingColumns=True).groupBy("period", "_side")
                .agg(*[e.alias(f"_{n}") for n, e in measures.items()]))
    g = per_side.groupBy("period").agg(*aggs)
    ok = F.lit(True)
    cols = ["period"]
    for name in measures:
        lv, rv = F.coalesce(F.col(f"left_{name}"), F.lit(0)), F.coalesce(F.col(f"right_{name}"), F.lit(0))
        d = F.round(pct(rv - lv, lv, None), 6)
        g = g.withColumn(f"{name}_diff_pct", F.when(lv == rv, F.lit(0.0)).otherwise(d))
        g = g.withColumn(f"{name}_ok", F.coalesce(F.abs(F.col(f"{name}_diff_pct")) <= tolerance_pct, F.lit(False)))
        ok = ok & F.col(f"{name}_ok")
        cols += [f"left_{name}", f"right_{name}", f"{name}_diff_pct", f"{name}_ok"]
    g = g.withColumn("within_tolerance", ok)
    s = O.scan(O.in_order(g, [], ["period"], "parity-periods"), [], _before=O.lag(F.col("within_tolerance")))
    return s.select(*cols, "within_tolerance",
                    (F.col("within_tolerance") & F.coalesce("_before", F.lit(False))).alias("clean_streak"))


def verdict(checks: DataFrame, name_col: str = "check", passed_col: str = "passed",
            tolerance_pct: float = 0.0) -> DataFrame:
    """Q16: one row: all_passed, number of checks, failed checks and a JSON details text of every check."""
    return checks.agg(
        F.min(F.col(passed_col).cast("int")).cast("boolean").alias("all_passed"),
        F.count(F.lit(1)).cast("bigint").alias("checks"),
        F.count_if(~F.col(passed_col)).cast("bigint").alias("failed"),
        F.to_json(F.struct(F.lit(tolerance_pct).alias("tolerance_pct"),
                           F.array_sort(F.collect_list(F.struct(F.col(name_col).alias("check"),
                                                                F.col(passed_col).alias("passed"))))
                           .alias("checks"))).alias("details"))


def expectations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q17: add one boolean column per rule (``_exp_<name>``) and ``_valid`` = all rules hold.

    A NULL rule result counts as a failure.
    """
    out = df.select("*", *[F.coalesce(e, F.lit(False)).alias(f"_exp_{n}") for n, e in rules.items()])
    ok = F.lit(True)
    for n in rules:
        ok = ok & F.col(f"_exp_{n}")
    return out.withColumn("_valid", ok)


def apply_expectations(df: DataFrame, rules: dict[str, Column], action: str = "warn") -> DataFrame:
    """Q17 actions: ``warn`` keeps rows (flags added), ``drop`` removes failing rows, ``fail`` raises at run time."""
    e = expectations(df, rules)
    if action == "warn":
        return e
    if action == "drop":
        return e.where(F.col("_valid"))
    if action == "fail":
        return e.withColumn("_valid", F.when(F.col("_valid"), F.lit(True))
                            .otherwise(F.raise_error(F.lit("row expectation failed"))))
    raise ValueError(action)


def expectation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q17 metrics: failing rows per rule, long form, one pass."""
    e = expectations(df, rules)
    agg = e.agg(*[F.count_if(~F.col(f"_exp_{n}")).cast("bigint").alias(n) for n in rules],
                F.count(F.lit(1)).cast("bigint").alias("_rows"))
    st = F.stack(F.lit(len(rules)), *[x for n in rules for x in (F.lit(n), F.col(n))])
    return agg.select(st.alias("rule", "failed_rows"), F.col("_rows").alias("rows"))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Q18: (valid rows, quarantined rows with the names of the failed rules)."""
    e = expectations(df, rules)
    failed = F.filter(F.array(*[F.when(~F.col(f"_exp_{n}"), F.lit(n)) for n in rules]), lambda x: x.isNotNull())
    base = [c for c in df.columns]
    return (e.where(F.col("_valid")).select(*base),
            e.where(~F.col("_valid")).select(*base, failed.alias("failed_rules")))


def metric_layers(df: DataFrame, dims: Sequence[str], base: dict[str, Column],
                  metrics: dict[str, tuple[str, str]]) -> DataFrame:
    """Base measures aggregated per dimension set, then metrics composed from base measures as
    ratios (``try_divide``: NULL on a zero denominator, no ANSI error).

    ``base`` maps a name to an aggregate; ``metrics`` maps a name to (numerator, denominator) base names.
    """
    g = df.groupBy(*dims).agg(*[e.alias(n) for n, e in base.items()])
    return g.select(*dims, *base, *[F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")).alias(n)
                                    for n, (a, b) in metrics.items()])
