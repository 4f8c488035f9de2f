"""Forward fill and as-of lookup (W4, J12), both ordered scans (:mod:`concord.operators.ordered`).

A plain ``last(x, ignorenulls) OVER (PARTITION BY key ORDER BY t)`` sends a whole key to one task; here a key's rows lie in
many range partitions and the last value before each comes from a table with one row per partition.  NULL keys are a key
like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered as O


def forward_fill(df: DataFrame, keys: Sequence[str], order_col: str, cols: Sequence[str],
                 flag_col: str | None = "forward_filled", tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Fill NULLs in ``cols`` with the last non-null value of earlier rows of the same key.

    ``flag_col`` (if given) is 1 where ``cols[0]`` was NULL before filling.
    Rows are ordered by (order_col, *tie_break).
    """
    flagged = df.withColumn(flag_col, F.col(cols[0]).isNull().cast("int")) if flag_col else df
    rows = O.in_order(flagged, keys, [order_col, *tie_break], "forward-fill")
    filled = O.scan(rows, keys, **{f"_f_{c}": O.carried(F.col(c)) for c in cols})
    return filled.select(*[F.col(f"_f_{c}").alias(c) if c in cols else F.col(c) for c in flagged.columns])


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str,
              value_cols: Sequence[str]) -> DataFrame:
    """Backward as-of join (J12): for each left row the latest right row with right_on <= left_on.

    Both sides are put in one order by (by, time), right rows first on equal times, and the last right row is carried
    along: no range join, no candidate pairs.  A NULL in ``by`` matches a NULL; left rows without a time and right rows
    without one match nothing; of right rows with the same key and time the one with the greatest values counts.  Adds
    the time of the matched row as ``asof_<right_on>`` and the value columns.
    """
    by = list(by)
    found = F.struct(F.col(right_on).alias("_t"), *[F.col(c) for c in value_cols])
    none = F.lit(None).cast(right.select(found.alias("f")).schema["f"].dataType)
    kind = left.schema[left_on].dataType
    row = F.struct(*[F.col(c) for c in left.columns])
    l = left.select(*by, F.col(left_on).alias("_at_time"), F.lit(1).alias("_side"), row.alias("_row"), none.alias("_found"))
    r = right.filter(F.col(right_on).isNotNull()).select(
        *by, F.col(right_on).cast(kind).alias("_at_time"), F.lit(0).alias("_side"),
        F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), found.alias("_found"))
    rows = O.in_order(l.unionByName(r), by, [F.col("_at_time").asc_nulls_first(), "_side", "_found"], "asof")
    s = O.scan(rows, by, _last=O.carried(F.col("_found"))).filter("_side = 1")
    return s.select(*[F.col(f"_row.`{c}`").alias(c) for c in left.columns], F.col("_last._t").alias(f"asof_{right_on}"),
                    *[F.col(f"_last.`{c}`").alias(c) for c in value_cols])
