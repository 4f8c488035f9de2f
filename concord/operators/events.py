"""Event sequences per asset: lead / lag and the event-group start flag.

All of them are ordered scans (:mod:`concord.operators.ordered`): a NULL asset is an asset like any other, and an asset with
a third of all events is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered as O

# Fixed value: gap in minutes below which an event continues the group.
GROUP_GAP_MINUTES = 10


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], lead_cols: Sequence[str] = (),
               lag_cols: Sequence[str] = (), running_sums: Sequence[str] = ()) -> DataFrame:
    """Per key, ordered by ``order``: ``lead1_<c>`` for ``lead_cols``, ``lag1_<c>``/``lag2_<c>`` for ``lag_cols``,
    ``cum_<c>`` (running sum up to and including the row) for ``running_sums`` and ``seq`` (place in the key, from 1)."""
    rows = O.in_order(df, keys, order, "neighbours")
    made = {f"lead1_{c}": O.lead(F.col(c)) for c in lead_cols}
    made |= {f"lag{k}_{c}": O.lag(F.col(c), k) for c in lag_cols for k in (1, 2)}
    made |= {f"cum_{c}": O.running_sum(F.col(c)) for c in running_sums}
    return O.scan(rows, keys, **made, seq=O.position())


def lead_lag(df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str], lead_col: str,
             lag_col: str) -> DataFrame:
    """Adds ``lead1`` = lead(lead_col, 1), ``lag1``/``lag2`` = lag(lag_col, 1/2) per key ordered by
    (order_col, *tie_break)."""
    rows = O.in_order(df, keys, [order_col, *tie_break], "lead-lag")
    return O.scan(rows, keys, lead1=O.lead(F.col(lead_col)), lag1=O.lag(F.col(lag_col)), lag2=O.lag(F.col(lag_col), 2))


def event_groups(df: DataFrame, asset: str, start: str, finish: str, tie_break: Sequence[str] = (),
                 dedup_keys: Sequence[str] | None = None,
                 dedup_order: Sequence[Column] = (), dedup_first: bool = True) -> DataFrame:
    """``group_start`` = 0 when a next event exists and (start - lag-2 finish) < 10 minutes, else 1.

    With ``dedup_keys`` the latest version of each event (by ``dedup_order``) is kept first
    (``dedup_first=True``) or after the windows, as the original did (``False``).

    Adds next_start (lead of start) and lag2_finish.  A NULL lag gives a NULL
    test and hence 1, as in the original rule.
    """
    from .dedup import latest_per_key

    if dedup_keys and dedup_first:
        df = latest_per_key(df, dedup_keys, list(dedup_order))
    ll = lead_lag(df, [asset], start, tie_break, start, finish)
    gap_min = (F.unix_timestamp(F.col(start)) - F.unix_timestamp(F.col("lag2"))) / 60
    flag = F.when(F.col("lead1").isNotNull() & (F.lit(GROUP_GAP_MINUTES) > gap_min), 0).otherwise(1)
    out = ll.select(*df.columns, F.col("lead1").alias("next_start"), F.col("lag2").alias("lag2_finish"),
                    flag.cast("tinyint").alias("group_start"))
    if dedup_keys and not dedup_first:  # the original order: windows over all versions, then keep the latest
        out = latest_per_key(out, dedup_keys, list(dedup_order))
    return out


def event_rollup(flagged: DataFrame, asset: str, start: str, finish: str, measures: Sequence[str],
                 tie_break: Sequence[str] = ()) -> DataFrame:
    """Events grouped into event groups (a new group at each ``group_start`` = 1, the running sum of the
    flag is the group number) and the measures summed per group.  The final aggregate pre-aggregates map-side."""
    rows = O.in_order(flagged, [asset], [start, *tie_break], "event-rollup")
    n = O.scan(rows, [asset], event_group=O.running_sum(F.col("group_start").cast("bigint")))
    return (n.groupBy(asset, "event_group")
            .agg(F.min(start).alias("group_start_time"), F.max(finish).alias("group_finish_time"),
                 F.count(F.lit(1)).cast("bigint").alias("events"),
                 *[F.sum(m).alias(f"sum_{m}") for m in measures]))
