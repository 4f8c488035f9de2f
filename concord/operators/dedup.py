"""Keep-one-row-per-key operators.

Instead of ``row_number() OVER (PARTITION BY key ORDER BY t DESC) = 1`` the
newest row is picked with ``max(struct(order..., row...))`` grouped by the key:
the aggregate is computed partially on the map side, so a key that holds a
third of all rows sends one record per map task through the shuffle rather
than the whole group into one window task.  The ordering struct ends with a
tie-break so the choice is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], descending: bool = True) -> DataFrame:
    """One row per key: the row with the greatest (or least) ``order`` tuple.

    ``order`` must make rows unique within a key (add a tie-break column);
    NULL order values sort first (lowest), as in ``ORDER BY ... DESC NULLS LAST``
    for ``descending=True``.
    """
    others = [c for c in df.columns if c not in keys]
    ordered = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                       F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"))
    agg = F.max(ordered) if descending else F.min(ordered)
    return (df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(agg.alias("_best"))
            .select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"_best._row.`{c}`").alias(c) for c in others])
            .select(*[F.col(f"`{c}`") for c in df.columns]))


def drop_exact_duplicates(df: DataFrame, cols: Sequence[str] | None = None, newest: Column | None = None,
                          tie_break: Sequence[Column] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """One row per row-hash of ``cols`` (NULL-masked), newest ``newest`` first; the columns ``keep`` (default all).

    Without ``newest`` this is ``dropDuplicates(cols)``.  Only fingerprints and kept columns are shuffled, so
    long compared columns that are not kept never leave their scan.
    """
    cols, keep = list(cols or df.columns), list(keep or df.columns)
    if newest is None:
        return df.dropDuplicates(cols).select(*[F.col(f"`{c}`") for c in keep])
    h1, h2 = N.row_fingerprint(cols)
    order = [newest, *tie_break]
    withh = df.select(*[F.col(f"`{c}`") for c in keep], h1.alias("_h1"), h2.alias("_h2"),
                      *[o.alias(f"_by{i}") for i, o in enumerate(order)])
    by = [F.col(f"_by{i}") for i in range(len(order))]
    return latest_per_key(withh, ["_h1", "_h2"], by).select(*[F.col(f"`{c}`") for c in keep])


def latest_change(feed: DataFrame, keys: Sequence[str], version_col: str = "_commit_version",
                  modified_col: str | None = None, change_col: str = "_change_type",
                  change_types: Sequence[str] = ("insert", "update_postimage", "delete")) -> DataFrame:
    """Latest change per primary key: version desc, modified desc, then insert before delete.

    Change types outside ``change_types`` (e.g. update pre-images) are
    filtered first in every variant (N14).
    """
    f = feed.where(F.col(change_col).isin(*change_types))
    prio = F.when(F.col(change_col) == "delete", 0).otherwise(1)
    order = [F.col(version_col)] + ([F.col(modified_col)] if modified_col else []) + [prio]
    return latest_per_key(f, keys, order)


def change_history(feed: DataFrame, keys: Sequence[str], version_col: str = "_commit_version",
                   change_col: str = "_change_type", value_cols: Sequence[str] = ()) -> DataFrame:
    """Per key, each change with the previous version, change type and values, and its position.

    Ordered by version (delete before insert at one version); an ordered scan
    (:mod:`concord.operators.ordered`), so a key with a very long history is
    not handled by a single task, and rows without a key have one history.
    """
    from . import ordered as O

    prio = F.when(F.col(change_col) == "delete", 0).otherwise(1)
    rows = O.in_order(feed.withColumn("_prio", prio), keys, [version_col, "_prio"], "change-history")
    previous = {"prev_version": version_col, "prev_change_type": change_col, **{f"prev_{c}": c for c in value_cols}}
    n = O.scan(rows, keys, **{k: O.lag(F.col(c)) for k, c in previous.items()}, change_seq=O.position())
    return n.select(*feed.columns, *previous, "change_seq")
