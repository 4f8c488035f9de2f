"""Ordered scans: lead, lag, running totals and carried values over a range-partitioned order.

``in_order`` range-partitions the rows by (keys, order), sorts each partition and writes it once, with the partition's
number ``_part`` and the row's place ``_at`` in it.  So a key with a third of all rows lies in many partitions, one after
the other, and NULL keys are a key like any other.

``scan`` then needs no window over a whole key: windows run over (partition, key), and what crosses a partition edge comes
from the *edge table*, one row per partition: the state that the first key of the partition brings along from the
partitions before it, and the first rows of its last key in the partitions after it.  The edge table is built from the
keys that touch an edge (at most two a partition), so its size is bounded by the number of partitions, whatever the data.
For that reason it is made in one task and broadcast.

Rows that are equal in (keys, order) come in any order; give ``order`` a tie-break where that matters.  An empty input
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import scratch_path

PART, AT = "_part", "_at"
_ROW_BITS = 33  # monotonically_increasing_id counts the rows of a partition in its lower 33 bits


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "ordered") -> DataFrame:
    """``df`` sorted by (keys, order) over range partitions, written below the checkpoint folder and read back, with
    ``_part`` and ``_at`` (from 0).  Spark samples the input once for the bounds of the partitions."""
    by = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    row = F.monotonically_increasing_id()
    rows = (df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row_id", row)
            .withColumns({PART: F.shiftright("_row_id", _ROW_BITS).cast("int"),
                          AT: F.col("_row_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}).drop("_row_id"))
    path = scratch_path(df.sparkSession, name)
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


@dataclass(frozen=True)
class Running:
    """A value that grows along a key: ``local`` within the partition, ``total`` of a key's rows of one partition,
    ``fold`` of such totals over a window, and ``merge(before, local)``."""

    local: Callable[[WindowSpec], Column]
    total: Column
    fold: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Shifted:
    """The value ``steps`` rows before (``steps`` < 0: after) the row in its key; NULL where there is none."""

    value: Column
    steps: int


def position() -> Running:
    """The row's place in its key, from 1."""
    return Running(lambda w: F.row_number().over(w).cast("bigint"), F.count(F.lit(1)), F.sum,
                   lambda before, local: F.coalesce(before, F.lit(0)) + local)


def running_sum(value: Column) -> Running:
    """The sum up to and including the row; NULL before the first value that is not NULL."""
    return Running(lambda w: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.sum(value), F.sum,
                   lambda before, local: F.coalesce(before + local, local, before))


def running_xor(value: Column) -> Running:
    """The exclusive or of the values up to and including the row."""
    return Running(lambda w: F.bit_xor(value).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.bit_xor(value),
                   F.bit_xor, lambda before, local: F.coalesce(before.bitwiseXOR(local), local, before))


def carried(value: Column) -> Running:
    """The last value that is not NULL, up to and including the row."""
    return Running(lambda w: F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                   F.max_by(value, F.when(value.isNotNull(), F.col(AT))), lambda c: F.last(c, ignorenulls=True),
                   lambda before, local: F.coalesce(local, before))


def lag(value: Column, steps: int = 1) -> Shifted:
    return Shifted(value, steps)


def lead(value: Column, steps: int = 1) -> Shifted:
    return Shifted(value, -steps)


def scan(rows: DataFrame, keys: Sequence[str], **made: Running | Shifted) -> DataFrame:
    """The rows of :func:`in_order` with one column per item of ``made``."""
    keys = list(keys)
    running = {k: v for k, v in made.items() if isinstance(v, Running)}
    shifted = {k: v for k, v in made.items() if isinstance(v, Shifted)}
    back = max([v.steps for v in shifted.values() if v.steps > 0], default=0)
    ahead = max([-v.steps for v in shifted.values() if v.steps < 0], default=0)
    edges = _edges(rows, keys, running, shifted, back, ahead)
    w = Window.partitionBy(PART, *keys).orderBy(AT)
    names = [c for c in rows.columns if c not in (PART, AT)]
    local = rows.select("*", F.row_number().over(w).alias("_rank"),
                        *[v.local(w).alias(f"_l_{k}") for k, v in running.items()],
                        *[(F.lag(F.struct(v.value.alias("v")), v.steps) if v.steps > 0
                           else F.lead(F.struct(v.value.alias("v")), -v.steps)).over(w).alias(f"_l_{k}")
                          for k, v in shifted.items()])
    j = local.join(F.broadcast(edges), PART, "left")
    first, last = F.col(AT) < F.col("_first_n"), F.col(AT) >= F.col("_last_at")
    out = [v.merge(F.when(first, F.col(f"_b_{k}")), F.col(f"_l_{k}")).alias(k) for k, v in running.items()]
    for k, v in shifted.items():
        if v.steps > 0:  # counted from the end of the rows before the partition
            over = F.when(first & (F.col("_rank") <= v.steps),
                          F.try_element_at("_before", (F.col("_rank") - v.steps - 1).cast("int")))
        else:
            left = F.col("_rows") - 1 - F.col(AT)  # rows of the partition after this one
            over = F.when(last & (left < -v.steps), F.try_element_at("_after", (-v.steps - left).cast("int")))
        out.append(F.coalesce(F.col(f"_l_{k}")["v"], over[k]).alias(k))
    return j.select(*names, *out)


def _edges(rows: DataFrame, keys: list[str], running: dict[str, Running], shifted: dict[str, Shifted], back: int,
           ahead: int) -> DataFrame:
    """One row per partition: _rows, _first_n (rows of its first key), _last_at (where its last key starts), _b_<name>
    and _before (what comes to the first key from earlier partitions), _after (what follows the last key)."""
    sizes = rows.groupBy(PART).agg((F.max(AT) + 1).alias("_rows")).coalesce(1)
    # the keys at the edges: at most two rows a partition
    touching = (rows.join(F.broadcast(sizes), PART).where((F.col(AT) == 0) | (F.col(AT) == F.col("_rows") - 1))
                .select(F.col(PART).alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct().coalesce(1))
    same = F.col(PART) == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    near = rows.join(F.broadcast(touching), same, "left_semi")
    chunks = (near.groupBy(PART, *keys)
              .agg(F.min(AT).alias("_from"), F.max(AT).alias("_to"),
                   *[v.total.alias(f"_t_{k}") for k, v in running.items()]).coalesce(1))
    # the first and the last few rows of each of these: as many as the steps ask for
    values = F.struct(AT, *[v.value.alias(k) for k, v in shifted.items()])
    w = Window.partitionBy(*keys).orderBy(PART)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    if shifted:
        c = chunks.select(F.col(PART).alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_from", "_to")
        ends = (near.join(F.broadcast(c), same)
                .where((F.col(AT) - F.col("_from") < ahead) | (F.col("_to") - F.col(AT) < back))
                .groupBy(F.col("_p").alias("_ep"), F.col("_from").alias("_ef"))
                .agg(F.sort_array(F.collect_list(F.when(F.col(AT) - F.col("_from") < ahead, values))).alias("_head"),
                     F.sort_array(F.collect_list(F.when(F.col("_to") - F.col(AT) < back, values))).alias("_tail")).coalesce(1))
        chunks = chunks.join(F.broadcast(ends), (F.col(PART) == F.col("_ep")) & (F.col("_from") == F.col("_ef")))
    reach = []
    if back:  # every chunk has a row at least, so `back` chunks hold enough
        reach.append(F.flatten(F.collect_list("_tail").over(w.rowsBetween(-back, -1))).alias("_before"))
    if ahead:
        reach.append(F.flatten(F.collect_list("_head").over(w.rowsBetween(1, ahead))).alias("_after"))
    c = chunks.select(PART, "_from", "_to", *reach,
                      *[v.fold(F.col(f"_t_{k}")).over(earlier).alias(f"_b_{k}") for k, v in running.items()])
    c = c.join(F.broadcast(sizes), PART)
    first, last = F.col("_from") == 0, F.col("_to") == F.col("_rows") - 1
    pick = lambda name, when: F.max_by(F.col(name), F.when(when, F.lit(1))).alias(name)
    return c.groupBy(PART).agg(
        F.max("_rows").alias("_rows"), F.max(F.when(first, F.col("_to") + 1)).alias("_first_n"),
        F.max(F.when(last, F.col("_from"))).alias("_last_at"),
        *[pick(f"_b_{k}", first) for k in running],
        *([pick("_before", first)] if back else []), *([pick("_after", last)] if ahead else []))
