"""Name and value normalisation before two tables are compared."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------- names

def drop_technical_columns(df: DataFrame, prefixes: Iterable[str] = (), suffixes: Iterable[str] = (),
                           case_insensitive: bool = True) -> DataFrame:
    """Drop columns whose name starts with any prefix or ends with any suffix."""
    def norm(s):
        return s.upper() if case_insensitive else s
    pre = [norm(p) for p in prefixes]
    suf = [norm(s) for s in suffixes]
    keep = [c for c in df.columns
            if not any(norm(c).startswith(p) for p in pre) and not any(norm(c).endswith(s) for s in suf)]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def normalise_names(df: DataFrame, case: str = "upper", strip_suffix_regex: str | None = None) -> DataFrame:
    """Upper/lower-case all names and strip an anchored suffix such as ``_OLD$``."""
    mapping = {}
    for c in df.columns:
        n = c.upper() if case == "upper" else c.lower() if case == "lower" else c
        if strip_suffix_regex:
            n = re.sub(strip_suffix_regex, "", n)
        mapping[c] = n
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in mapping.items()])


def column_sets(left_cols: Sequence[str], right_cols: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """(common sorted, left-only sorted, right-only sorted)."""
    lset, rset = set(left_cols), set(right_cols)
    return sorted(lset & rset), sorted(lset - rset), sorted(rset - lset)


def align(df: DataFrame, cols: Sequence[str], prefix: str | None = None) -> DataFrame:
    """Select ``cols`` in the given order, optionally prefixed."""
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}" if prefix else c) for c in cols])


# ------------------------------------------------------------ values

def normalise_types(df: DataFrame) -> DataFrame:
    """Cast to the comparison normal form.

    booleans and integers -> bigint; float/double -> double with -0.0 folded
    to 0.0 and every NaN to one NaN; timestamps -> timestamp_ntz (the zone label is dropped, the wall
    clock is kept, nothing is converted).  Decimal, date, binary and strings
    are left as they are.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        dt = f.dataType
        if isinstance(dt, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(dt, (T.FloatType, T.DoubleType)):
            d = c.cast("double")
            # one bit pattern for zero and for NaN, so equal values hash equally
            c = F.when(F.isnan(d), F.lit(float("nan"))).when(d == 0.0, F.lit(0.0)).otherwise(d)
        elif isinstance(dt, T.TimestampType):
            # wall clock in the session zone, label dropped
            c = F.to_timestamp_ntz(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        out.append(c.alias(f.name))
    return df.select(*out)


def null_non_finite(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN and +-inf -> NULL for float columns."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    target = set(cols) & fl if cols is not None else fl
    return df.select(*[
        (F.when(F.isnan(F.col(f"`{c}`")) | (F.abs(F.col(f"`{c}`")) == float("inf")), F.lit(None))
         .otherwise(F.col(f"`{c}`")).alias(c)) if c in target else F.col(f"`{c}`")
        for c in df.columns])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]


# ------------------------------------------------------------ row hash

def null_mask(cols: Sequence[str]) -> Column:
    """One character per column, '1' where the value is NULL."""
    if not cols:
        return F.lit("")
    return F.concat(*[F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])


def row_fingerprint(cols: Sequence[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes (128 bits) of the NULL-masked row.

    At 10^12 rows a single 64-bit hash has expected collisions; two hashes
    seeded differently make a collision negligible while shuffling only 16
    bytes per distinct row instead of the whole row.
    """
    m = null_mask(cols)
    vals = [F.col(f"`{c}`") for c in cols]
    return F.xxhash64(*vals, m), F.xxhash64(F.lit("concord-fp2"), *vals, m)
