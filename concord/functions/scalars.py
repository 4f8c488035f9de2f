"""Scalar helpers that are not plain one-liners."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_number(c: Column) -> Column:
    """first run of digits as a bigint sort key; NULL when there is none (N16, no ANSI error)."""
    return F.regexp_extract(c, r"(\d+)", 1).try_cast("bigint")


def display_name(code: Column, name: Column, sep: str = " - ") -> Column:
    """'CODE - name' with NULL parts skipped (concat_ws)."""
    return F.concat_ws(sep, F.upper(F.trim(code)), F.trim(name))


def safe_pct(num: Column, den: Column, default: float | None = None) -> Column:
    """100*num/den, ``default`` when den is 0 or NULL (ANSI-safe)."""
    v = F.try_divide(num.cast("double") * 100.0, den.cast("double"))
    return F.coalesce(v, F.lit(default)) if default is not None else v


def local_to_utc(ts: Column, zone_key: Column, zones: Mapping[str, str], default_zone: str = "UTC") -> Column:
    """wall-clock local time -> UTC using a zone chosen per row (e.g. by region); the result carries
    no zone label (timestamp_ntz)."""
    kv = []
    for k, v in zones.items():
        kv += [F.lit(k), F.lit(v)]
    zone = F.coalesce(F.create_map(*kv)[zone_key], F.lit(default_zone))
    return F.to_utc_timestamp(ts, zone).cast("timestamp_ntz")


def date_key(ts: Column) -> Column:
    """local date key."""
    return F.to_date(ts)


def time_key(ts: Column) -> Column:
    """local HHmm key."""
    return F.date_format(ts, "HHmm")


def int_to_date(c: Column) -> Column:
    """yyyyMMdd integer -> date (NULL for a value that is not a valid date, no ANSI error)."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")
