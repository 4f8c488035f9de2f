"""Registry of named queries: name -> (spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, tuple[str, ...]] = {}


def query(name: str, ids: tuple[str, ...], sql: str | None = None):
    """Register a builder under ``name`` with the SURVEY ids it covers and its oracle SQL."""
    def deco(fn):
        QUERIES[name] = fn
        SURVEY_IDS[name] = ids
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Round every double column (result presentation only, so oracle hashes agree)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), decimals).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
