"""Price-series returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Look-back periods in years and the day count of a year.
LOOKBACK_YEARS = (1, 2, 3, 4, 5)
DAYS_PER_YEAR = 365.25


def series_cagr(prices: DataFrame, by: Sequence[str], date_col: str = "date", price_col: str = "price") -> DataFrame:
    """First and last price per series (``min_by``/``max_by``), years = days / 365.25,
    CAGR = (last/first)^(1/years) - 1, total return = last/first - 1."""
    g = prices.where(F.col(price_col).isNotNull()).groupBy(*by).agg(
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
        F.min_by(price_col, date_col).alias("first_price"), F.max_by(price_col, date_col).alias("last_price"))
    years = F.datediff(F.col("last_date"), F.col("first_date")) / F.lit(DAYS_PER_YEAR)
    ratio = F.try_divide(F.col("last_price"), F.col("first_price"))
    return g.select("*", years.alias("years"),
                    F.when(years > 0, F.pow(ratio, F.try_divide(F.lit(1.0), years)) - 1).alias("cagr"),
                    (ratio - 1).alias("total_return"))


def lookback_returns(prices: DataFrame, by: Sequence[str], date_col: str = "date", price_col: str = "price",
                     years: Sequence[int] = LOOKBACK_YEARS) -> DataFrame:
    """V7: for each series and look-back y, target = latest date - int(365.25*y) days (N21); start = the
    latest price at or before the target (as-of, J12); total and annualised return.  Look-backs with no
    earlier price are omitted.

    The latest row of each series is joined to its prices, and all look-backs are picked in one aggregate
    (``max_by`` over the prices not after the target), which combines partially: a long series is never
    one task's window.
    """
    p = prices.where(F.col(price_col).isNotNull()).select(*by, F.col(date_col).alias("_d"), F.col(price_col).alias("_p"))
    latest = p.groupBy(*by).agg(F.max("_d").alias("end_date"), F.max_by("_p", "_d").alias("end_price"))
    target = {y: F.date_sub(F.col("end_date"), int(y * DAYS_PER_YEAR)).cast("timestamp_ntz") for y in years}
    picked = (p.join(latest, list(by)).groupBy(*by, "end_date", "end_price")
              .agg(*[F.max_by(F.struct("_d", "_p"), F.when(F.col("_d") <= target[y], F.col("_d"))).alias(f"_s{y}")
                     for y in years]))
    starts = F.explode(F.array(*[F.struct(F.lit(y).alias("period_years"), target[y].alias("target_date"),
                                          F.col(f"_s{y}").alias("start")) for y in years]))
    j = (picked.select(*by, "end_date", "end_price", starts.alias("x")).where(F.col("x.start").isNotNull())
         .select(*by, "end_date", "end_price", "x.period_years", "x.target_date",
                 F.col("x.start._d").cast("timestamp_ntz").alias("start_date"), F.col("x.start._p").alias("start_price")))
    act = F.datediff(F.col("end_date"), F.col("start_date")) / F.lit(DAYS_PER_YEAR)
    ratio = F.try_divide(F.col("end_price"), F.col("start_price"))
    return j.select(*by, "period_years", "target_date", "start_date", "start_price", "end_date", "end_price",
                    (ratio - 1).alias("total_return"),
                    F.when(act > 0, F.pow(ratio, F.try_divide(F.lit(1.0), act)) - 1).alias("annualized_return"))
