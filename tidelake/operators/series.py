"""Time-series windows over one observation per key and period.

Input contract: the key and the order column are unique together (the keep-latest
step and the fact contracts guarantee it), so one window partition holds at most one
row per calendar day or reporting period however many raw rows a hot key had.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from tidelake.functions import TRADING_DAYS, change, log_growth, relative_difference

INSTRUMENT_KEYS = ("instrument_id", "symbol")
SERIES_KEYS = ("indicator_id", "country_iso3")


def series_window(keys: Sequence[str], order: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())


def with_daily_return(bars: DataFrame, keys: Sequence[str] = INSTRUMENT_KEYS) -> DataFrame:
    """``ret_1d`` against the previous bar; NULL on the first one.

    Partitioning by id *and* symbol lets a filter on either reach the scan, and the
    windows below reuse this one's exchange and sort.
    """
    previous = F.lag("close").over(series_window(keys))
    return bars.withColumn("ret_1d", change("close", previous))


def with_cumulative_return(returns: DataFrame, keys: Sequence[str] = INSTRUMENT_KEYS) -> DataFrame:
    """Compounded growth since the first return, over the default RANGE frame."""
    window = series_window(keys)
    return (returns.where(F.col("ret_1d").isNotNull())
            .withColumn("cum_return", F.exp(F.sum(log_growth("ret_1d")).over(window))))


def with_volatility(returns: DataFrame, preceding: int = 30,
                    keys: Sequence[str] = INSTRUMENT_KEYS) -> DataFrame:
    """Annualised sample deviation of the current and ``preceding`` earlier returns."""
    frame = series_window(keys).rowsBetween(-preceding, Window.currentRow)
    return (returns.where(F.col("ret_1d").isNotNull())
            .withColumn("vol_30d_annualized", F.stddev_samp("ret_1d").over(frame) * math.sqrt(TRADING_DAYS)))


def with_previous_value(observations: DataFrame, name: str = "prev_value",
                        keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Value of the previous *row* of the series, whatever period that is."""
    return observations.withColumn(name, F.lag("value").over(series_window(keys)))


def with_yoy(observations: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    return with_previous_value(observations, keys=keys).withColumn("yoy_pct", change("value", "prev_value"))


def indicator_yoy(observations: DataFrame, indicator: str, limit: int | None = None) -> DataFrame:
    """Growth report of one indicator by country and date; with a ``limit`` only its first rows."""
    rows = with_previous_value(observations.where(F.col("indicator_id") == indicator), name="prev")
    report = (rows.select("indicator_id", "country_iso3", "date", "value", "prev",
                          relative_difference("value", "prev").alias("yoy"))
              .orderBy("indicator_id", F.col("country_iso3").asc_nulls_last(), F.col("date").asc_nulls_last()))
    return report if limit is None else report.limit(limit)
