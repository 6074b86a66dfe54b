"""Price bars: resampling, daily measures, deduplication."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.functions.calendar import bar_start
from chainstrata.functions.ratios import ratio, ratio_or_zero
from chainstrata.operators import series

TRADING_DAYS = 365


def time_key(ts: Column, tie: Column | None = None) -> Column:
    """Sort key for open and close picks, of a type hash aggregation can update in place.

    Without ``tie`` timestamps must be unique per series. With it, equal
    timestamps are ordered by that integer: both are packed in one decimal.
    """
    micros = F.unix_micros(ts.cast("timestamp"))
    if tie is None:
        return micros
    shift = F.lit("10000000000000000000").cast("decimal(20,0)")
    packed = micros.cast("decimal(18,0)") * shift + tie.cast("decimal(19,0)")
    return packed.cast("decimal(38,0)")


def resample(ticks: DataFrame, bar: str, keys: Sequence[str] = ("symbol",), tie: str | None = None,
             extra_last: Sequence[str] = ()) -> DataFrame:
    """Candles or ticks to longer bars: first, max, min, last, sums.

    Partial aggregation runs before the one shuffle, so a symbol that owns most
    ticks is reduced to a few rows per bar and task first.
    """
    key = time_key(F.col("open_time"), F.col(tie) if tie else None)
    return (
        ticks.withColumn("_key", key)
        .groupBy(*keys, bar_start(F.col("open_time"), bar).alias("bar"))
        .agg(
            F.min_by("open", "_key").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "_key").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trades").alias("trades"),
            F.count("*").alias("num_candles"),
            *[F.max_by(c, "_key").alias(c) for c in extra_last],
        )
        .withColumnRenamed("bar", "open_time")
    )


def daily_measures(daily: DataFrame, keys: Sequence[str] = ("symbol",), order: str = "date") -> DataFrame:
    """Returns, annualised volatility, range and volume-weighted price of daily bars."""
    w = Window.partitionBy(*keys).orderBy(order)
    return (
        daily.withColumn("return_daily", series.pct_change(F.col("close"), w))
        .withColumn("log_return", series.log_return(F.col("close"), w))
        .withColumn("volatility_30d", series.rolling_std(F.col("log_return"), w, 30) * math.sqrt(TRADING_DAYS))
        .withColumn("range_pct", ratio(F.col("high") - F.col("low"), F.col("open")) * 100)
        .withColumn("vwap", ratio_or_zero(F.col("quote_volume"), F.col("volume")))
    )


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark turns the rank filter into a group limit that runs before the shuffle
    too, so each task sends one copy of a key, however many it holds.
    """
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_at", at).filter(F.col("_at") == 1).drop("_at")


def newest_per_key(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows per key; each task keeps only ``n`` per key before the shuffle."""
    order = [order] if isinstance(order, str) else order
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*map(F.desc, order)))
    return df.withColumn("_at", at).filter(F.col("_at") <= n).drop("_at")
