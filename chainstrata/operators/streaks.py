"""Runs of equal regimes in a daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from chainstrata.operators.fees import by_date


def with_streak_id(daily: DataFrame, label: str) -> DataFrame:
    """Number the runs of equal labels from 1; the first row starts one."""
    w = by_date()
    changed = F.coalesce((F.col(label) != F.lag(label).over(w)).cast("int"), F.lit(1))
    return (
        daily.withColumn("_changed", changed)
        .withColumn("streak_id", F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("_changed")
    )


def streaks(daily: DataFrame, label: str, wanted: str) -> DataFrame:
    """One row per run of ``wanted``: span, length, peak z-score, mean fees, end prices."""
    runs = with_streak_id(daily, label).filter(F.col(label) == wanted)
    return runs.groupBy("streak_id").agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.count("*").alias("days"),
        F.max("fees_zscore").alias("max_zscore"),
        F.avg("fees_btc").alias("avg_fees"),
        F.min_by("btc_price", "date").alias("price_start"),
        F.max_by("btc_price", "date").alias("price_end"),
    )


def streak_totals(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count("*").alias("streaks"), F.avg("days").alias("avg_days"), F.max("days").alias("max_days"))
