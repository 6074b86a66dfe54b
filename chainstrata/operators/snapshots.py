"""Weekly holder snapshots: trends over a month and week-over-week changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Window, shortest history, move size and label thresholds.
TREND_DAYS = 28
MIN_DELTAS = 3
STRONG_MOVE_COINS = 100
MOVE_SHARE = 0.10
TREND_LABELS = {
    "strong_up": "ACUMULANDO FUERTE",
    "up": "Acumulando",
    "strong_down": "VENDIENDO FUERTE",
    "down": "Vendiendo",
    "flat": "Estable",
}


def snapshot(holders: DataFrame, week: Column, min_coins: float = 10.0) -> DataFrame:
    return holders.filter(F.col("btc") >= min_coins).select(week.alias("week"), "address", "btc")


def trend_label(ups: Column, downs: Column, change: Column, strong: float = STRONG_MOVE_COINS) -> Column:
    return (
        F.when((ups >= 3) & (change > strong), TREND_LABELS["strong_up"])
        .when((ups >= 2) & (change > 0), TREND_LABELS["up"])
        .when((downs >= 3) & (change < -strong), TREND_LABELS["strong_down"])
        .when((downs >= 2) & (change < 0), TREND_LABELS["down"])
        .otherwise(TREND_LABELS["flat"])
    )


def address_trends(snapshots: DataFrame, as_of: Column, strong: float = STRONG_MOVE_COINS) -> DataFrame:
    """Change per address over the last four weeks, for addresses with enough history.

    A snapshot table holds one row per week and address, so an address has at
    most a few rows in the window.
    """
    w = Window.partitionBy("address").orderBy("week")
    recent = snapshots.filter(F.col("week") >= F.date_sub(as_of, TREND_DAYS))
    deltas = recent.withColumn("delta", F.col("btc") - F.lag("btc").over(w)).filter("delta is not null")
    return (
        deltas.groupBy("address").agg(
            F.sum("delta").alias("total_delta"),
            F.count_if(F.col("delta") > 0).alias("up_weeks"),
            F.count_if(F.col("delta") < 0).alias("down_weeks"),
            F.count("*").alias("weeks_present"),
            F.avg("btc").alias("avg_btc"),
        )
        .filter(F.col("weeks_present") >= MIN_DELTAS)
        .withColumn("trend", trend_label(F.col("up_weeks"), F.col("down_weeks"), F.col("total_delta"), strong))
    )


def trend_table(trends: DataFrame) -> DataFrame:
    return trends.groupBy("trend").agg(F.count("*").alias("holders"), F.sum("total_delta").alias("total_btc"))


def changes(snapshots: DataFrame, week: Column, previous: Column, share: float = MOVE_SHARE) -> DataFrame:
    """New, exited and strongly moved addresses between two snapshots.

    One pass: both weeks fold into a row per address, which is what a full outer
    join of the two would give with twice the shuffle.
    """
    now = F.max(F.when(F.col("week") == week, F.col("btc")))
    then = F.max(F.when(F.col("week") == previous, F.col("btc")))
    both = snapshots.filter((F.col("week") == week) | (F.col("week") == previous)).groupBy("address").agg(
        then.alias("btc_before"), now.alias("btc_now"))
    moved = F.abs(F.col("btc_now") - F.col("btc_before")) > share * F.col("btc_before")
    kind = (
        F.when(F.col("btc_before").isNull(), "new")
        .when(F.col("btc_now").isNull(), "exited")
        .when(moved & (F.col("btc_now") > F.col("btc_before")), "up")
        .when(moved, "down")
    )
    return both.withColumn("change", kind).filter("change is not null").withColumn(
        "delta", F.coalesce("btc_now", F.lit(0)) - F.coalesce("btc_before", F.lit(0)))
