"""Block fees and daily fee series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.functions import money
from chainstrata.functions.bins import band_regime
from chainstrata.functions.ratios import ratio, zscore
from chainstrata.operators import series

Z_DAYS = 30


def block_metrics(blocks: DataFrame, inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Fees per block: what its coinbase paid out beyond the subsidy.

    The coinbase side is a distinct key set, so the join is a left-semi one, and
    outputs are narrowed before they are summed by height.
    """
    coinbase = inputs.filter("is_coinbase").select("txid", "height").distinct()
    paid = (
        outputs.select("txid", "height", "value_sats")
        .join(coinbase, ["txid", "height"], "left_semi")
        .groupBy("height").agg(F.sum("value_sats").alias("coinbase_sats"))
    )
    subsidy = money.block_subsidy(F.col("height"))
    total = F.coalesce("coinbase_sats", F.lit(0).cast("bigint"))
    return blocks.select("height", F.col("hash").alias("block_hash"), "time", "nTx").join(paid, "height", "left").select(
        "height", "block_hash", "time", "nTx",
        subsidy.alias("subsidy_sats"),
        money.block_fees(total, subsidy).alias("fees_sats"),
    )


def daily_fees(metrics: DataFrame, date: Column, fee_units: Column, units_per_coin: float = money.SATS_PER_COIN) -> DataFrame:
    """Fee total and block count per day. Sums integers, so the order of rows is irrelevant."""
    return (
        metrics.groupBy(date.alias("date"))
        .agg(F.sum(fee_units).alias("fee_units"), F.count("*").alias("num_blocks"))
        .withColumn("fees_btc", F.col("fee_units") / F.lit(float(units_per_coin)))
    )


def by_date() -> Window:
    """Order of a daily series. Its length is bounded by the calendar, not by the data."""
    return Window.partitionBy().orderBy("date")


def with_fee_zscore(daily: DataFrame, n: int = Z_DAYS) -> DataFrame:
    fees, w = F.col("fees_btc"), by_date()
    return (
        daily.withColumn("fees_ma30", series.rolling_mean(fees, w, n))
        .withColumn("fees_std30", series.rolling_std(fees, w, n))
        .withColumn("fees_zscore", zscore(fees, F.col("fees_ma30"), F.col("fees_std30")))
    )


def with_price_zscore(daily: DataFrame, n: int = Z_DAYS) -> DataFrame:
    price, w = F.col("btc_price"), by_date()
    return (
        daily.withColumn("price_ma30", series.rolling_mean(price, w, n))
        .withColumn("price_std30", series.rolling_std(price, w, n))
        .withColumn("price_zscore", zscore(price, F.col("price_ma30"), F.col("price_std30")))
    )


def momentum(daily: DataFrame) -> DataFrame:
    """Fee z-score with its regime label."""
    return with_fee_zscore(daily).withColumn("regime", band_regime(F.col("fees_zscore")))


def prices_with_fees(prices: DataFrame, fees: DataFrame) -> DataFrame:
    """Daily candles with that day's fees; a day without blocks has zero fees."""
    return (
        prices.join(fees.select("date", "fees_btc"), "date", "left")
        .withColumn("fees_btc", F.coalesce("fees_btc", F.lit(0.0)))
        .filter(F.col("btc_price") > 0)
    )


def divergence(joined: DataFrame) -> DataFrame:
    """Fee against price momentum with the smoothed lines."""
    w = by_date()
    return (
        with_price_zscore(with_fee_zscore(joined))
        .withColumn("divergence", F.col("fees_zscore") - F.col("price_zscore"))
        .withColumn("regime", band_regime(F.col("fees_zscore")))
        .withColumn("fees_zscore_ma7", series.centered_mean(F.col("fees_zscore"), w, 7))
        .withColumn("price_zscore_ma7", series.rolling_mean(F.col("price_zscore"), w, 7))
        .withColumn("divergence_ma30", series.rolling_mean(F.col("divergence"), w, 30))
    )


def centered_averages(daily: DataFrame) -> DataFrame:
    w = by_date()
    return (
        daily.withColumn("ma7", series.centered_mean(F.col("fees_btc"), w, 7))
        .withColumn("ma30", series.centered_mean(F.col("fees_btc"), w, 30))
    )


def since_years_before_last(daily: DataFrame, years: int = 2) -> DataFrame:
    """Rows of the last calendar years before the newest date."""
    cut = daily.agg(F.add_months(F.max("date"), -12 * years)).scalar()
    return daily.filter(F.col("date") >= cut)


def fee_summary(daily: DataFrame) -> DataFrame:
    """One row on a daily series: counts, mean, median, peak and its day, span."""
    return daily.agg(
        F.count("*").alias("days"),
        F.avg("fees_btc").alias("mean_fees"),
        F.median("fees_btc").alias("median_fees"),
        F.max("fees_btc").alias("max_fees"),
        # the earliest of equal peaks
        F.max_by("date", F.struct(F.col("fees_btc"), -F.unix_date("date"))).alias("max_date"),
        F.sum("fee_units").alias("total_units"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def live_zscore(blocks: DataFrame, date: Column, fee: Column, today: Column, days: int = 30) -> DataFrame:
    """Today's mean block fee against the trailing window, one pass, 0 when undefined.

    The window counts back ``days`` days and includes today.
    """
    in_window = date >= F.date_sub(today, days)
    one = blocks.filter(in_window & (date <= today)).agg(
        F.avg(F.when(date == today, fee)).alias("avg_today"),
        F.avg(fee).alias("avg_window"),
        F.stddev_pop(fee).alias("std_window"),
    )
    z = ratio(F.col("avg_today") - F.col("avg_window"), F.col("std_window"))
    return one.withColumn("zscore", F.coalesce(z, F.lit(0.0)))


def kpi_row(metrics: DataFrame, height: Column, fee_units: Column) -> DataFrame:
    return metrics.agg(
        F.count("*").alias("blocks"),
        F.sum(fee_units).alias("total_fee_units"),
        F.max(fee_units).alias("max_fee_units"),
        F.max(height).alias("last_block"),
    )
