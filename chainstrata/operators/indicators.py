"""Technical indicators and the feature matrix of the bar model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from chainstrata.functions.bins import step_regime
from chainstrata.functions.calendar import calendar_parts
from chainstrata.functions.ratios import EPSILON, ratio
from chainstrata.operators import series
from chainstrata.session import materialized

# Fixed value: model inputs, in model order.
FEATURES = (
    "return_tf", "return_4tf", "return_24tf",
    "volatility_4tf", "volatility_24tf",
    "volume_ratio",
    "range_pct", "close_position",
    "momentum_4tf", "momentum_24tf",
    "rsi_14", "macd", "macd_hist", "bb_position", "bb_width",
    "atr_pct", "sma_cross",
    "funding_rate", "funding_signal",
    "fees_zscore", "fees_zscore_ma7", "fees_zscore_change", "zscore_regime",
    "hour", "minute", "day_of_week", "is_weekend",
)

# Rows of history an indicator can depend on. The smoothing weights of the
# longest span fall below 1e-23 within this many rows.
SIMPLE_BACK = 64
SMOOTHED_BACK = 704


def over_bars(part: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*part).orderBy("open_time")


def on_bars(bars: DataFrame, compute, back: int = SIMPLE_BACK, ahead: int = 0,
            keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Run an indicator on chunked bars: one day of bars is the numbering piece."""
    return series.chunked(bars, keys, "open_time", F.to_date("open_time"), compute, back, ahead)


def with_next_up(df: DataFrame, part: Sequence[str]) -> DataFrame:
    """1 if the next bar closes higher; the last bar gets 0. Needs one row ahead."""
    close = F.col("close")
    higher = F.lead(close).over(over_bars(part)) > close
    return df.withColumn("target", F.coalesce(higher, F.lit(False)).cast("int"))


def with_returns(df: DataFrame, part: Sequence[str]) -> DataFrame:
    w, close = over_bars(part), F.col("close")
    out = df.withColumns({
        "return_tf": series.pct_change(close, w, 1),
        "return_4tf": series.pct_change(close, w, 4),
        "return_24tf": series.pct_change(close, w, 24),
        "log_return": series.log_return(close, w),
        "momentum_4tf": series.difference(close, w, 4),
        "momentum_24tf": series.difference(close, w, 24),
    })
    step = F.col("log_return")
    return out.withColumns({
        "volatility_4tf": series.rolling_std(step, w, 4),
        "volatility_24tf": series.rolling_std(step, w, 24),
    })


def with_volume_ratio(df: DataFrame, part: Sequence[str]) -> DataFrame:
    w = over_bars(part)
    return df.withColumn("volume_ma24", series.rolling_mean(F.col("volume"), w, 24)).withColumn(
        "volume_ratio", ratio(F.col("volume"), F.col("volume_ma24")))


def with_bar_shape(df: DataFrame, part: Sequence[str] = ()) -> DataFrame:
    span = F.col("high") - F.col("low")
    return df.withColumns({
        "range_pct": ratio(span, F.col("open")) * 100,
        "close_position": ratio(F.col("close") - F.col("low"), span + EPSILON),
    })


def with_rsi(df: DataFrame, part: Sequence[str], n: int = 14) -> DataFrame:
    """Relative strength from simple means; the first row counts as no move."""
    w = over_bars(part)
    step = F.coalesce(series.difference(F.col("close"), w), F.lit(0.0))
    gain = series.rolling_mean(F.greatest(F.col("_step"), F.lit(0.0)), w, n)
    loss = series.rolling_mean(F.greatest(-F.col("_step"), F.lit(0.0)), w, n)
    return df.withColumn("_step", step).withColumn(
        "rsi_14", F.lit(100.0) - F.lit(100.0) / (1 + gain / (loss + EPSILON))).drop("_step")


def with_macd(df: DataFrame, part: Sequence[str]) -> DataFrame:
    """Difference of the 12 and 26 row smoothings and its gap to a 9 row smoothing."""
    w, close = over_bars(part), F.col("close")
    out = df.withColumn("macd", series.exponential_mean(close, w, 12) - series.exponential_mean(close, w, 26))
    return out.withColumn("macd_hist", F.col("macd") - series.exponential_mean(F.col("macd"), w, 9))


def with_bollinger(df: DataFrame, part: Sequence[str], n: int = 20) -> DataFrame:
    w, close = over_bars(part), F.col("close")
    out = df.withColumn("bb_middle", series.rolling_mean(close, w, n)).withColumn("_sd", series.rolling_std(close, w, n))
    band = 4 * F.col("_sd")
    return out.withColumns({
        "bb_position": ratio(close - (F.col("bb_middle") - band / 2), band + EPSILON),
        "bb_width": ratio(band, F.col("bb_middle")),
    }).drop("_sd")


def with_atr(df: DataFrame, part: Sequence[str], n: int = 14) -> DataFrame:
    """Mean true range in percent of the close; undefined on the first row."""
    w = over_bars(part)
    last = F.lag("close").over(w)
    widest = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - last), F.abs(F.col("low") - last))
    out = df.withColumn("_tr", F.when(last.isNotNull(), widest))
    return out.withColumn("atr_pct", ratio(series.rolling_mean(F.col("_tr"), w, n), F.col("close")) * 100).drop("_tr")


def with_sma_cross(df: DataFrame, part: Sequence[str]) -> DataFrame:
    w, close = over_bars(part), F.col("close")
    out = df.withColumn("sma_10", series.rolling_mean(close, w, 10)).withColumn("sma_50", series.rolling_mean(close, w, 50))
    above = F.coalesce(F.col("sma_10") > F.col("sma_50"), F.lit(False))
    return out.withColumn("sma_cross", above.cast("int"))


def with_fee_signal(df: DataFrame, part: Sequence[str]) -> DataFrame:
    w, z = over_bars(part), F.col("fees_zscore")
    return df.withColumns({
        "fees_zscore_ma7": series.rolling_mean(z, w, 7),
        "fees_zscore_change": series.difference(z, w),
        "zscore_regime": step_regime(z),
    })


def with_funding(df: DataFrame) -> DataFrame:
    rate = F.col("funding_rate") if "funding_rate" in df.columns else F.lit(0.0)
    return df.withColumns({"funding_rate": rate, "funding_signal": F.lit(0)})


def with_daily_zscore(bars: DataFrame, daily: DataFrame, lag_days: int = 0) -> DataFrame:
    """Attach the day's fee z-score, 0 where it is undefined.

    ``lag_days=0`` uses the same day's full total, which the bar could not know
    yet; 1 uses the day before and has no look-ahead. Stores the daily scores
    first (an action).
    """
    by_day = daily.filter("fees_zscore is not null").select(
        F.date_add("date", lag_days).alias("_day"), "fees_zscore")
    return (
        bars.withColumn("_day", F.to_date("open_time"))
        .join(materialized(by_day, "daily-scores"), "_day", "left").drop("_day")
        .withColumn("fees_zscore", F.coalesce("fees_zscore", F.lit(0.0)))
    )


def with_all_features(df: DataFrame, part: Sequence[str]) -> DataFrame:
    """Every model input and the label. All windows share one sort of the chunk."""
    for step in (with_next_up, with_returns, with_volume_ratio, with_bar_shape, with_rsi, with_macd,
                 with_bollinger, with_atr, with_sma_cross, with_fee_signal):
        df = step(df, part)
    return with_funding(df).withColumns(calendar_parts(F.col("open_time")))


def feature_matrix(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Model inputs per bar with complete history only."""
    full = on_bars(bars, with_all_features, back=SMOOTHED_BACK, ahead=1, keys=keys)
    needed = [*FEATURES, "log_return", "bb_middle", "sma_50", "volume_ma24"]
    return full.dropna(subset=needed)


def last_bars(bars: DataFrame, n: int = 200) -> DataFrame:
    """The newest ``n`` bars in time order."""
    return bars.orderBy(F.desc("open_time")).limit(n).orderBy("open_time")
