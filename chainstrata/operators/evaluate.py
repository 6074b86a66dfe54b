"""Walk-forward evaluation: periods, folds, trade results, period metrics."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.functions.ratios import MIN_CONFIDENCE, ratio


@dataclass(frozen=True)
class Period:
    """A training span and the test span that follows; both half-open, in dates."""

    name: str
    train_start: str
    train_end: str
    test_start: str
    test_end: str


# The twelve published periods and the trade rules.
HALF_YEARS = (
    Period("H2 2019", "2019-01-01", "2019-06-30", "2019-07-01", "2019-12-31"),
    Period("H1 2020", "2019-07-01", "2019-12-31", "2020-01-01", "2020-06-30"),
    Period("H2 2020", "2020-01-01", "2020-06-30", "2020-07-01", "2020-12-31"),
    Period("H1 2021", "2020-07-01", "2020-12-31", "2021-01-01", "2021-06-30"),
    Period("H2 2021", "2021-01-01", "2021-06-30", "2021-07-01", "2021-12-31"),
    Period("H1 2022", "2021-07-01", "2021-12-31", "2022-01-01", "2022-06-30"),
    Period("H2 2022", "2022-01-01", "2022-06-30", "2022-07-01", "2022-12-31"),
    Period("H1 2023", "2022-07-01", "2022-12-31", "2023-01-01", "2023-06-30"),
    Period("H2 2023", "2023-01-01", "2023-06-30", "2023-07-01", "2023-12-31"),
    Period("H1 2024", "2023-07-01", "2023-12-31", "2024-01-01", "2024-06-30"),
    Period("H2 2024", "2024-01-01", "2024-06-30", "2024-07-01", "2024-12-31"),
    Period("H1 2025", "2024-07-01", "2024-12-31", "2025-01-01", "2025-06-30"),
)
TAKE_PROFIT = 0.005
STOP_LOSS = 0.002
POSITION_SIZE = 0.02
Z_FLOOR = -1.0
INITIAL_CAPITAL = 10_000.0
SHARPE_DAYS = 252
FOLDS = 5


def with_periods(bars: DataFrame, periods: Sequence[Period] = HALF_YEARS) -> DataFrame:
    """One row per bar, period and role (train or test) it falls in.

    The handful of periods rides along as a constant, so a range match needs no join.
    """
    spans = [
        F.struct(F.lit(p.name).alias("period"), F.lit(role).alias("role"),
                 F.lit(dt.datetime.fromisoformat(a)).cast("timestamp_ntz").alias("a"),
                 F.lit(dt.datetime.fromisoformat(b)).cast("timestamp_ntz").alias("b"))
        for p in periods
        for role, a, b in (("train", p.train_start, p.train_end), ("test", p.test_start, p.test_end))
    ]
    ts = F.col("open_time").cast("timestamp_ntz")
    hits = F.filter(F.array(*spans), lambda s: (ts >= s["a"]) & (ts < s["b"]))
    return (
        bars.withColumn("_span", F.explode(hits))
        .withColumns({"period": F.col("_span.period"), "role": F.col("_span.role")})
        .drop("_span")
    )


def time_folds(daily: DataFrame, order: str, k: int = FOLDS) -> DataFrame:
    """Expanding folds: fold f trains on all rows before its test block of n div (k+1) rows."""
    w = Window.partitionBy()
    at = F.row_number().over(w.orderBy(order)) - 1
    rows = daily.withColumn("_at", at).withColumn("_n", F.count("*").over(w))
    size = F.floor(F.col("_n") / (k + 1))
    folds = rows.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(k))))
    start = F.col("_n") - (k + 1 - F.col("fold")) * size
    role = F.when(F.col("_at") < start, "train").when(F.col("_at") < start + size, "test")
    return folds.withColumn("role", role).filter("role is not null").drop("_at", "_n")


def trades(scored: DataFrame, keys: Sequence[str] = ("symbol", "period"),
           min_confidence: float = MIN_CONFIDENCE, z_floor: float = Z_FLOOR) -> DataFrame:
    """Result of entering at each confident bar and leaving at the next one.

    Gains are capped at the profit target and losses at the stop. The last bar
    of a period has no exit and gives no trade.
    """
    w = Window.partitionBy(*keys).orderBy("open_time")
    close, after = F.col("close"), F.col("_next")
    size = F.abs(ratio(after - close, close))
    result = F.when(after > close, F.least(size, F.lit(TAKE_PROFIT))).otherwise(-F.least(size, F.lit(STOP_LOSS)))
    return (
        scored.withColumn("_next", F.lead("close").over(w))
        .filter((F.col("probability") >= min_confidence) & (F.col("fees_zscore") > z_floor) & after.isNotNull())
        .withColumn("pnl_pct", result)
        .filter("pnl_pct is not null")
        .drop("_next")
    )


def equity(done: DataFrame, keys: Sequence[str] = ("symbol", "period"), size: float = POSITION_SIZE,
           piece: Column | None = None) -> DataFrame:
    """Capital after each trade and its distance from the highest capital so far.

    The running product is a sum of logs. Trades are scanned in pieces (by default
    days; ``piece`` must not fall as time goes on), and a piece passes on the pair
    (sum of logs, highest running sum), which combines associatively. So a dominant
    symbol is spread over as many tasks as it has pieces, and only the pairs, one row
    a piece, are scanned per symbol and period.
    """
    keys = list(keys)
    step = F.log1p(F.col("pnl_pct") * size)
    inside = Window.partitionBy(*keys, "_piece").orderBy("open_time").rowsBetween(Window.unboundedPreceding, 0)
    scanned = (
        done.withColumn("_piece", F.to_date("open_time") if piece is None else piece)
        .withColumn("_sum", F.sum(step).over(inside)).withColumn("_high", F.max("_sum").over(inside))
    )
    before = Window.partitionBy(*[f"_key_{k}" for k in keys]).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    pairs = scanned.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_piece").alias("_at")).agg(
        F.sum(step).alias("_total"), F.max("_sum").alias("_top"))
    started = pairs.withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0.0)))
    carried = started.withColumn("_peak", F.greatest(F.max(F.col("_start") + F.col("_top")).over(before), F.lit(0.0)))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys] + [F.col("_piece") == F.col("_at")]
    joined = scanned.join(carried.drop("_total", "_top"), same)
    peak = F.lit(INITIAL_CAPITAL) * F.exp(F.greatest("_peak", F.col("_start") + F.col("_high")))
    return (
        joined.withColumn("capital", F.lit(INITIAL_CAPITAL) * F.exp(F.col("_start") + F.col("_sum")))
        .withColumn("drawdown", (F.col("capital") - peak) / peak)
        .select(*done.columns, "capital", "drawdown")
    )


def period_metrics(curve: DataFrame, keys: Sequence[str] = ("symbol", "period"), size: float = POSITION_SIZE) -> DataFrame:
    """Trades, return, win rate, profit factor, Sharpe and worst drawdown per period."""
    pnl = F.col("pnl_pct")
    step = F.when(pnl != 0, pnl * size)
    gained = F.coalesce(F.sum(F.when(pnl > 0, pnl)), F.lit(0.0))
    lost = F.coalesce(-F.sum(F.when(pnl < 0, pnl)), F.lit(0.0))
    spread = F.stddev_pop(step)
    sharpe = F.when((F.count("*") >= 2) & (spread > 0), F.avg(step) / spread * math.sqrt(SHARPE_DAYS))
    return curve.groupBy(*keys).agg(
        F.count("*").alias("trades"),
        (F.exp(F.sum(F.log1p(pnl * size))) - 1).alias("total_return"),
        (F.count_if(pnl > 0) / F.count("*")).alias("win_rate"),
        F.when(lost > 0, gained / lost).otherwise(F.lit(math.inf)).alias("profit_factor"),
        F.coalesce(sharpe, F.lit(0.0)).alias("sharpe"),
        F.abs(F.least(F.min("drawdown"), F.lit(0.0))).alias("max_drawdown"),
    )


def regression_metrics(predictions: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Mean absolute error and R2. R2 = 1 - error sum / spread sum, from moments of one pass."""
    error = F.col(actual) - F.col(predicted)
    spread = F.var_pop(actual) * F.count("*")
    return predictions.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
    )


def residual_summary(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return predictions.agg(F.avg(error).alias("mean_residual"), F.stddev_pop(error).alias("std_residual"),
                           F.count("*").alias("n"))
