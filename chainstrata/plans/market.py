"""Bars, indicators, features, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainstrata.functions import ratios
from chainstrata.operators import candles, evaluate, indicators
from chainstrata.operators.evaluate import Period
from chainstrata.plans import standins as t
from chainstrata.plans.registry import present, query, r
from chainstrata.session import scratch_path
from chainstrata.sources import tables

OHLCV = f"""symbol, CAST(open_time AS VARCHAR) AS open_time, open, high, low, close, volume,
  {r('quote_volume', 3)} AS quote_volume, trades, num_candles FROM bars"""


@query(f"WITH {t.bars_sql('1 day')} SELECT {OHLCV}")
def ohlcv_1d(spark: SparkSession, sf: str) -> DataFrame:
    return present(t.bars(spark, sf, "1d"), quote_volume=3)


@query(f"WITH {t.bars_sql('5 minutes')} SELECT {OHLCV}")
def ohlcv_5m(spark: SparkSession, sf: str) -> DataFrame:
    return present(t.bars(spark, sf, "5m"), quote_volume=3)


@query(f"""WITH {t.bars_sql('5 minutes')}, {t.ZSCORES},
  fine AS (SELECT b.*, coalesce(m.fees_zscore, 0) AS z FROM bars b LEFT JOIN momentum m ON m.date + 8217 = CAST(b.open_time AS DATE))
  SELECT symbol, CAST(time_bucket(INTERVAL '4 hours', open_time, TIMESTAMP '2000-01-01') AS VARCHAR) AS open_time, arg_min(open, open_time) AS open,
    max(high) AS high, min(low) AS low, arg_max(close, open_time) AS close, sum(volume) AS volume, {r('sum(quote_volume)', 3)} AS quote_volume,
    CAST(sum(trades) AS BIGINT) AS trades, count(*) AS num_candles, {r('arg_max(z, open_time)')} AS fees_zscore
  FROM fine GROUP BY symbol, time_bucket(INTERVAL '4 hours', open_time, TIMESTAMP '2000-01-01')""")
def ohlcv_with_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """Fine bars, each with its day's fee z-score, to longer bars that keep the last score."""
    fine = indicators.with_daily_zscore(t.bars(spark, sf, "5m"), t.shifted_zscores(spark, sf))
    return present(candles.resample(fine.drop("num_candles"), "4h", extra_last=["fees_zscore"]), quote_volume=3)


def _window(rows: int) -> str:
    return f"(PARTITION BY symbol ORDER BY open_time ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _mean(x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {_window(n)} = {n} THEN avg({x}) OVER {_window(n)} END"


def _std(x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {_window(n)} = {n} THEN stddev_samp({x}) OVER {_window(n)} END"


def _lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) OVER (PARTITION BY symbol ORDER BY open_time)"


LOG_RETURN = f"ln(nullif(close / nullif({_lag('close')}, 0), 0))"


@query(f"""WITH {t.bars_sql('4 hours')}, m AS (SELECT *, close / nullif({_lag('close')}, 0) - 1 AS return_daily, {LOG_RETURN} AS log_return FROM bars),
  v AS (SELECT *, {_std('log_return', 30)} AS sd FROM m)
  SELECT symbol, CAST(open_time AS VARCHAR) AS open_time, {r('return_daily')} AS return_daily, {r('log_return')} AS log_return,
  {r('sd * sqrt(365)')} AS volatility_30d, {r('(high - low) / nullif(open, 0) * 100')} AS range_pct,
  {r('CASE WHEN volume > 0 THEN quote_volume / volume ELSE 0 END')} AS vwap FROM v""")
def candle_returns_vol(spark: SparkSession, sf: str) -> DataFrame:
    """Daily-bar measures, here on four-hour bars so that the 30-row window fills."""
    out = candles.daily_measures(t.bars(spark, sf, "4h"), order="open_time")
    return present(out.select("symbol", "open_time", "return_daily", "log_return", "volatility_30d", "range_pct", "vwap"))


HOURLY = t.bars_sql("1 hour")
KEY = "symbol, CAST(open_time AS VARCHAR) AS open_time"


def _hourly(spark: SparkSession, sf: str, compute, *columns: str, back: int = indicators.SIMPLE_BACK) -> DataFrame:
    out = indicators.on_bars(t.stored_bars(spark, sf), compute, back)
    return present(out.select("symbol", "open_time", *columns))


RSI = f"""steps AS (SELECT *, coalesce(close - {_lag('close')}, 0) AS step FROM bars),
rsi AS (SELECT *, 100 - 100 / (1 + gain / (loss + 1e-9)) AS rsi_14 FROM (
  SELECT *, {_mean('greatest(step, 0)', 14)} AS gain, {_mean('greatest(-step, 0)', 14)} AS loss FROM steps))"""


@query(f"WITH {HOURLY}, {RSI} SELECT {KEY}, {r('rsi_14')} AS rsi_14 FROM rsi")
def rsi_14(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(spark, sf, indicators.with_rsi, "rsi_14")


BANDS = f"""bands AS (SELECT *, {_mean('close', 20)} AS bb_middle, {_std('close', 20)} AS bb_sd FROM bars)"""


@query(f"""WITH {HOURLY}, {BANDS} SELECT {KEY}, {r('bb_middle')} AS bb_middle,
  {r('(close - (bb_middle - 2 * bb_sd)) / (4 * bb_sd + 1e-9)')} AS bb_position, {r('4 * bb_sd / nullif(bb_middle, 0)')} AS bb_width FROM bands""")
def bollinger(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(spark, sf, indicators.with_bollinger, "bb_middle", "bb_position", "bb_width")


RANGES = f"""ranges AS (SELECT *, CASE WHEN {_lag('close')} IS NOT NULL THEN
  greatest(high - low, abs(high - {_lag('close')}), abs(low - {_lag('close')})) END AS tr FROM bars)"""


@query(f"WITH {HOURLY}, {RANGES} SELECT {KEY}, {r('(' + _mean('tr', 14) + ') / nullif(close, 0) * 100', 5)} AS atr_pct FROM ranges")
def atr_pct(spark: SparkSession, sf: str) -> DataFrame:
    out = indicators.on_bars(t.stored_bars(spark, sf), indicators.with_atr)
    return present(out.select("symbol", "open_time", "atr_pct"), 5)


@query(f"""WITH {HOURLY}, s AS (SELECT *, {_mean('close', 10)} AS sma_10, {_mean('close', 50)} AS sma_50 FROM bars)
  SELECT {KEY}, {r('sma_10')} AS sma_10, {r('sma_50')} AS sma_50, CAST(coalesce(sma_10 > sma_50, false) AS BIGINT) AS sma_cross FROM s""")
def sma_cross(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly(spark, sf, indicators.with_sma_cross, "sma_10", "sma_50", "sma_cross")


@query(f"""WITH {HOURLY}, v AS (SELECT *, {_mean('volume', 24)} AS volume_ma24 FROM bars)
  SELECT {KEY}, {r('volume_ma24')} AS volume_ma24, {r('volume / nullif(volume_ma24, 0)', 8)} AS volume_ratio FROM v""")
def volume_ratio(spark: SparkSession, sf: str) -> DataFrame:
    out = indicators.on_bars(t.stored_bars(spark, sf), indicators.with_volume_ratio)
    return present(out.select("symbol", "open_time", "volume_ma24", "volume_ratio"), volume_ratio=8)


MACD = """numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS rn FROM bars),
smooth AS (
  SELECT symbol, open_time, rn, close AS ema12, close AS ema26, 0e0 AS signal FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.open_time, n.rn, s.ema12 + 2e0 / 13 * (n.close - s.ema12), s.ema26 + 2e0 / 27 * (n.close - s.ema26),
    s.signal + 2e0 / 10 * ((s.ema12 + 2e0 / 13 * (n.close - s.ema12)) - (s.ema26 + 2e0 / 27 * (n.close - s.ema26)) - s.signal)
  FROM smooth s JOIN numbered n ON n.symbol = s.symbol AND n.rn = s.rn + 1)"""


@query(f"""WITH RECURSIVE {HOURLY}, {MACD} SELECT {KEY}, {r('ema12 - ema26', 5)} AS macd, {r('ema12 - ema26 - signal', 5)} AS macd_hist FROM smooth""")
def macd(spark: SparkSession, sf: str) -> DataFrame:
    out = indicators.on_bars(t.stored_bars(spark, sf), indicators.with_macd, indicators.SMOOTHED_BACK)
    return present(out.select("symbol", "open_time", "macd", "macd_hist"), 5)


def _bars_with_z(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.with_daily_zscore(t.stored_bars(spark, sf), t.shifted_zscores(spark, sf))


Z_BARS = f"""{HOURLY}, {t.ZSCORES},
zbars AS (SELECT b.*, coalesce(m.fees_zscore, 0) AS fees_zscore FROM bars b
  LEFT JOIN momentum m ON m.date + 8217 = CAST(b.open_time AS DATE))"""

FEATURES = f"""{Z_BARS}, {MACD}, {RSI}, {BANDS}, {RANGES},
step AS (SELECT *, {LOG_RETURN} AS log_return FROM zbars),
f AS (SELECT z.symbol, z.open_time, z.close,
  CAST(coalesce(lead(z.close) OVER (PARTITION BY z.symbol ORDER BY z.open_time) > z.close, false) AS BIGINT) AS target,
  z.close / nullif(lag(z.close, 1) OVER w, 0) - 1 AS return_tf, z.close / nullif(lag(z.close, 4) OVER w, 0) - 1 AS return_4tf,
  z.close / nullif(lag(z.close, 24) OVER w, 0) - 1 AS return_24tf, z.log_return,
  CASE WHEN count(log_return) OVER w4 = 4 THEN stddev_samp(log_return) OVER w4 END AS volatility_4tf,
  CASE WHEN count(log_return) OVER w24 = 24 THEN stddev_samp(log_return) OVER w24 END AS volatility_24tf,
  z.volume / nullif(CASE WHEN count(z.volume) OVER w24 = 24 THEN avg(z.volume) OVER w24 END, 0) AS volume_ratio,
  (z.high - z.low) / nullif(z.open, 0) * 100 AS range_pct, (z.close - z.low) / (z.high - z.low + 1e-9) AS close_position,
  z.close - lag(z.close, 4) OVER w AS momentum_4tf, z.close - lag(z.close, 24) OVER w AS momentum_24tf,
  rsi_14, ema12 - ema26 AS macd, ema12 - ema26 - signal AS macd_hist,
  (z.close - (bb_middle - 2 * bb_sd)) / (4 * bb_sd + 1e-9) AS bb_position, 4 * bb_sd / nullif(bb_middle, 0) AS bb_width,
  CASE WHEN count(tr) OVER w14 = 14 THEN avg(tr) OVER w14 END / nullif(z.close, 0) * 100 AS atr_pct,
  CASE WHEN count(*) OVER w50 = 50 THEN avg(z.close) OVER w50 END AS sma_50,
  CAST(coalesce(CASE WHEN count(*) OVER w10 = 10 THEN avg(z.close) OVER w10 END > CASE WHEN count(*) OVER w50 = 50 THEN avg(z.close) OVER w50 END, false) AS BIGINT) AS sma_cross,
  fees_zscore, CASE WHEN count(*) OVER w7 = 7 THEN avg(fees_zscore) OVER w7 END AS fees_zscore_ma7,
  fees_zscore - lag(fees_zscore) OVER w AS fees_zscore_change,
  CASE WHEN fees_zscore > 2 THEN 2 WHEN fees_zscore > 1 THEN 1 WHEN fees_zscore < -1 THEN -1 ELSE 0 END AS zscore_regime
  FROM step z JOIN smooth USING (symbol, open_time) JOIN rsi USING (symbol, open_time) JOIN bands USING (symbol, open_time) JOIN ranges USING (symbol, open_time)
  WINDOW w AS (PARTITION BY z.symbol ORDER BY z.open_time), w4 AS (PARTITION BY z.symbol ORDER BY z.open_time ROWS 3 PRECEDING),
  w7 AS (PARTITION BY z.symbol ORDER BY z.open_time ROWS 6 PRECEDING), w10 AS (PARTITION BY z.symbol ORDER BY z.open_time ROWS 9 PRECEDING),
  w14 AS (PARTITION BY z.symbol ORDER BY z.open_time ROWS 13 PRECEDING), w24 AS (PARTITION BY z.symbol ORDER BY z.open_time ROWS 23 PRECEDING),
  w50 AS (PARTITION BY z.symbol ORDER BY z.open_time ROWS 49 PRECEDING))"""

MEASURES = tuple(c for c in indicators.FEATURES if c not in (
    "sma_cross", "zscore_regime", "funding_rate", "funding_signal", "hour", "minute", "day_of_week", "is_weekend"))
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in (*MEASURES, "log_return", "sma_50"))


@query(f"""WITH RECURSIVE {FEATURES} SELECT {KEY}, target, {", ".join(f"{r(c, 8 if c == 'volume_ratio' else 6)} AS {c}" for c in MEASURES)},
  sma_cross, CAST(zscore_regime AS BIGINT) AS zscore_regime, 0e0 AS funding_rate, CAST(0 AS BIGINT) AS funding_signal, hour(f.open_time) AS hour, minute(f.open_time) AS minute,
  isodow(f.open_time) - 1 AS day_of_week, CAST(isodow(f.open_time) >= 6 AS BIGINT) AS is_weekend
  FROM f WHERE {COMPLETE}""")
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    matrix = indicators.feature_matrix(_bars_with_z(spark, sf))
    return present(matrix.select("symbol", "open_time", "target", *indicators.FEATURES), volume_ratio=8)


LOADS = t.TICKS + """,
loads AS (
  SELECT symbol, open_time, event_id, price AS close, 0 AS age FROM ticks WHERE open_time < TIMESTAMP '2024-01-20'
  UNION ALL SELECT symbol, open_time, event_id, price + 1, 1 FROM ticks WHERE open_time >= TIMESTAMP '2024-01-10')"""


@query(f"""WITH {LOADS} SELECT symbol, CAST(open_time AS VARCHAR) AS open_time, {r('arg_min(close, age)', 2)} AS close,
  year(open_time) AS year, month(open_time) AS month FROM loads GROUP BY symbol, loads.open_time, event_id""")
def candle_upsert_months(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping loads; where they meet, the candle stored first stays."""
    path = scratch_path(spark, "candles")
    every = t.ticks(spark, sf).select("symbol", "open_time", "event_id", "close")
    later = every.filter("open_time >= timestamp_ntz '2024-01-10'").withColumn("close", F.col("close") + 1)
    keys = ["symbol", "open_time", "event_id"]
    tables.upsert_candles(every.filter("open_time < timestamp_ntz '2024-01-20'"), path, keys)
    tables.upsert_candles(later, path, keys)
    return present(spark.read.parquet(path).drop("event_id"), 2)


@query(f"""WITH {t.DAILY} SELECT CAST(date AS VARCHAR) AS date, fee_units, num_blocks, year(date) AS year FROM daily""")
def yearly_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "daily")
    tables.write_years(t.daily_fees(spark, sf).select("date", "fee_units", "num_blocks"), path)
    return present(spark.read.parquet(path))


@query("""SELECT event_id, CAST(ts AS VARCHAR) AS open_time, value AS close FROM events ORDER BY ts DESC, event_id DESC LIMIT 50""")
def last_n_rows(spark: SparkSession, sf: str) -> DataFrame:
    return present(indicators.last_bars(t.ticks(spark, sf).select("event_id", "open_time", "close"), 50))


@query(f"""WITH {t.TICKS} SELECT CAST(open_time AS VARCHAR) AS timestamp, price, CASE WHEN k % 100 / 1e2 >= 0.6e0 THEN 'LONG' ELSE 'WAIT' END AS signal,
  {r('k % 100 / 1e2', 2)} AS confidence, {r('k / 1e1 - 5', 2)} AS zscore, {r('price', 2)} AS rsi FROM ticks""")
def signal_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Signals appended to CSV in two runs and read back with their schema."""
    path = scratch_path(spark, "signals")
    confidence = F.col("trades") % 100 / 100
    rows = t.ticks(spark, sf).select(
        F.col("open_time").cast("string").alias("timestamp"), F.col("close").alias("price"),
        ratios.signal_label(confidence).alias("signal"), confidence.alias("confidence"),
        (F.col("trades") / 10 - 5).alias("zscore"), F.col("close").alias("rsi"))
    tables.append_signals(rows.filter("signal = 'LONG'"), path)
    tables.append_signals(rows.filter("signal = 'WAIT'"), path)
    return present(tables.read_signals(spark, path), 2)


PERIODS = (
    Period("second", "2024-01-01", "2024-01-11", "2024-01-11", "2024-01-16"),
    Period("third", "2024-01-06", "2024-01-16", "2024-01-16", "2024-01-21"),
    Period("fourth", "2024-01-11", "2024-01-21", "2024-01-21", "2024-01-26"),
    Period("fifth", "2024-01-16", "2024-01-26", "2024-01-26", "2024-01-31"),
)
SPANS = "(VALUES " + ", ".join(
    f"('{p.name}', '{role}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for p in PERIODS
    for role, a, b in (("train", p.train_start, p.train_end), ("test", p.test_start, p.test_end))
) + ") p(period, role, a, b)"


@query(f"""WITH {t.TICKS} SELECT period, role, symbol, count(*) AS n, CAST(min(open_time) AS VARCHAR) AS first_time,
  CAST(max(open_time) AS VARCHAR) AS last_time FROM ticks JOIN {SPANS} ON open_time >= a AND open_time < b GROUP BY 1, 2, 3""")
def walk_forward_periods(spark: SparkSession, sf: str) -> DataFrame:
    matched = evaluate.with_periods(t.ticks(spark, sf), PERIODS)
    return present(matched.groupBy("period", "role", "symbol").agg(
        F.count("*").alias("n"), F.min("open_time").alias("first_time"), F.max("open_time").alias("last_time")))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Test bars with a made-up but repeatable probability."""
    tests = evaluate.with_periods(_bars_with_z(spark, sf), PERIODS).filter("role = 'test'")
    return tests.withColumn("probability", (F.col("trades") * 37 % 100) / 100)


TRADES = f"""{Z_BARS},
tested AS (SELECT z.*, period, trades * 37 % 100 / 1e2 AS probability,
  lead(close) OVER (PARTITION BY symbol, period ORDER BY open_time) AS after
  FROM zbars z JOIN {SPANS} ON open_time >= a AND open_time < b WHERE role = 'test'),
done AS (SELECT * FROM (SELECT *, CASE WHEN after > close THEN least(abs((after - close) / nullif(close, 0)), 0.005e0)
    ELSE -least(abs((after - close) / nullif(close, 0)), 0.002e0) END AS pnl_pct
  FROM tested WHERE probability >= 0.6e0 AND fees_zscore > -1 AND after IS NOT NULL AND close <> 0)),
curve AS (SELECT *, 10000 * exp(sum(ln(1 + pnl_pct * 0.02e0)) OVER (PARTITION BY symbol, period ORDER BY open_time ROWS UNBOUNDED PRECEDING)) AS capital FROM done),
down AS (SELECT *, capital / greatest(max(capital) OVER (PARTITION BY symbol, period ORDER BY open_time ROWS UNBOUNDED PRECEDING), 1e4) - 1 AS drawdown FROM curve)"""


@query(f"""WITH {TRADES} SELECT symbol, period, CAST(open_time AS VARCHAR) AS open_time, {r('pnl_pct')} AS pnl_pct, {r('capital', 4)} AS capital,
  {r('drawdown')} AS drawdown FROM down""")
def signal_equity(spark: SparkSession, sf: str) -> DataFrame:
    curve = evaluate.equity(evaluate.trades(_scored(spark, sf)))
    return present(curve.select("symbol", "period", "open_time", "pnl_pct", "capital", "drawdown"), capital=4)


@query(f"""WITH {TRADES}, s AS (SELECT *, nullif(pnl_pct, 0) * 0.02e0 AS step FROM down)
  SELECT symbol, period, count(*) AS trades, {r('exp(sum(ln(1 + pnl_pct * 0.02e0))) - 1')} AS total_return,
  {r('count(*) FILTER (pnl_pct > 0) / CAST(count(*) AS DOUBLE)')} AS win_rate,
  {r('sum(pnl_pct) FILTER (pnl_pct > 0) / -sum(pnl_pct) FILTER (pnl_pct < 0)')} AS profit_factor,
  {r('CASE WHEN count(*) >= 2 AND stddev_pop(step) > 0 THEN avg(step) / stddev_pop(step) * sqrt(252) ELSE 0 END', 5)} AS sharpe,
  {r('abs(least(min(drawdown), 0))')} AS max_drawdown FROM s GROUP BY 1, 2""")
def signal_pnl_metrics(spark: SparkSession, sf: str) -> DataFrame:
    curve = evaluate.equity(evaluate.trades(_scored(spark, sf)))
    return present(evaluate.period_metrics(curve), sharpe=5)
