"""The given tables in the roles of the ledger's tables.

orders: blocks and daily fees (height = days since 1995-01-01, money in cents).
lineitem: outputs; an outpoint with a line of status F counts as spent.
events: price ticks, one symbol per event type; users act as holders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chainstrata.functions import money
from chainstrata.operators import candles, fees
from chainstrata.session import materialized

START = dt.date(1995, 1, 1)
LAUNCH = dt.date(1995, 1, 1)
# Moves order dates into the month the events cover.
DAYS_TO_EVENTS = 8217
HEIGHT_SCALE = 400
TIP = 1_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def height_of(ts: Column) -> Column:
    return F.datediff(ts, F.lit(START)).cast("bigint")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders")


def daily_fees(spark: SparkSession, sf: str, units_per_coin: float = 100.0) -> DataFrame:
    launched = orders(spark, sf).filter(F.col("o_orderdate") >= F.lit(LAUNCH).cast("timestamp_ntz"))
    return fees.daily_fees(launched, F.to_date("o_orderdate"), money.cents(F.col("o_totalprice")), units_per_coin)


def daily_prices(spark: SparkSession, sf: str) -> DataFrame:
    """A price and a volume per shipping day."""
    return (
        table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"))
        .agg(F.sum(money.cents(F.col("l_extendedprice"))).alias("_cents"), F.count("*").alias("_n"),
             F.sum(F.col("l_quantity").cast("bigint")).alias("volume"))
        .select("date", (F.col("_cents") / F.col("_n") / 100).alias("btc_price"), "volume")
    )


def txid(key: Column) -> Column:
    return F.md5(key.cast("string"))


def utxo_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every line creates an output; a line of status F also spends its outpoint."""
    lines = table(spark, sf, "lineitem")
    supplier = F.col("l_suppkey")
    family = F.when(supplier % 3 == 0, "1").when(supplier % 3 == 1, "3").otherwise("bc1")
    base = [
        height_of(F.col("l_shipdate")).alias("height"),
        txid(F.col("l_orderkey")).alias("outpoint_txid"),
        F.col("l_linenumber").cast("bigint").alias("outpoint_vout"),
    ]
    made = lines.select(
        F.lit("create").alias("event_type"), *base,
        money.cents(F.col("l_extendedprice")).alias("value_sats"),
        F.col("l_returnflag").alias("scriptPubKey_type"),
        F.when(F.col("l_returnflag") != "N", F.concat(family, supplier.cast("string"))).alias("address"),
    )
    used = lines.filter("l_linestatus = 'F'").select(
        F.lit("spend").alias("event_type"), *base,
        F.lit(0).cast("bigint").alias("value_sats"),
        F.lit(None).cast("string").alias("scriptPubKey_type"),
        F.lit(None).cast("string").alias("address"),
    )
    return made.unionByName(used)


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Events as one-trade candles."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    price = F.col("value")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), F.col("ts").alias("open_time"), "event_id", "user_id",
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
        k.cast("double").alias("volume"), (price * k).alias("quote_volume"), k.alias("trades"),
    )


def bars(spark: SparkSession, sf: str, bar: str = "1h") -> DataFrame:
    return candles.resample(ticks(spark, sf), bar, tie="event_id")


def stored_bars(spark: SparkSession, sf: str, bar: str = "1h") -> DataFrame:
    """Bars as a stored table: indicators read them twice, the ticks are read once."""
    return materialized(bars(spark, sf, bar), "bars")


def shifted_zscores(spark: SparkSession, sf: str) -> DataFrame:
    daily = fees.with_fee_zscore(daily_fees(spark, sf))
    return daily.select(F.date_add("date", DAYS_TO_EVENTS).alias("date"), "fees_zscore")


# The same roles in SQL.
DAILY = """daily AS (
  SELECT date, fee_units, num_blocks, fee_units / 1e2 AS fees_btc FROM (
    SELECT CAST(o_orderdate AS DATE) AS date, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS fee_units,
           count(*) AS num_blocks
    FROM orders WHERE o_orderdate >= DATE '1995-01-01' GROUP BY 1))"""

ZSCORES = DAILY + """,
fee_windows AS (
  SELECT *, CASE WHEN count(fees_btc) OVER w = 30 THEN avg(fees_btc) OVER w END AS fees_ma30,
         CASE WHEN count(fees_btc) OVER w = 30 THEN stddev_samp(fees_btc) OVER w END AS fees_std30
  FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
momentum AS (
  SELECT *, CASE WHEN fees_zscore > 1.5 THEN 'elevated' WHEN fees_zscore < -1.5 THEN 'depressed' ELSE 'normal' END AS regime
  FROM (SELECT *, (fees_btc - fees_ma30) / nullif(fees_std30, 0) AS fees_zscore FROM fee_windows))"""

PRICES = """prices AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS btc_price,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1)"""

JOINED = DAILY + ", " + PRICES + """,
joined AS (
  SELECT p.date, p.btc_price, p.volume, coalesce(d.fees_btc, 0) AS fees_btc
  FROM prices p LEFT JOIN daily d ON p.date = d.date WHERE p.btc_price > 0),
joined_windows AS (
  SELECT *, CASE WHEN count(fees_btc) OVER w = 30 THEN avg(fees_btc) OVER w END AS fees_ma30,
         CASE WHEN count(fees_btc) OVER w = 30 THEN stddev_samp(fees_btc) OVER w END AS fees_std30,
         CASE WHEN count(btc_price) OVER w = 30 THEN avg(btc_price) OVER w END AS price_ma30,
         CASE WHEN count(btc_price) OVER w = 30 THEN stddev_samp(btc_price) OVER w END AS price_std30
  FROM joined WINDOW w AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
scored AS (
  SELECT *, fees_zscore - price_zscore AS divergence,
         CASE WHEN fees_zscore > 1.5 THEN 'elevated' WHEN fees_zscore < -1.5 THEN 'depressed' ELSE 'normal' END AS regime
  FROM (SELECT *, (fees_btc - fees_ma30) / nullif(fees_std30, 0) AS fees_zscore,
               (btc_price - price_ma30) / nullif(price_std30, 0) AS price_zscore FROM joined_windows))"""

CREATES = """creates AS (
  SELECT md5(CAST(l_orderkey AS VARCHAR)) AS txid, CAST(l_linenumber AS BIGINT) AS vout,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS value_sats, l_returnflag AS script_type,
         coalesce(CASE WHEN l_returnflag <> 'N' THEN
           CASE l_suppkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '3' ELSE 'bc1' END || l_suppkey END,
           md5(CAST(l_orderkey AS VARCHAR)) || ':' || l_linenumber) AS address,
         CAST(CAST(l_shipdate AS DATE) - DATE '1995-01-01' AS BIGINT) AS height
  FROM lineitem),
spends AS (
  SELECT md5(CAST(l_orderkey AS VARCHAR)) AS txid, CAST(l_linenumber AS BIGINT) AS vout,
         CAST(CAST(l_shipdate AS DATE) - DATE '1995-01-01' AS BIGINT) AS height
  FROM lineitem WHERE l_linestatus = 'F')"""

UNSPENT = CREATES + """,
unspent AS (
  SELECT txid, vout, address, value_sats, height FROM (
    SELECT *, row_number() OVER (PARTITION BY txid, vout ORDER BY height, value_sats, address) AS rn FROM creates c
    WHERE NOT EXISTS (SELECT 1 FROM spends s WHERE s.txid = c.txid AND s.vout = c.vout))
  WHERE rn = 1)"""

BALANCES = UNSPENT + """,
balances AS (
  SELECT address, CAST(sum(value_sats) AS BIGINT) AS balance_sats, max(height) AS last_seen_height
  FROM unspent GROUP BY 1)"""

TICKS = """ticks AS (
  SELECT event_type AS symbol, ts AS open_time, event_id, user_id, value AS price,
         CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events)"""


def bars_sql(interval: str) -> str:
    return TICKS + f""",
bars AS (
  SELECT symbol, time_bucket(INTERVAL '{interval}', open_time, TIMESTAMP '2000-01-01') AS open_time,
         arg_min(price, (open_time, event_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (open_time, event_id)) AS close, CAST(sum(k) AS DOUBLE) AS volume,
         sum(price * k) AS quote_volume, CAST(sum(k) AS BIGINT) AS trades, count(*) AS num_candles
  FROM ticks GROUP BY 1, 2)"""
