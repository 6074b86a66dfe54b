"""Landed feeds, incremental loads and streams. The feeds are written from the given tables."""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from chainstrata.functions.ratios import ratio
from chainstrata.operators import fees as fees_of, indicators, models, utxo
from chainstrata.plans import standins as t
from chainstrata.plans.registry import present, query, r
from chainstrata.session import materialized, scratch_path, shared_dir
from chainstrata.sources import landing, model_store, tables
from chainstrata.streaming import jobs

# Blocks a landed file holds at most, and about as many batches as the loaded tables have, however long the chain.
LANDED_ROWS = 50_000
BATCHES = 32

CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


def _raw_blocks(orders: DataFrame, height: Column) -> DataFrame:
    """An order as a landed block: one minting transaction and one that spends its output."""
    key = F.col("o_orderkey").cast("string")
    units = (F.col("o_totalprice") * 100).cast("decimal(20,0)")
    coins = (units / F.lit(100_000_000)).cast("decimal(20,8)").cast("string")
    text = lambda c: c.cast("string")
    output = lambda n, kind: F.struct(
        F.lit(n).alias("n"), coins.alias("value"),
        F.struct(F.lit(kind).alias("type"), F.concat(F.lit("0014"), F.sha1(key)).alias("hex")).alias("scriptPubKey"))
    header = dict(version=1, size=200, vsize=180, weight=720, locktime=0)
    sizes = [F.lit(v).alias(k) for k, v in header.items()]
    mint = F.struct(F.md5(key).alias("txid"), F.md5(key).alias("hash"), *sizes, F.array(F.struct(
        F.lit("00").alias("coinbase"), F.lit(None).cast("string").alias("txid"), F.lit(None).cast("int").alias("vout"),
        F.lit(7).alias("sequence"))).alias("vin"), F.array(output(0, "witness_v0_keyhash"), output(1, "nulldata")).alias("vout"))
    move = F.struct(F.md5(F.concat(key, F.lit("b"))).alias("txid"), F.md5(key).alias("hash"), *sizes, F.array(F.struct(
        F.lit(None).cast("string").alias("coinbase"), F.md5(key).alias("txid"), F.lit(0).alias("vout"),
        F.lit(8).alias("sequence"))).alias("vin"), F.array(output(0, "witness_v0_keyhash")).alias("vout"))
    block = F.struct(
        height.alias("height"), F.md5(key).alias("hash"),
        F.unix_seconds(F.to_date("o_orderdate").cast("timestamp")).alias("time"), text(F.col("o_orderstatus")).alias("bits"),
        F.lit(2).alias("nTx"), F.array(mint, move).alias("tx"))
    return orders.select(F.to_json(block).alias("value"))


def _landed_blocks(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "landed-blocks")
    _land(_raw_blocks(t.orders(spark, sf), t.height_of(F.col("o_orderdate"))), path)
    return path


def _land(blocks: DataFrame, path: str) -> None:
    """Compressed files, many enough to be read in parallel: such a file is not split."""
    (blocks.write.mode("append").option("maxRecordsPerFile", LANDED_ROWS).option("zlib.compress.level", "BEST_SPEED")
     .text(path, compression="gzip"))


@query(f"""WITH o AS (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS id, md5(o_orderkey || 'b') AS id2, {CENTS} AS sats,
    CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS BIGINT) AS height FROM orders)
  SELECT height, id AS block_hash, id AS txid, true AS is_coinbase, CAST(NULL AS VARCHAR) AS prev_txid, CAST(NULL AS BIGINT) AS prev_vout,
         CAST(2 AS BIGINT) AS vout_count, 2 * sats AS value_sats FROM o
  UNION ALL SELECT height, id, id2, false, id, 0, 1, sats FROM o""")
def flatten_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Nested blocks to flat tables; one row per transaction over all of them."""
    flat = landing.flatten_blocks(landing.read_blocks(spark, _landed_blocks(spark, sf)))
    value = flat["outputs"].groupBy("block_hash", "txid").agg(F.sum("value_sats").alias("value_sats"))
    inputs = flat["inputs"].select("block_hash", "txid", "is_coinbase", "prev_txid", "prev_vout")
    txs = flat["txs"].select("height", "block_hash", "txid", "vout_count")
    joined = txs.join(inputs, ["block_hash", "txid"]).join(value, ["block_hash", "txid"])
    return joined.select("height", "block_hash", "txid", "is_coinbase", "prev_txid", "prev_vout", "vout_count", "value_sats")


# Every 13th block is delivered again with doubled amounts, every 11th arrives late, and
# the newest tenth of the heights is rolled back.
AGAIN, LATE = "o_orderkey % 13 = 5", "o_orderkey % 11 = 3"
DELIVERED = f"""top AS (SELECT max(o_orderkey) AS top FROM orders),
o AS (SELECT {CENTS} * CASE WHEN {AGAIN} THEN 2 ELSE 1 END AS sats, o_orderkey AS height FROM orders, top WHERE o_orderkey <= top * 9 // 10)"""


def _delivered_ledger(spark: SparkSession, sf: str) -> str:
    """Orders land as blocks in overlapping deliveries; each is loaded, then the derived events follow.

    The third delivery brings late blocks and replacements of loaded ones at the
    same height; then the newest heights are rolled back, in the loaded tables only.
    """
    landed, warehouse, checkpoint = (scratch_path(spark, n) for n in ("landed-blocks", "warehouse", "ingest"))
    orders = t.orders(spark, sf)
    key, top = F.col("o_orderkey"), orders.agg(F.max("o_orderkey")).scalar()
    sources = {n: f"{warehouse}/{n}" for n in ("outputs", "inputs")}
    late, again = F.expr(LATE), F.expr(AGAIN)
    doubled = orders.filter(again).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    early = key < top * 0.55
    highest = orders.agg(F.max("o_orderkey")).first()[0]
    bottom = highest * 9 // 10
    # The blocks are small, so a batch takes many, and the number of folders does not grow with the tables.
    wide = tables.BATCH_BLOCKS * max(1, math.ceil((highest + 1) / tables.BATCH_BLOCKS / BATCHES))

    def follow() -> None:
        tables.refresh_batches(spark, sources, "outputs", f"{warehouse}/utxo_events",
                               lambda part: utxo.utxo_events(part["outputs"], part["inputs"]), row_by_row=True)

    for delivery in (orders.filter(early & ~late), orders.filter((key >= top * 0.5) & ~(early & late)),
                     orders.filter(early & late & ~again).unionByName(doubled)):
        _land(_raw_blocks(delivery, key), landed)
        jobs.ingest_blocks(spark, landed, warehouse, checkpoint, blocks=wide).awaitTermination()
        follow()
    tables.rollback_all(spark, [f"{warehouse}/{n}" for n in ("blocks", "txs", "inputs", "outputs")], bottom)
    follow()
    return warehouse


@query(f"""WITH {DELIVERED}
  SELECT height // 250 AS batch_id, 3 * count(*) AS n_outputs, CAST(3 * sum(sats) AS BIGINT) AS value_sats, count(*) AS n_spends,
         min(height) AS first_height, max(height) AS last_height FROM o GROUP BY 1""")
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Late, replaced and rolled back blocks all reach the derived events."""
    stored = spark.read.parquet(f"{_delivered_ledger(spark, sf)}/utxo_events")
    return present(stored.groupBy(tables.batch_id(F.col("height")).alias("batch_id")).agg(
        F.count_if(F.col("event_type") == "create").alias("n_outputs"), F.sum("value_sats").alias("value_sats"),
        F.count_if(F.col("event_type") == "spend").alias("n_spends"),
        F.min("height").alias("first_height"), F.max("height").alias("last_height")))


@query(f"""WITH {DELIVERED},
bits AS (SELECT height, sats, list_transform(range(160), lambda i: (CAST('0x' || substr(sha1(CAST(height AS VARCHAR)), i // 4 + 1, 1) AS INTEGER) >> (3 - i % 4)) & 1) AS b FROM o),
words AS (SELECT height, sats, [0] || list_transform(range(32), lambda i: 16 * b[5 * i + 1] + 8 * b[5 * i + 2] + 4 * b[5 * i + 3] + 2 * b[5 * i + 4] + b[5 * i + 5]) AS w FROM bits),
sums AS (SELECT height, sats, w, xor(1, list_reduce([CAST(1 AS BIGINT)] || CAST([3, 3, 0, 2, 3] || w || [0, 0, 0, 0, 0, 0] AS BIGINT[]), lambda c, v: xor(xor(xor(xor(xor(xor(
  ((c & 33554431) << 5), v), CASE WHEN (c >> 25) & 1 = 1 THEN 996825010 ELSE 0 END), CASE WHEN (c >> 26) & 1 = 1 THEN 642813549 ELSE 0 END),
  CASE WHEN (c >> 27) & 1 = 1 THEN 513874426 ELSE 0 END), CASE WHEN (c >> 28) & 1 = 1 THEN 1027748829 ELSE 0 END), CASE WHEN (c >> 29) & 1 = 1 THEN 705979059 ELSE 0 END))) AS c FROM words)
SELECT 'bc1' || list_aggregate(list_transform(w || list_transform(range(6), lambda i: CAST((c >> (5 * (5 - i))) & 31 AS INTEGER)),
  lambda x: substr('qpzry9x8gf2tvdw0s3jn54khce6mua7l', CAST(x AS INTEGER) + 1, 1)), 'string_agg', '') AS address,
  2 * sats AS balance_sats, height AS last_seen_height FROM sums""")
def landed_balances(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain: landed blocks, flat tables, events with derived addresses, unspent outputs, balances."""
    narrow = utxo.narrow_events(spark.read.parquet(f"{_delivered_ledger(spark, sf)}/utxo_events"))
    return present(utxo.balances(utxo.unspent(utxo.creates(narrow), utxo.spends(narrow))))


@query(f"""WITH {t.TICKS} SELECT CAST(date_trunc('millisecond', open_time) AS VARCHAR) AS open_time, price AS open, round(price + 1, 6) AS high, price AS low, price AS close,
  CAST(k AS DOUBLE) AS volume, CAST(date_trunc('millisecond', open_time) + INTERVAL 1 MINUTE AS VARCHAR) AS close_time,
  {r('price * k', 2)} AS quote_volume, k AS trades FROM ticks""")
def parse_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Candle responses (arrays of mixed numbers and strings) to typed rows."""
    millis = F.unix_millis(F.col("open_time").cast("timestamp"))
    quoted = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    cell = [millis.cast("string"), quoted(F.col("open")), quoted(F.col("high") + 1), quoted(F.col("low")), quoted(F.col("close")),
            quoted(F.col("volume")), (millis + 60_000).cast("string"), quoted(F.round("quote_volume", 2)), F.col("trades").cast("string")]
    body = F.concat(F.lit("[["), F.concat_ws(",", *cell), F.lit("]]"))
    path = scratch_path(spark, "candles")
    t.ticks(spark, sf).select(body.alias("value")).write.text(path)
    return present(landing.parse_candles(spark.read.text(path)), quote_volume=2)


# Ticks as the clock of a feed that counts whole minutes gives them: many share a time.
COARSE = t.TICKS.replace("ts AS open_time", "date_trunc('minute', ts) AS open_time")
FILE_ENDS = ["2024-01-09", "2024-01-17", "2024-01-25", "9999-01-01"]


def _files(rows: DataFrame, at: Column, path: str) -> None:
    """Write rows as one file per span of days, the older ones first."""
    last = "1970-01-01"
    for end in FILE_ENDS:
        span = (at >= F.lit(last).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz"))
        rows.filter(span).coalesce(1).write.mode("append").json(path)
        last = end


def _messages(spark: SparkSession, sf: str, body: Column) -> tuple[str, DataFrame]:
    """Ticks as messages (offset, value) in several files, and the stream that takes one file at a time."""
    path = scratch_path(spark, "messages")
    ticks = t.ticks(spark, sf).withColumn("open_time", F.date_trunc("minute", "open_time").cast("timestamp_ntz"))
    _files(ticks.select(F.col("event_id").alias("offset"), body.alias("value"), "open_time"), F.col("open_time"), path)
    stream = spark.readStream.schema("offset bigint, value string").option("maxFilesPerTrigger", 1).json(path)
    return path, stream


def _millis() -> Column:
    return F.unix_millis(F.col("open_time").cast("timestamp"))


def _candle_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Closed candles of the stream; every tick also sends a candle that is still open."""
    text = lambda c: F.col(c).cast("string")

    def candle(closed: bool, price: Column) -> Column:
        return F.to_json(F.struct(F.struct(
            _millis().alias("t"), *[price.cast("string").alias(c) for c in "ohlc"], text("volume").alias("v"), text("quote_volume").alias("q"),
            F.col("trades").alias("n"), F.lit(closed).alias("x"), F.col("symbol").alias("s")).alias("k")))

    body = F.explode(F.array(candle(True, F.col("close")), candle(False, F.col("close") + 1000)))
    return landing.parse_candle_messages(_messages(spark, sf, body)[1], carry=["offset"])


def _twice(spark: SparkSession, run) -> None:
    """Run a stream, lose its checkpoint, and run it again over everything."""
    for _ in range(2):
        run(scratch_path(spark, "stream-state")).awaitTermination()


@query(f"""WITH {t.bars_sql('5 minutes').replace(t.TICKS, COARSE)} SELECT symbol, CAST(open_time AS VARCHAR) AS open_time, open, high, low, close, volume,
  {r('quote_volume', 3)} AS quote_volume, trades FROM bars""")
def stream_ohlcv(spark: SparkSession, sf: str) -> DataFrame:
    """Five-minute bars from candle messages, over several micro-batches and a lost checkpoint."""
    path, bars = scratch_path(spark, "stream-bars"), jobs.bar_stream(_candle_messages(spark, sf), "5m", tie="offset")
    _twice(spark, lambda state: jobs.write_keyed(bars, path, state, ["symbol", "open_time"], "open_time", "num_candles"))
    return present(spark.read.parquet(path).drop("date", "num_candles"), quote_volume=3)


@query("""SELECT event_type AS symbol, CAST(date_trunc('minute', ts) AS VARCHAR) AS minute, CAST(date_trunc('minute', ts) AS VARCHAR) AS timestamp,
  round(arg_max(value, event_id) / 1e4, 6) AS funding_rate, arg_max(value, event_id) AS mark_price FROM events GROUP BY 1, 2""")
def stream_throttle(spark: SparkSession, sf: str) -> DataFrame:
    """Funding messages, at most one row per symbol and minute; messages of one time count by offset."""
    path = scratch_path(spark, "funding")
    body = F.to_json(F.struct(_millis().alias("E"), F.col("symbol").alias("s"), (F.col("close") / 10_000).cast("string").alias("r"),
                              F.col("close").cast("string").alias("p")))
    ticks = landing.parse_funding_messages(_messages(spark, sf, body)[1], carry=["offset"])
    kept = jobs.minute_stream(ticks, "timestamp", ["symbol"], ["funding_rate", "mark_price"], tie="offset")
    _twice(spark, lambda state: jobs.write_keyed(kept, path, state, ["symbol", "minute"], "minute", "n_ticks"))
    return present(spark.read.parquet(path).drop("date", "n_ticks"))


@query("""SELECT event_type AS symbol, CAST(date_trunc('minute', ts) AS VARCHAR) AS open_time, value AS close FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('minute', ts) DESC, event_id DESC) <= 48""")
def stream_last_bars(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 48 bars of each symbol, over several micro-batches and a lost checkpoint."""
    path, bars = scratch_path(spark, "buffer"), jobs.last_bars_stream(_candle_messages(spark, sf), tie="offset")
    _twice(spark, lambda state: jobs.write_newest(bars, path, state, ["open_time", "offset"], 48))
    return present(spark.read.parquet(path).select("symbol", "open_time", "close"))


def _bar_files(spark: SparkSession, bars: DataFrame, first_day: str) -> tuple[DataFrame, str]:
    """Stored bars before a day, and the later ones as one file per span of days."""
    stored = materialized(bars, "bars")
    day = F.lit(first_day).cast("timestamp_ntz")
    path = scratch_path(spark, "bar-files")
    _files(stored.filter(F.col("open_time") >= day), F.col("open_time"), path)
    return stored.filter(F.col("open_time") < day), path


@query()
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """The newest stored model, fitted on the first days, scores the later bars as they come, on the bars in state."""
    history, path = _bar_files(spark, indicators.with_daily_zscore(t.bars(spark, sf), t.shifted_zscores(spark, sf), lag_days=1), "2024-01-21")
    matrix = materialized(indicators.feature_matrix(history), "matrix")
    folder = f"{shared_dir(spark)}/next-bar-{models.TREES}-{model_store.fingerprint(matrix)}"
    if not model_store.versions(spark, folder):
        model_store.save_model(models.fit_classifier(matrix), folder, "2024-01-21")
    model = model_store.newest_model(spark, folder, GBTClassificationModel)
    stream = spark.readStream.schema(history.schema).option("maxFilesPerTrigger", 1).json(path)
    out = scratch_path(spark, "scores")
    jobs.score_ring(stream, history, lambda bars: models.score(model, indicators.feature_matrix(bars)), None, out,
                    scratch_path(spark, "scores-state")).awaitTermination()
    return present(spark.read.parquet(out).select("symbol", "open_time", "close", "probability", "signal"))


RANGE_BARS = 48
_SPAN = " ".join(f"WHEN open_time < TIMESTAMP '{end}' THEN {i}" for i, end in enumerate(FILE_ENDS))
_FEE_DAY = f"CAST(o_orderdate AS DATE) + {t.DAYS_TO_EVENTS}"


@query(f"""WITH {t.bars_sql('1 hour')},
ranged AS (SELECT *, CASE {_SPAN} END AS part, min(low) OVER w AS low48, max(high) OVER w AS high48, count(*) OVER w AS n
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN {RANGE_BARS - 1} PRECEDING AND CURRENT ROW)),
fees AS (SELECT {_FEE_DAY} AS day, o_totalprice AS fee FROM orders),
parts AS (SELECT * FROM (VALUES {", ".join(f"({i}, DATE '{end}')" for i, end in enumerate(FILE_ENDS))}) p(part, stop)),
today AS (SELECT part, max(day) AS day FROM parts JOIN fees ON day < stop GROUP BY 1),
z AS (SELECT part, (avg(fee) FILTER (WHERE f.day = t.day) - avg(fee)) / stddev_pop(fee) AS zscore
  FROM today t JOIN fees f ON f.day BETWEEN t.day - 30 AND t.day GROUP BY 1),
scored AS (SELECT symbol, open_time, close, (close - low48) / (high48 - low48) AS probability, zscore FROM ranged JOIN z USING (part)
  WHERE n = {RANGE_BARS} AND high48 > low48 AND open_time >= TIMESTAMP '2024-01-09')
SELECT symbol, CAST(open_time AS VARCHAR) AS open_time, close, {r('probability')} AS probability, {r('coalesce(zscore, 0)')} AS live_zscore,
  CASE WHEN probability >= 0.6 AND coalesce(zscore, 0) > 0 THEN 'LONG' ELSE 'WAIT' END AS signal FROM scored""")
def stream_live_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Signals need the live fee z-score, whose table grows between the micro-batches.

    The score is the close's place in the range of the last 48 bars, so most of what
    a new bar needs comes from earlier micro-batches.
    """
    history, path = _bar_files(spark, t.bars(spark, sf), FILE_ENDS[0])
    fee_path, out, state = (scratch_path(spark, n) for n in ("fees", "gated", "gated-state"))
    fee = t.orders(spark, sf).select(F.date_add(F.to_date("o_orderdate"), t.DAYS_TO_EVENTS).alias("day"), F.col("o_totalprice").alias("fee"))
    ends = [F.lit(e).cast("date") for e in FILE_ENDS]
    files = spark.read.schema(history.schema).json(path)

    def place(bars: DataFrame) -> DataFrame:
        w = Window.partitionBy("symbol").orderBy("open_time").rowsBetween(1 - RANGE_BARS, 0)
        low, high = F.min("low").over(w), F.max("high").over(w)
        return bars.withColumns({"probability": ratio(F.col("close") - low, high - low), "_n": F.count("*").over(w)}).filter(
            (F.col("_n") == RANGE_BARS) & F.col("probability").isNotNull()).drop("_n")

    def live() -> DataFrame:
        fees = spark.read.parquet(fee_path)
        return fees_of.live_zscore(fees, F.col("day"), F.col("fee"), F.lit(fees.agg(F.max("day")).first()[0]))

    landed = scratch_path(spark, "landed-bars")
    fee.filter(F.col("day") < ends[0]).write.mode("append").parquet(fee_path)
    for before, end in zip(ends, ends[1:]):
        fee.filter((F.col("day") >= before) & (F.col("day") < end)).write.mode("append").parquet(fee_path)
        files.filter((F.col("open_time") >= before) & (F.col("open_time") < end)).coalesce(1).write.mode("append").json(landed)
        stream = spark.readStream.schema(history.schema).option("maxFilesPerTrigger", 1).json(landed)
        jobs.score_ring(stream, history, place, live, out, state, z_floor=0.0).awaitTermination()
    return present(spark.read.parquet(out).select("symbol", "open_time", "close", "probability", "live_zscore", "signal"))
