"""Parsers for landed JSON: blocks, candle arrays, candle and funding messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chainstrata.functions import money

# Numbers that must stay exact or may be malformed are read as text.
BLOCK_SCHEMA = (
    "height string, hash string, time string, mediantime string, version string, bits string, "
    "difficulty double, chainwork string, size string, weight string, strippedsize string, nTx string, "
    "previousblockhash string, nextblockhash string, "
    "tx array<struct<txid:string, hash:string, version:string, size:string, vsize:string, weight:string, "
    "locktime:string, "
    "vin:array<struct<coinbase:string, txid:string, vout:string, sequence:string>>, "
    "vout:array<struct<n:string, value:string, scriptPubKey:struct<type:string, hex:string>>>>>"
)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Landed block files, one JSON document per line."""
    return spark.read.schema(BLOCK_SCHEMA).json(path)


def _longs(*names: str) -> list[Column]:
    return [money.safe_long(F.col(n)).alias(n.split(".")[-1]) for n in names]


def _size(column: str) -> Column:
    """Array length, 0 for an absent array."""
    return F.greatest(F.size(column), F.lit(0)).cast("bigint")


def flatten_blocks(raw: DataFrame) -> dict[str, DataFrame]:
    """Nested blocks to the four flat tables."""
    height = money.safe_long(F.col("height")).alias("height")
    blocks = raw.select(
        height, "hash", *_longs("time", "mediantime", "version"), "bits", "difficulty", "chainwork",
        *_longs("size", "weight", "strippedsize", "nTx"), "previousblockhash", "nextblockhash",
    )
    tx = raw.select(height, F.col("hash").alias("block_hash"), F.explode("tx").alias("tx"))
    txs = tx.select(
        "height", "block_hash", "tx.txid", F.col("tx.hash").alias("wtxid"),
        *_longs("tx.version", "tx.size", "tx.vsize", "tx.weight", "tx.locktime"),
        _size("tx.vin").alias("vin_count"), _size("tx.vout").alias("vout_count"),
    )
    vin = tx.select("height", "block_hash", "tx.txid", F.posexplode("tx.vin").alias("vin_index", "vin"))
    minted = F.col("vin.coinbase").isNotNull()
    inputs = vin.select(
        "height", "block_hash", "txid", F.col("vin_index").cast("bigint").alias("vin_index"),
        minted.alias("is_coinbase"), money.safe_long(F.col("vin.sequence")).alias("sequence"),
        F.when(~minted, F.col("vin.txid")).alias("prev_txid"),
        F.when(~minted, money.safe_long(F.col("vin.vout"))).alias("prev_vout"),
    )
    vout = tx.select("height", "block_hash", "tx.txid", F.explode("tx.vout").alias("out"))
    outputs = vout.select(
        "height", "block_hash", "txid", money.safe_long(F.col("out.n")).alias("vout"),
        money.coins_to_sats(F.col("out.value")).alias("value_sats"),
        F.col("out.scriptPubKey.type").alias("script_type"), F.col("out.scriptPubKey.hex").alias("script_hex"),
    )
    return {"blocks": blocks, "txs": txs, "inputs": inputs, "outputs": outputs}


def _utc(millis: Column) -> Column:
    return F.timestamp_millis(millis.cast("bigint")).cast("timestamp_ntz")


def parse_candles(landed: DataFrame, body: str = "value") -> DataFrame:
    """Candle responses, arrays of positional arrays, to typed rows."""
    k = F.explode(F.from_json(body, "array<array<string>>")).alias("k")
    at = lambda i: F.try_element_at("k", F.lit(i + 1))
    return landed.select(k).select(
        _utc(at(0)).alias("open_time"),
        *[at(i).cast("double").alias(n) for i, n in enumerate(("open", "high", "low", "close", "volume"), 1)],
        _utc(at(6)).alias("close_time"),
        at(7).cast("double").alias("quote_volume"),
        at(8).cast("bigint").alias("trades"),
    )


def parse_candle_messages(messages: DataFrame, body: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """Candle stream messages; only closed candles pass. ``carry`` names columns to keep, such as an offset."""
    schema = "k struct<t:bigint,o:string,h:string,l:string,c:string,v:string,q:string,n:bigint,x:boolean,s:string>"
    return messages.select(*carry, F.from_json(body, schema).alias("m")).select(*carry, "m.k.*").filter("x").select(
        *carry,
        F.coalesce("s", F.lit("BTCUSDT")).alias("symbol"),
        F.timestamp_millis("t").alias("open_time"),
        *[F.col(c).cast("double").alias(n) for c, n in
          (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"), ("v", "volume"), ("q", "quote_volume"))],
        F.col("n").alias("trades"),
    )


def parse_funding_messages(messages: DataFrame, body: str = "value", symbol: str = "BTCUSDT",
                           carry: Sequence[str] = ()) -> DataFrame:
    """Mark-price messages to funding ticks; ``symbol`` stands in where a message names none."""
    return messages.select(*carry, F.from_json(body, "E bigint, s string, r string, p string").alias("m")).select(
        *carry,
        F.timestamp_millis("m.E").alias("timestamp"),
        F.coalesce("m.s", F.lit(symbol)).alias("symbol"),
        F.col("m.r").cast("double").alias("funding_rate"),
        F.col("m.p").cast("double").alias("mark_price"),
    )
