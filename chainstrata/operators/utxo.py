"""Create/spend events and balances of unspent outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chainstrata.functions import money, scripts
from chainstrata.functions.columns import conform
from chainstrata.operators.candles import keep_one

OUTPOINT = ["txid", "vout"]

EVENT_SCHEMA = (
    "event_type string, height bigint, block_hash string, txid string, outpoint_txid string, "
    "outpoint_vout bigint, value_sats bigint, scriptPubKey_type string, scriptPubKey_hex string, "
    "address string, spent_by_txid string, spent_by_vin bigint"
)

# Fixed value: smallest balance of the large-holder table, 10 coins.
LARGE_HOLDER_SATS = 1_000_000_000


def normalize_outputs(outputs: DataFrame) -> DataFrame:
    """Accept the older column names and derive the address of each output."""
    if "value_sats" in outputs.columns or "value" not in outputs.columns:
        values = outputs
    else:
        exact = F.round(F.col("value").try_cast("decimal(28,12)") * money.SATS_PER_COIN)
        values = outputs.withColumn("value_sats", exact.cast("bigint"))
    tidy = conform(
        values,
        "height bigint, block_hash string, txid string, vout bigint, value_sats bigint, "
        "scriptPubKey_type string, scriptPubKey_hex string",
        {
            "vout": ["vout_index"],
            "scriptPubKey_type": ["script_type"],
            "scriptPubKey_hex": ["script_hex"],
        },
    )
    return tidy.withColumn("address", scripts.script_address(F.col("scriptPubKey_hex")))


def create_events(outputs: DataFrame) -> DataFrame:
    named = normalize_outputs(outputs).withColumns({
        "event_type": F.lit("create"),
        "outpoint_txid": F.col("txid"),
        "outpoint_vout": F.col("vout"),
        "spent_by_vin": F.lit(0),
    })
    return conform(named, EVENT_SCHEMA)


def spend_events(inputs: DataFrame) -> DataFrame:
    """Every non-coinbase input spends the outpoint it refers to."""
    spent = inputs.filter(~F.col("is_coinbase")) if "is_coinbase" in inputs.columns else inputs
    vin = F.col("vin_index") if "vin_index" in inputs.columns else F.lit(0)
    named = spent.withColumns({
        "event_type": F.lit("spend"),
        "outpoint_txid": F.col("prev_txid"),
        "outpoint_vout": F.col("prev_vout"),
        "spent_by_txid": F.col("txid"),
        "spent_by_vin": money.long_or_zero(vin),
        "value_sats": F.lit(0),
    })
    return conform(named, EVENT_SCHEMA)


def utxo_events(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    return create_events(outputs).unionByName(spend_events(inputs))


def narrow_events(events: DataFrame) -> DataFrame:
    """Slim creates and spends in one layout, one scan: spends carry no value or address."""
    is_create = F.col("event_type") == "create"
    own = scripts.address_or_outpoint(F.col("address"), F.col("outpoint_txid"), F.col("outpoint_vout"))
    return events.filter(F.col("event_type").isin("create", "spend")).select(
        "event_type",
        F.col("outpoint_txid").alias("txid"),
        F.col("outpoint_vout").alias("vout"),
        F.when(is_create, F.col("value_sats")).otherwise(F.lit(0)).cast("bigint").alias("value_sats"),
        F.when(is_create, own).otherwise(F.lit("")).alias("address"),
        "height",
        scripts.key_prefix(F.col("outpoint_txid")).alias("prefix"),
    )


def creates(narrow: DataFrame) -> DataFrame:
    return narrow.filter(F.col("event_type") == "create").select(
        "txid", "vout", "address", "value_sats", "prefix", "height")


def spends(narrow: DataFrame) -> DataFrame:
    return narrow.filter(F.col("event_type") == "spend").select("txid", "vout", "prefix")


def prefix_range(df: DataFrame, low: str, high: str) -> DataFrame:
    """Rows whose key prefix lies in a closed range of four-character hex strings."""
    return df.filter(F.col("prefix").between(low, high))


def unspent(created: DataFrame, spent: DataFrame) -> DataFrame:
    """Outputs no input refers to.

    Both sides collapse to one row per outpoint, within each task before their
    shuffle, so repeated rows neither count twice nor pile up on one task. The
    first copy by height, then value, then address wins. Both sides end up
    hashed on the outpoint, and the anti-join adds no further shuffle.
    """
    first = keep_one(
        created.select("txid", "vout", "address", "value_sats", "height"), OUTPOINT,
        [F.col("height"), F.col("value_sats"), F.col("address")],
    )
    return first.join(spent.select(*OUTPOINT).distinct(), OUTPOINT, "left_anti")


def balances(open_outputs: DataFrame) -> DataFrame:
    """Balance per address and the height of its newest unspent receipt."""
    return open_outputs.groupBy("address").agg(
        F.sum("value_sats").alias("balance_sats"),
        F.max("height").alias("last_seen_height"),
    )


def large_holders(balance: DataFrame, min_sats: int = LARGE_HOLDER_SATS,
                  units_per_coin: float = money.SATS_PER_COIN) -> DataFrame:
    return balance.filter(F.col("balance_sats") >= min_sats).select(
        "address", "balance_sats",
        (F.col("balance_sats") / F.lit(float(units_per_coin))).alias("btc"),
        "last_seen_height",
    )


def top_holders(balance: DataFrame, n: int = 20) -> DataFrame:
    return balance.orderBy(F.desc("balance_sats"), "address").limit(n)


def control_totals(events: DataFrame, batch: Column) -> DataFrame:
    """Rows, value and heights per batch, to check a load against its source."""
    return events.groupBy(batch.alias("batch_id")).agg(
        F.count("*").alias("n_rows"),
        F.sum("value_sats").alias("total_sats"),
        F.min("height").alias("first_height"),
        F.max("height").alias("last_height"),
    )
