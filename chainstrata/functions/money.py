"""Exact money arithmetic in satoshis."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the ledger's issuance rule.
SATS_PER_COIN = 100_000_000
FIRST_SUBSIDY_SATS = 5_000_000_000
HALVING_INTERVAL = 210_000
LAST_HALVING = 64


def coins_to_sats(amount: Column) -> Column:
    """Decimal coin amount (number or text) to satoshis, rounded down; bad input is null.

    The amount goes through its text form so a double such as 0.29 keeps its
    decimal digits; truncation works on both signs.
    """
    exact = amount.cast("string").try_cast("decimal(28,12)")
    scaled = exact * F.lit(SATS_PER_COIN).cast("decimal(10,0)")
    return F.when(scaled < 0, F.ceil(scaled)).otherwise(F.floor(scaled)).cast("bigint")


def sats_to_coins(sats: Column) -> Column:
    return sats / F.lit(float(SATS_PER_COIN))


def cents(amount: Column) -> Column:
    """Two-decimal money held as a double, as exact integer cents."""
    return F.rint(amount * 100).cast("bigint")


def safe_long(value: Column) -> Column:
    return value.try_cast("bigint")


def long_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def block_subsidy(height: Column) -> Column:
    """New coins of the block at ``height``: halved each interval, 0 from the 64th halving.

    A shift by 64 would wrap around to the full subsidy, hence the guard.
    """
    halvings = F.floor(height / F.lit(HALVING_INTERVAL)).cast("int")
    halved = F.call_function("shiftright", F.lit(FIRST_SUBSIDY_SATS).cast("bigint"), halvings)
    return F.when(halvings >= LAST_HALVING, F.lit(0).cast("bigint")).otherwise(halved)


def block_fees(coinbase_sats: Column, subsidy_sats: Column) -> Column:
    return F.greatest(coinbase_sats - subsidy_sats, F.lit(0).cast("bigint"))
