import datetime as dt

import pytest
from pyspark.sql import functions as F

from chainstrata.functions import bins, calendar, columns, money, ratios, scripts


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_coins_round_down_and_bad_input_is_null(spark):
    rows = [("0.29",), ("1.999999999",), ("0.123456789",), (None,), ("abc",), ("1e-8",), ("-0.000000019",)]
    assert values(spark, rows, "v string", money.coins_to_sats(F.col("v"))) == [
        29_000_000, 199_999_999, 12_345_678, None, None, 1, -1]


def test_subsidy_schedule(spark):
    rows = [(0,), (209_999,), (210_000,), (420_000,), (63 * 210_000,), (64 * 210_000,), (10**9,)]
    assert values(spark, rows, "h bigint", money.block_subsidy(F.col("h"))) == [
        5_000_000_000, 5_000_000_000, 2_500_000_000, 1_250_000_000, 0, 0, 0]


def test_safe_numbers(spark):
    rows = [("12",), ("x",), (None,)]
    assert values(spark, rows, "v string", money.safe_long(F.col("v"))) == [12, None, None]
    assert values(spark, rows, "v string", money.long_or_zero(F.col("v"))) == [12, 0, 0]


# Published example scripts and addresses.
VECTORS = [
    ("76a91462e907b15cbf27d5425399ebf6f0fb50ebb88f1888ac", "p2pkh", "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa"),
    ("76a914000000000000000000000000000000000000000088ac", "p2pkh", "1111111111111111111114oLvT2"),
    ("a914b472a266d0bd89c13706a4132ccfb16f7c3b9fcb87", "p2sh", "3J98t1WpEZ73CNmQviecrnyiWrnqRhWNLy"),
    ("0014751E76E8199196D454941C45D1B3A323F1433BD6", "p2wpkh", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4"),
    ("00201863143c14c5166804bd19203356da136c985678cd4d27a1b8c6329604903262", "p2wsh",
     "bc1qrp33g0q5c5txsp9arysrx4k6zdkfs4nce4xj0gdcccefvpysxf3qccfmv3"),
    ("512079be667ef9dcbbac55a06295ce870b07029bfcdb2dce28d959f2815b16f81798", "p2tr",
     "bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj0"),
    ("4104678afdb0fe5548271967f1a67130b7105cd6a828e03909a67962e0ea1f61deb649f6bc3f4cef38c4f35504e51ec112de5c384d"
     "f7ba0b8d578a4c702b6bf11d5fac", None, None),
    ("6a0568656c6c6f", None, None),
    ("0014zz1e76e8199196d454941c45d1b3a323f1433bd6", "p2wpkh", None),
    (None, None, None),
]


def test_script_addresses(spark):
    df = spark.createDataFrame(VECTORS, "script string, kind string, want string")
    out = df.select("kind", "want", scripts.script_class(F.col("script")).alias("k"),
                    scripts.script_address(F.col("script")).alias("a")).collect()
    assert [(r.k, r.a) for r in out] == [(r.kind, r.want) for r in out]


def test_address_families_and_fallback(spark):
    rows = [("1abc", "t", 0), ("3x", "t", 0), ("bc1q", "t", 1), (None, "ff", 2)]
    df = spark.createDataFrame(rows, "a string, t string, v int")
    own = scripts.address_or_outpoint(F.col("a"), F.col("t"), F.col("v"))
    out = df.select(own.alias("o"), scripts.address_family(own).alias("f")).collect()
    assert [(r.o, r.f) for r in out] == [
        ("1abc", "P2PKH (Legacy)"), ("3x", "P2SH (SegWit)"), ("bc1q", "Bech32 (Native)"), ("ff:2", "P2PK (Satoshi)")]


def test_ladders_keep_their_edges(spark):
    coins = [(10.0,), (10.5,), (50.0,), (50.1,), (1e6,), (1e6 + 1,)]
    assert values(spark, coins, "x double", bins.COIN_COHORTS.label(F.col("x"))) == [
        None, "10-50", "10-50", "50-100", ">100K", None]
    lowest = bins.Ladder((10.0, 50.0), ("a",), include_lowest=True)
    assert values(spark, [(10.0,), (9.0,)], "x double", lowest.label(F.col("x"))) == ["a", None]
    ages = [(0.0,), (29.99,), (30.0,), (3650.0,), (99999.0,), (-1.0,), (None,)]
    assert values(spark, ages, "x double", bins.AGE_COHORTS.label(F.col("x"))) == [
        "<1m", "<1m", "1-3m", "10y+", None, None, None]
    with pytest.raises(ValueError):
        bins.Ladder((1, 2), ("a", "b"))


def test_regimes(spark):
    rows = [(1.5,), (1.51,), (-1.51,), (2.5,), (None,)]
    assert values(spark, rows, "z double", bins.band_regime(F.col("z"))) == [
        "normal", "elevated", "depressed", "elevated", "normal"]
    steps = [(2.1,), (2.0,), (1.0,), (-1.1,), (None,)]
    assert values(spark, steps, "z double", bins.step_regime(F.col("z"))) == [2, 1, 0, -1, 0]


def test_calendar(spark):
    day = dt.date
    rows = [(day(2020, 5, 10),), (day(2020, 5, 11),), (day(2028, 3, 26),)]
    assert values(spark, rows, "d date", calendar.days_to_next(F.col("d"))) == [1, 1440, 999]
    rows = [(day(2018, 12, 31),), (day(2019, 1, 1),), (day(2023, 6, 1),), (day(2024, 1, 1),)]
    assert values(spark, rows, "d date", calendar.cycle_label(F.col("d"))) == [
        "2017-2018 Bull & Bear", "2019-2021 Cycle", "2022-2023 Bear", "2024-2026 Bull"]
    friday = spark.createDataFrame([(dt.datetime(2024, 1, 5, 9, 7),)], "t timestamp_ntz")
    row = friday.select(calendar.slot_label(F.weekday("t"), F.hour("t")).alias("s"), *[
        c.alias(n) for n, c in calendar.calendar_parts(F.col("t")).items()]).first()
    assert tuple(row) == ("Fri 09:00", 9, 7, 4, 0)
    assert values(spark, [(1231006505,)], "s bigint", calendar.epoch_date(F.col("s"))) == [day(2009, 1, 3)]


def test_ratios_and_signals(spark):
    assert values(spark, [(1.0, 0.0), (1.0, 2.0), (1.0, None)], "a double, b double",
                  ratios.ratio(F.col("a"), F.col("b"))) == [None, 0.5, None]
    assert values(spark, [(0.6,), (0.59,)], "p double", ratios.signal_label(F.col("p"))) == ["LONG", "WAIT"]
    assert values(spark, [(0.9, 1.0), (0.9, 1.1)], "p double, z double",
                  ratios.gated_signal_label(F.col("p"), F.col("z"))) == ["WAIT", "LONG"]
    assert values(spark, [(0.0,), (100.0,)], "x double", ratios.log10_positive(F.col("x"))) == [None, 2.0]


def test_columns(spark):
    df = spark.createDataFrame([("7", "x")], "vout_index string, extra string")
    out = columns.conform(df, "vout bigint, height bigint", {"vout": ["vout_index"]})
    assert out.dtypes == [("vout", "bigint"), ("height", "bigint")]
    assert tuple(out.first()) == (7, None)
    with pytest.raises(ValueError, match="missing columns: a, b"):
        columns.require_columns(df, ["a", "b", "extra"])
