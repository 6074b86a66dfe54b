import datetime as dt

import pytest
from pyspark.sql import functions as F

from chainstrata.functions.bins import COIN_COHORTS
from chainstrata.operators import cohorts, fees, snapshots, streaks, utxo

OUTPUTS = "height bigint, block_hash string, txid string, vout bigint, value_sats bigint, script_type string, script_hex string"
INPUTS = "height bigint, block_hash string, txid string, vin_index bigint, is_coinbase boolean, sequence bigint, prev_txid string, prev_vout bigint"
KEYHASH = "0014751e76e8199196d454941c45d1b3a323f1433bd6"
OWNER = "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4"
COIN = 100_000_000


@pytest.fixture(scope="module")
def narrow(spark):
    outputs = spark.createDataFrame([
        (1, "b1", "aa", 0, 50 * COIN, "witness_v0_keyhash", KEYHASH),
        (1, "b1", "aa", 1, 5 * COIN, "witness_v0_keyhash", KEYHASH),  # spent below
        (2, "b2", "bb", 0, 10 * COIN, "pubkey", "41ff"),              # no address: stands for itself
        (2, "b2", "bb", 0, 10 * COIN, "pubkey", "41ff"),              # delivered twice
        (3, "b3", "cc", 0, 7 * COIN, "witness_v0_keyhash", KEYHASH),  # same owner, later block
    ], OUTPUTS)
    inputs = spark.createDataFrame([
        (1, "b1", "aa", 0, True, 1, None, None),
        (3, "b3", "cc", 0, False, 1, "aa", 1),
        (3, "b3", "cc", 1, False, 1, "aa", 1),  # repeated
    ], INPUTS)
    return utxo.narrow_events(utxo.utxo_events(outputs, inputs))


def test_events_union(narrow):
    rows = {(r.event_type, r.txid, r.vout, r.value_sats, r.address, r.prefix) for r in narrow.collect()}
    assert ("create", "bb", 0, 10 * COIN, "bb:0", "bb") in rows
    assert ("spend", "aa", 1, 0, "", "aa") in rows
    assert narrow.filter("event_type = 'spend'").count() == 2


def test_balances(narrow):
    left = utxo.unspent(utxo.creates(narrow), utxo.spends(narrow))
    assert {(r.txid, r.vout) for r in left.collect()} == {("aa", 0), ("bb", 0), ("cc", 0)}
    balance = utxo.balances(left)
    assert {tuple(r) for r in balance.collect()} == {(OWNER, 57 * COIN, 3), ("bb:0", 10 * COIN, 2)}
    assert balance.agg(F.sum("balance_sats")).first()[0] == left.agg(F.sum("value_sats")).first()[0]
    holders = utxo.large_holders(balance).orderBy("btc").collect()
    assert [(r.address, r.btc) for r in holders] == [("bb:0", 10.0), (OWNER, 57.0)]  # exactly 10 stays
    assert utxo.top_holders(balance, 1).first().address == OWNER


def test_one_outpoint_with_a_third_of_the_rows(spark):
    rows = [(f"t{i:04d}", 0, "x", 1, "0000", i) for i in range(300)] + [("hot", 0, "y", 9, "hot", 500 - i % 7) for i in range(150)]
    made = spark.createDataFrame(rows, "txid string, vout bigint, address string, value_sats bigint, prefix string, height bigint")
    gone = spark.createDataFrame([("t0001", 0, "0000")] * 200, "txid string, vout bigint, prefix string")
    left = utxo.unspent(made, gone)
    assert left.count() == 300
    assert left.filter("txid = 'hot'").first().height == 494


def test_prefix_range(spark):
    df = spark.createDataFrame([("0000",), ("03ff",), ("0400",)], "prefix string")
    assert [r.prefix for r in utxo.prefix_range(df, "0000", "03ff").collect()] == ["0000", "03ff"]


def test_block_metrics(spark):
    heights = [0, 209_999, 210_000, 64 * 210_000, 5]
    blocks = spark.createDataFrame([(h, f"h{h}", 1231006505, 1) for h in heights], "height bigint, hash string, time bigint, nTx bigint")
    paid = {0: 50 * COIN, 209_999: 50 * COIN + 7, 210_000: 24 * COIN, 64 * 210_000: 33}
    outputs = spark.createDataFrame(
        [(h, "", f"c{h}", 0, v, "", "") for h, v in paid.items()] + [(0, "", "other", 0, 99, "", "")], OUTPUTS)
    inputs = spark.createDataFrame(
        [(h, "", f"c{h}", i, True, 0, None, None) for h in paid for i in (0, 1)] + [(0, "", "other", 0, False, 0, "x", 0)], INPUTS)
    got = {r.height: (r.subsidy_sats, r.fees_sats) for r in fees.block_metrics(blocks, inputs, outputs).collect()}
    assert got == {0: (50 * COIN, 0), 209_999: (50 * COIN, 7), 210_000: (25 * COIN, 0), 64 * 210_000: (0, 33),
                   5: (50 * COIN, 0)}


def _days(spark, values):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(v), 100.0 + i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date date, fees_btc double, btc_price double")


def test_momentum_needs_full_windows(spark):
    out = fees.momentum(_days(spark, [1.0] * 30 + [50.0])).orderBy("date").collect()
    assert all(r.fees_zscore is None and r.regime == "normal" for r in out[:30])
    assert out[29].fees_ma30 == 1.0 and out[29].fees_std30 == 0.0
    assert out[30].fees_zscore > 1.5 and out[30].regime == "elevated"


def test_missing_fee_day_is_zero(spark):
    prices = spark.createDataFrame([(dt.date(2024, 1, 1), 5.0), (dt.date(2024, 1, 2), 6.0), (dt.date(2024, 1, 3), 0.0)],
                                   "date date, btc_price double")
    daily = spark.createDataFrame([(dt.date(2024, 1, 1), 2.0)], "date date, fees_btc double")
    out = fees.prices_with_fees(prices, daily).orderBy("date").collect()
    assert [(r.btc_price, r.fees_btc) for r in out] == [(5.0, 2.0), (6.0, 0.0)]


def test_streaks_at_both_ends(spark):
    labels = ["elevated", "normal", "elevated", "elevated", "normal", "elevated"]
    days = _days(spark, range(6)).withColumn("fees_zscore", F.col("fees_btc") + 2)
    labelled = days.withColumn("regime", F.element_at(F.array(*[F.lit(x) for x in labels]), (F.col("fees_btc") + 1).cast("int")))
    runs = streaks.streaks(labelled, "regime", "elevated").orderBy("start_date").collect()
    assert [(r.start_date.day, r.end_date.day, r.days) for r in runs] == [(1, 1, 1), (3, 4, 2), (6, 6, 1)]
    assert [(r.price_start, r.price_end, r.max_zscore) for r in runs][1] == (102.0, 103.0, 5.0)
    totals = streaks.streak_totals(streaks.streaks(labelled, "regime", "elevated")).first()
    assert (totals.streaks, totals.avg_days, totals.max_days) == (3, pytest.approx(4 / 3), 2)


def test_cohort_table_keeps_empty_labels(spark):
    rows = [("a", 20.0, 20, True, 1.0), ("b", 30.0, 30, False, 3.0), ("c", 5000.0, 5000, False, 9.0), ("d", 10.0, 10, True, 2.0)]
    df = spark.createDataFrame(rows, "address string, btc double, sats bigint, old boolean, age double")
    df = df.withColumn("cohort", COIN_COHORTS.label(F.col("btc")))
    table = cohorts.share_table(df, "cohort", "sats", "old", "age")
    kept = cohorts.kept_labels(COIN_COHORTS, table, "cohort", ["n", "total", "pct_n", "flagged_n"]).orderBy("ord").collect()
    assert len(kept) == 9
    first = kept[0]
    assert (first.cohort, first.n, first.total, first.flagged_n, first.flagged_total, first.rest_total) == ("10-50", 2, 50, 1, 20, 30)
    assert (first.pct_n, first.median_age) == (50.0, 2.0)  # the unlabelled row counts in the whole
    assert (kept[1].n, kept[1].median_age) == (0, None)
    cross = cohorts.column_percentages(df.withColumn("t", F.col("old").cast("string")), "t", "cohort", COIN_COHORTS.labels)
    assert {r.t: r["10-50"] for r in cross.collect()} == {"true": 50.0, "false": 50.0}


@pytest.fixture(scope="module")
def weeks(spark):
    start = dt.date(2024, 1, 1)
    series = {
        "strong": [10, 50, 100, 200], "up": [10, 11, 12, 13], "dump": [500, 400, 300, 200], "down": [13, 12, 11, 10],
        "flat": [10, 12, 11, 10], "short": [10, 20, 30],
    }
    rows = [(start + dt.timedelta(days=7 * i), a, float(v)) for a, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "week date, address string, btc double")


def test_trends(weeks):
    as_of = F.lit(dt.date(2024, 1, 22))
    got = {r.address: r.trend for r in snapshots.address_trends(weeks, as_of).collect()}
    assert got == {"strong": "ACUMULANDO FUERTE", "up": "Acumulando", "dump": "VENDIENDO FUERTE", "down": "Vendiendo",
                   "flat": "Estable"}  # two falls, but nothing lost over the month
    table = {r.trend: (r.holders, r.total_btc) for r in snapshots.trend_table(snapshots.address_trends(weeks, as_of)).collect()}
    assert table["ACUMULANDO FUERTE"] == (1, 190.0)


def test_week_over_week_changes(spark):
    now, then = dt.date(2024, 1, 8), dt.date(2024, 1, 1)
    rows = [(then, "gone", 20.0), (now, "new", 15.0), (then, "up", 100.0), (now, "up", 111.0), (then, "same", 100.0),
            (now, "same", 110.0), (then, "down", 100.0), (now, "down", 80.0)]
    df = spark.createDataFrame(rows, "week date, address string, btc double")
    got = {r.address: (r.change, r.delta) for r in snapshots.changes(df, F.lit(now), F.lit(then)).collect()}
    assert got == {"gone": ("exited", -20.0), "new": ("new", 15.0), "up": ("up", 11.0), "down": ("down", -20.0)}
