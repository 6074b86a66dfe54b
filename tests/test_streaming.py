import datetime as dt

import pytest
from pyspark.sql import functions as F

from chainstrata.operators import candles
from chainstrata.session import scratch_path
from chainstrata.sources import tables
from chainstrata.streaming import jobs
from test_sources import block, land

T0 = dt.datetime(2024, 1, 1)
TICKS = ("symbol string, open_time timestamp, open double, high double, low double, close double, volume double, "
         "quote_volume double, trades bigint")


def tick(symbol, seconds, price):
    return (symbol, T0 + dt.timedelta(seconds=seconds), price, price, price, price, 1.0, price, 1)


def feed(spark, path, *files):
    """Append each list of ticks as one file."""
    for rows in files:
        spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(path)


def test_bars_over_several_batches_equal_the_batch_result(spark):
    source, out, state = (scratch_path(spark, n) for n in ("ticks", "bars", "state"))
    files = [[tick(s, i * 70 + k * 900, 100.0 + i * 3 % 17 + k) for s in ("a", "b") for i in range(12)] for k in range(4)]
    feed(spark, source, *files[:3])
    jobs.write_epochs(jobs.bar_stream(stream(spark, source)), out, state).awaitTermination()
    feed(spark, source, files[3])  # a later run continues from the checkpoint
    jobs.write_epochs(jobs.bar_stream(stream(spark, source)), out, state).awaitTermination()
    got = jobs.newest_rows(spark, out, ["symbol", "open_time"])
    want = candles.resample(spark.read.schema(TICKS).parquet(source), "5m").select(*got.columns)
    assert want.count() > 10
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_duplicates_and_late_ticks(spark):
    source, out, state = (scratch_path(spark, n) for n in ("ticks", "bars", "state"))
    feed(spark, source, [tick("a", 10, 1.0), tick("a", 10, 1.0), tick("a", 20, 2.0)])
    feed(spark, source, [tick("a", 2000, 5.0), tick("a", 20, 2.0)])   # repeated delivery
    feed(spark, source, [tick("a", 2400, 5.5)])                        # the watermark acts one batch later
    feed(spark, source, [tick("a", 30, 9.0), tick("a", 4000, 6.0)])   # the first is later than allowed
    feed(spark, source, [tick("a", 9000, 7.0)])
    unique = jobs.unique_ticks(stream(spark, source), ["symbol", "open_time"], "open_time", "10 minutes")
    jobs.write_epochs(jobs.bar_stream(unique, delay=None), out, state, "append").awaitTermination()
    rows = spark.read.parquet(out).orderBy("open_time").collect()
    assert [(r.open_time, r.trades, r.close) for r in rows[:2]] == [
        (T0, 2, 2.0), (T0 + dt.timedelta(seconds=1800), 1, 5.0)]


def test_one_tick_a_minute(spark):
    source, out, state = (scratch_path(spark, n) for n in ("ticks", "minutes", "state"))
    feed(spark, source, [tick("a", s, float(s)) for s in range(0, 150, 10)], [tick("a", 55, 55.5), tick("b", 5, 1.0)])
    kept = jobs.minute_stream(stream(spark, source), "open_time", ["symbol"], ["close"])
    jobs.write_epochs(kept, out, state).awaitTermination()
    rows = jobs.newest_rows(spark, out, ["symbol", "minute"]).orderBy("symbol", "minute").collect()
    assert [(r.symbol, r.close) for r in rows] == [("a", 55.5), ("a", 110.0), ("a", 140.0), ("b", 1.0)]


def test_buffer_keeps_the_newest_bars(spark):
    source, out, state = (scratch_path(spark, n) for n in ("ticks", "buffer", "state"))
    feed(spark, source, [tick("a", i * 60, float(i)) for i in range(30)], [tick("a", i * 60, float(i)) for i in range(25, 70)],
         [tick("b", 0, 1.0)])
    jobs.write_epochs(jobs.last_bars_stream(stream(spark, source)), out, state).awaitTermination()
    rows = spark.read.parquet(out)
    newest = rows.filter(F.col("epoch") == rows.filter("symbol = 'a'").agg(F.max("epoch")).scalar())
    assert [r.close for r in newest.filter("symbol = 'a'").orderBy("open_time").collect()] == [float(i) for i in range(22, 70)]
    assert rows.filter("symbol = 'b'").count() == 1


def test_scores_new_complete_bars_only(spark):
    """Old bars of silent symbols, and complete bars before an incomplete new one, give no signal; repeats count once."""
    source, out, state, stored = (scratch_path(spark, n) for n in ("ticks", "scores", "state", "bars"))
    feed(spark, stored, [tick("a", i, float(i)) for i in range(5)] + [tick("a", 100, 70.0), tick("old", 1, 90.0)])
    feed(spark, source, [tick("a", 100, 70.0), tick("a", 105, 80.0), tick("b", 90, -1.0)])
    seen = []

    def score(bars):
        seen.append(bars.groupBy("symbol", "open_time").count().filter("count > 1").count())
        return bars.filter("close >= 0").withColumn("probability", F.col("close") / 100)

    jobs.score_stream(stream(spark, source), lambda: spark.read.schema(TICKS).parquet(stored), score, out, state).awaitTermination()
    rows = spark.read.parquet(out).orderBy("open_time").collect()
    assert [(r.symbol, r.close) for r in rows] == [("a", 70.0), ("a", 80.0)] and seen == [0]


def test_scores_the_newest_bar(spark):
    source, out, state, stored = (scratch_path(spark, n) for n in ("ticks", "scores", "state", "bars"))
    feed(spark, stored, [tick("a", i, float(i)) for i in range(5)])
    feed(spark, source, [tick("a", 100, 70.0), tick("b", 90, 10.0)], [tick("a", 110, 20.0)])
    score = lambda bars: bars.withColumn("probability", F.col("close") / 100)
    jobs.score_stream(stream(spark, source), lambda: spark.read.schema(TICKS).parquet(stored), score, out, state).awaitTermination()
    rows = spark.read.parquet(out).orderBy("epoch", "symbol").collect()
    assert [(r.epoch, r.symbol, r.close, r.signal) for r in rows] == [
        (0, "a", 70.0, "LONG"), (0, "b", 10.0, "WAIT"), (1, "a", 20.0, "WAIT")]


@pytest.mark.parametrize("again", [False, True])
def test_ingest_in_two_runs(spark, again):
    landed, warehouse, state = (scratch_path(spark, n) for n in ("landed", "warehouse", "state"))
    land(spark, landed, [block(h, 2) for h in range(240, 256)])
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    land(spark, landed, [block(h, 2) for h in range(254, 260)])  # repeats two blocks and grows the tail batch
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    if again:  # a lost checkpoint: everything is delivered again
        jobs.ingest_blocks(spark, landed, warehouse, scratch_path(spark, "state")).awaitTermination()
    sizes = {n: spark.read.parquet(f"{warehouse}/{n}").count() for n in ("blocks", "txs", "inputs", "outputs")}
    assert sizes == {"blocks": 20, "txs": 40, "inputs": 40, "outputs": 80}
    tables.rollback(spark, f"{warehouse}/blocks", 252)
    assert tables.tip_height(spark.read.parquet(f"{warehouse}/blocks")).first().tip == 252


def test_a_reorganised_block_leaves_nothing_behind(spark):
    landed, warehouse, state = (scratch_path(spark, n) for n in ("landed", "warehouse", "state"))
    land(spark, landed, [block(h, 3) for h in range(3)] + [{"height": "?", "hash": "odd"}])
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    other = block(2, 1)
    other["hash"], other["tx"][0]["txid"] = "other", "t-other"
    land(spark, landed, [other])
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    txs = spark.read.parquet(f"{warehouse}/txs")
    assert txs.count() == 7
    assert [r.txid for r in txs.filter("height = 2").collect()] == ["t-other"]
    assert [r.hash for r in spark.read.parquet(f"{warehouse}/blocks").filter("height = 2").collect()] == ["other"]
    assert [r.hash for r in spark.read.json(f"{warehouse}/rejected").collect()] == ["odd"]
