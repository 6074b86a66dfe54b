import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chainstrata.plans import feeds
from chainstrata.session import checkpointed, materialized, scratch_path, shared_dir
from chainstrata.sources import catalog, landing, tables


def block(height, txs=1):
    def tx(i):
        vin = [{"coinbase": "00", "sequence": 4294967295}] if i == 0 else [{"txid": f"p{height}", "vout": 3, "sequence": 1}]
        return {"txid": f"t{height}-{i}", "hash": f"w{height}-{i}", "version": 2, "size": 200, "vsize": 150, "weight": 600,
                "locktime": 0, "vin": vin,
                "vout": [{"n": 0, "value": 0.29, "scriptPubKey": {"type": "pubkeyhash", "hex": "76a9"}}, {"n": 1, "value": 1.5}]}
    return {"height": height, "hash": f"h{height}", "time": 1231006505 + height, "mediantime": 1, "version": 1, "bits": "1d00ffff",
            "difficulty": 1, "chainwork": "00", "size": 285, "weight": 1140, "strippedsize": 285, "nTx": txs,
            "previousblockhash": "p", "tx": [tx(i) for i in range(txs)]}


def land(spark, path, blocks):
    spark.createDataFrame([(json.dumps(b),) for b in blocks], "value string").coalesce(1).write.mode("append").text(path)


def test_flatten_blocks(spark):
    path = scratch_path(spark, "blocks")
    land(spark, path, [block(7, 2), {"height": "x", "hash": "bad", "tx": []}])
    flat = landing.flatten_blocks(landing.read_blocks(spark, path))
    assert {(r.height, r.hash, r.difficulty) for r in flat["blocks"].collect()} == {(7, "h7", 1.0), (None, "bad", None)}
    assert [(r.txid, r.wtxid, r.vin_count, r.vout_count) for r in flat["txs"].orderBy("txid").collect()] == [
        ("t7-0", "w7-0", 1, 2), ("t7-1", "w7-1", 1, 2)]
    assert [(r.txid, r.is_coinbase, r.prev_txid, r.prev_vout, r.sequence) for r in flat["inputs"].orderBy("txid").collect()] == [
        ("t7-0", True, None, None, 4294967295), ("t7-1", False, "p7", 3, 1)]
    outputs = flat["outputs"].filter("txid = 't7-0'").orderBy("vout").collect()
    assert [(r.vout, r.value_sats, r.script_type) for r in outputs] == [(0, 29_000_000, "pubkeyhash"), (1, 150_000_000, None)]


def orders(spark, keys):
    rows = [(k, "O", 10.0 + k % 97, dt.datetime(1996, 1, 1) + dt.timedelta(days=k % 50)) for k in keys]
    return spark.createDataFrame(rows, "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz")


def test_landed_blocks_are_small_and_read_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "LANDED_ROWS", 400)
    orders(spark, range(1000)).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    path = feeds._landed_blocks(spark, str(tmp_path))
    raw = spark.read.text(path)
    assert sum(f.stat().st_size for f in Path(path).glob("part-*")) < raw.agg(F.sum(F.length("value"))).first()[0] / 2
    assert len(list(Path(path).glob("part-*"))) == 3
    assert feeds.flatten_blocks(spark, str(tmp_path)).count() == 2000


def test_parse_feeds(spark):
    body = json.dumps([[1700000000000, "1.5", "2", "1", "1.7", "10", 1700000059999, "16.5", 42, "0", "0", "0"]])
    row = landing.parse_candles(spark.createDataFrame([(body,)], "value string")).first()
    assert row.open_time == dt.datetime(2023, 11, 14, 22, 13, 20) and row.close_time.microsecond == 999000
    assert (row.open, row.close, row.quote_volume, row.trades) == (1.5, 1.7, 16.5, 42)
    k = {"t": 1700000000000, "o": "1", "h": "2", "l": "1", "c": "2", "v": "3", "q": "4", "n": 5, "x": True}
    messages = [(json.dumps({"k": k}),), (json.dumps({"k": {**k, "x": False}}),)]
    closed = landing.parse_candle_messages(spark.createDataFrame(messages, "value string")).collect()
    assert [(r.symbol, r.close, r.trades) for r in closed] == [("BTCUSDT", 2.0, 5)]
    funding = landing.parse_funding_messages(
        spark.createDataFrame([(json.dumps({"E": 1700000000123, "r": "0.0001", "p": "37000.5"}),)], "value string")).first()
    assert (funding.symbol, funding.funding_rate, funding.mark_price) == ("BTCUSDT", 0.0001, 37000.5)


def heights(spark, first, last, tag="a"):
    return spark.range(first, last + 1).select(F.col("id").alias("height"), F.lit(tag).alias("tag"))


def test_batches_replace_and_prune(spark):
    path = scratch_path(spark, "t")
    tables.write_batches(heights(spark, 0, 620), path)
    tables.write_batches(heights(spark, 500, 700, "b"), path)  # a grown tail batch
    got = spark.read.parquet(path)
    assert got.count() == 701 and got.filter("tag = 'b'").count() == 201
    part = tables.read_heights(spark, path, 240, 260)
    assert part.count() == 21
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "PushedFilters: [IsNotNull(height)" in plan
    assert tables.tip_height(got).first().tip == 700


def test_rollback_inside_a_batch_then_continue(spark):
    path = scratch_path(spark, "t")
    tables.write_batches(heights(spark, 0, 760), path)
    tables.rollback(spark, path, 510)
    assert tables.tip_height(spark.read.parquet(path)).first().tip == 510
    tables.rollback(spark, path, 499)  # at a batch edge
    assert spark.read.parquet(path).count() == 500
    tables.reset(spark, path)
    assert not tables.exists(spark, path)


def test_upsert_merges_and_repeats_safely(spark):
    path, staged = scratch_path(spark, "t"), scratch_path(spark, "staged")
    first = heights(spark, 0, 300).withColumn("batch_id", tables.batch_id(F.col("height")))
    more = heights(spark, 290, 320, "b").withColumn("batch_id", tables.batch_id(F.col("height")))
    tables.upsert_partitions(first, path, ["height"], ["batch_id"])
    for _ in range(2):
        tables.upsert_partitions(more, path, ["height"], ["batch_id"], staged=staged)
    got = spark.read.parquet(path)
    assert got.count() == got.select("height").distinct().count() == 321
    assert got.filter("tag = 'b'").count() == 31


def test_upsert_finishes_a_swap_that_failed(spark, monkeypatch):
    path, staged = scratch_path(spark, "t"), scratch_path(spark, "staged")
    frame = heights(spark, 0, 9).withColumn("batch_id", F.lit(0).cast("bigint"))
    tables.upsert_partitions(frame, path, ["height"], ["batch_id"])
    new = heights(spark, 5, 14, "b").withColumn("batch_id", F.lit(0).cast("bigint"))
    real = tables.replace_partitions

    def lost(*args, **kwargs):
        tables.reset(spark, f"{path}/batch_id=0")
        raise OSError("lost")

    monkeypatch.setattr(tables, "replace_partitions", lost)
    with pytest.raises(OSError):
        tables.upsert_partitions(new, path, ["height"], ["batch_id"], staged=staged)
    monkeypatch.setattr(tables, "replace_partitions", real)
    tables.upsert_partitions(new, path, ["height"], ["batch_id"], staged=staged)
    got = spark.read.schema("height bigint, tag string, batch_id bigint").parquet(path)
    assert got.count() == 15 and got.filter("tag = 'a'").count() == 5


def test_refresh_rebuilds_new_and_grown_batches(spark):
    source, target = scratch_path(spark, "source"), scratch_path(spark, "target")
    build = lambda part: part["s"].select("height", (F.col("height") * 2).alias("twice"))
    tables.write_batches(heights(spark, 0, 300), source)
    assert tables.refresh_batches(spark, {"s": source}, "s", target, build) == [0, 1]
    assert tables.refresh_batches(spark, {"s": source}, "s", target, build) == []
    tables.write_batches(heights(spark, 250, 600), source)
    spark.catalog.refreshByPath(source)
    assert tables.refresh_batches(spark, {"s": source}, "s", target, build) == [1, 2]
    assert spark.read.parquet(target).count() == 601


def candles(spark, times, close):
    return spark.createDataFrame([(t, close) for t in times], "open_time timestamp_ntz, close double")


def test_candle_months(spark):
    path = scratch_path(spark, "candles")
    at = lambda month, day: dt.datetime(2024, month, day)
    tables.upsert_candles(candles(spark, [at(1, 31), at(1, 1), at(1, 1), at(2, 1)], 1.0), path)
    tables.upsert_candles(candles(spark, [at(2, 1), at(2, 2)], 2.0), path)
    got = {r.open_time: (r.close, r.month) for r in spark.read.parquet(path).collect()}
    assert got == {at(1, 1): (1.0, 1), at(1, 31): (1.0, 1), at(2, 1): (1.0, 2), at(2, 2): (2.0, 2)}
    tables.delete_candles_from(spark, path, F.lit(at(1, 20)).cast("timestamp_ntz"))
    assert [r.open_time for r in spark.read.parquet(path).collect()] == [at(1, 1)]


def test_years_dates_weeks_signals(spark):
    years = scratch_path(spark, "years")
    daily = spark.createDataFrame([(dt.date(2023, 12, 31), 1.0), (dt.date(2024, 1, 1), 2.0)], "date date, v double")
    tables.write_years(daily, years)
    tables.write_years(daily.filter("v = 2"), years)
    assert [r.year for r in spark.read.parquet(years).collect()] == [2024]

    dated = scratch_path(spark, "dated")
    for day, n in (("2024-01-01", 3), ("2024-01-08", 2), ("2024-01-08", 1)):
        tables.write_dated(spark.range(n), dated, day)
    assert tables.latest(spark, dated).count() == 1 and spark.read.parquet(dated).count() == 4

    weekly = scratch_path(spark, "weeks")
    frame = spark.createDataFrame([(dt.date(2024, 1, 1), "x", 11.0)], "week date, address string, btc double")
    tables.append_weeks(frame, weekly)
    tables.append_weeks(frame, weekly)
    assert spark.read.parquet(weekly).count() == 1

    signals = scratch_path(spark, "signals")
    row = spark.createDataFrame([("t", 1.0, "LONG", 0.7, 0.1, None)], tables.SIGNAL_SCHEMA)
    tables.append_signals(row, signals)
    tables.append_signals(row, signals)
    assert [tuple(r) for r in tables.read_signals(spark, signals).collect()] == [("t", 1.0, "LONG", 0.7, 0.1, None)] * 2

    written = scratch_path(spark, "query")
    tables.write_query(spark.range(5), written)
    tables.write_query(spark.range(4), written)
    assert catalog.read_matching(spark, written, "part-*.parquet").count() == 4


def test_clustered_files_have_disjoint_ranges(spark):
    path = scratch_path(spark, "clustered")
    df = spark.range(20_000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 4).alias("prefix"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(df, path, "prefix")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("prefix").alias("a"), F.max("prefix").alias("b"))
    rows = sorted((r.a, r.b) for r in spans.collect())
    assert len(rows) > 1 and all(x[1] < y[0] for x, y in zip(rows, rows[1:]))


def test_catalog(spark):
    path = scratch_path(spark, "view")
    spark.range(3).write.parquet(path)
    catalog.register(spark, {"three_rows": path})
    assert list(catalog.rows(spark, "select id from three_rows order by id limit 2")) == [{"id": 0}, {"id": 1}]
    assert list(catalog.rows(spark, "select id from three_rows where id > 9")) == []
    for text in ("select nothing from three_rows", "selec 1", "select * from no_such_table"):
        with pytest.raises(catalog.QueryError):
            catalog.ask(spark, text)
    with pytest.raises(catalog.QueryError):
        list(catalog.rows(spark, "select 1 / (id - id) from three_rows"))
    spark.range(5).write.mode("overwrite").parquet(path)
    catalog.refresh(spark, ["three_rows"])
    counts = catalog.row_counts({"a": spark.table("three_rows"), "b": spark.range(2).toDF("x")})
    assert {tuple(r) for r in counts.collect()} == {("a", 5), ("b", 2)}
    assert catalog.preview(spark.range(9), ["id"]).count() == 5


def test_shared_folder_helpers(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert materialized(spark.range(4), "m").count() == 4
    assert checkpointed(spark.range(4)).count() == 4
