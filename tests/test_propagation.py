"""Late, replaced and removed batches reach derived tables; streams survive ties, restarts and lost checkpoints."""

import datetime as dt
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chainstrata.operators import utxo
from chainstrata.plans import feeds
from chainstrata.session import scratch_path, shared_dir
from chainstrata.sources import tables, versions
from chainstrata.streaming import jobs
from test_sources import block, land, orders
from test_streaming import T0, TICKS, feed, stream, tick


def rows_of(spark, path):
    return sorted(tuple(r) for r in spark.read.schema("height bigint, v bigint").parquet(path).select("height", "v").collect())


def heights(spark, *pairs):
    return spark.createDataFrame(list(pairs), "height bigint, v bigint")


@pytest.fixture
def chain(spark):
    """A source and a table built from it, with a function that brings it up to date and checks it against a rebuild."""
    source, target, builds = scratch_path(spark, "source"), scratch_path(spark, "target"), []

    def build(part):
        builds.append(1)
        return part["s"].select("height", (F.col("v") * 10).alias("v"))

    def follow():
        due = tables.refresh_batches(spark, {"s": source}, "s", target, build)
        assert rows_of(spark, target) == [(h, v * 10) for h, v in rows_of(spark, source)]
        return due

    return source, target, follow, builds


def put(spark, source, *pairs):
    frame = heights(spark, *pairs).withColumn("batch_id", tables.batch_id(F.col("height")))
    tables.upsert_partitions(frame, source, ["height"], ["batch_id"])


def test_late_and_replaced_rows_reach_the_derived_table(spark, chain):
    source, _, follow, builds = chain
    put(spark, source, (1, 1), (5, 5), (300, 7))
    assert follow() == [0, 1] and follow() == []
    put(spark, source, (3, 3))            # a late height below the newest
    assert follow() == [0]
    put(spark, source, (5, 50))           # a replaced block at the newest height of its batch
    assert follow() == [0]
    put(spark, source, (5, 50))           # written again: cannot be told from a change
    assert follow() == [0] and len(builds) == 4


def test_rollback_and_reset_reach_the_derived_table(spark, chain):
    source, target, follow, _ = chain
    put(spark, source, *[(h, h) for h in (0, 100, 260, 300, 520, 900)])
    follow()
    tables.rollback(spark, source, 280)
    assert follow() == [1]
    assert [h for h, _ in rows_of(spark, target)] == [0, 100, 260]
    tables.rollback(spark, source, 249)   # at a batch edge; batch 1 goes altogether
    assert follow() == [] and [h for h, _ in rows_of(spark, target)] == [0, 100]
    put(spark, source, (250, 1), (900, 2))
    assert follow() == [1, 3]
    tables.reset(spark, source)
    put(spark, source, (400, 4))
    assert follow() == [1] and rows_of(spark, target) == [(400, 40)]


def test_a_batch_without_rows_is_removed(spark, chain):
    source, target, _, _ = chain
    put(spark, source, (1, 1), (300, 3))
    odd = lambda part: part["s"].filter("v % 2 = 1")
    tables.refresh_batches(spark, {"s": source}, "s", target, odd)
    put(spark, source, (300, 4))
    assert tables.refresh_batches(spark, {"s": source}, "s", target, odd) == [1]
    assert rows_of(spark, target) == [(1, 1)]
    assert tables.refresh_batches(spark, {"s": source}, "s", target, odd) == []


def test_open_batches_wait_or_are_built_again(spark, chain):
    source, target, follow, _ = chain
    put(spark, source, (1, 1), (300, 3))
    follow()
    versions.begin(spark, source, [0])    # a load that died before its files changed
    assert follow() == []
    put(spark, source, (1, 2))            # its repetition
    assert follow() == [0]
    versions.begin(spark, target, [1])    # a build that died
    assert follow() == [1] and follow() == []


def test_long_logs_are_folded(spark):
    path = scratch_path(spark, "log")
    for i in range(versions.FOLD + 2):
        versions.commit(spark, path, [i % 7], {i % 7: {"s": str(i)}}, gone=[99])
    before = versions.state(spark, path)
    after = versions.state(spark, path)
    assert before == after and sorted(after) == list(range(7)) and after[2].built_from == {"s": "51"}
    assert len(versions._files(spark, path)[1]) == 1


def test_blocks_without_transactions_leave_no_old_rows(spark):
    landed, warehouse, state = (scratch_path(spark, n) for n in ("landed", "warehouse", "state"))
    land(spark, landed, [block(1, 2), block(300, 1)])
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    empty = block(300, 1)
    empty["tx"] = []
    land(spark, landed, [empty])
    jobs.ingest_blocks(spark, landed, warehouse, state, files_per_batch=1).awaitTermination()
    held = {n: sorted({r.height for r in spark.read.parquet(f"{warehouse}/{n}").collect()}) for n in ("blocks", "txs", "inputs", "outputs")}
    assert held == {"blocks": [1, 300], "txs": [1], "inputs": [1], "outputs": [1]}


def test_wide_batches_keep_their_width(spark):
    landed, warehouse, state = (scratch_path(spark, n) for n in ("landed", "warehouse", "state"))
    land(spark, landed, [block(h, 2) for h in (1, 300, 999, 1000, 2600)])
    jobs.ingest_blocks(spark, landed, warehouse, state, blocks=1000).awaitTermination()
    source, target = f"{warehouse}/txs", scratch_path(spark, "derived")
    build = lambda part: part["s"].groupBy("height").agg(F.count("*").alias("v"))
    follow = lambda: tables.refresh_batches(spark, {"s": source}, "s", target, build)
    assert follow() == [0, 1, 2] and follow() == []
    land(spark, landed, [block(300, 1), block(500, 1)])  # replaced and late; the width is found
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    assert follow() == [0] and rows_of(spark, target) == [(1, 2), (300, 1), (500, 1), (999, 2), (1000, 2), (2600, 2)]
    assert [r.height for r in tables.read_heights(spark, source, 999, 2500).select("height").distinct().orderBy("height").collect()] == [999, 1000]
    tables.rollback(spark, source, 600)
    assert follow() == [0] and rows_of(spark, target) == [(1, 2), (300, 1), (500, 1)]
    with pytest.raises(ValueError):
        tables.write_batches(heights(spark, (1, 1)), source, blocks=250)


def test_batches_of_the_ledger_do_not_grow_with_the_chain(spark, tmp_path):
    """240 batches of the usual width, each with two blocks."""
    orders(spark, range(0, 60_001, 125)).write.parquet(f"{tmp_path}/orders.parquet")
    warehouse = feeds._delivered_ledger(spark, str(tmp_path))
    for name in ("blocks", "txs", "inputs", "outputs", "utxo_events"):
        stored = spark.read.parquet(f"{warehouse}/{name}")
        assert stored.select("batch_id").distinct().count() <= feeds.BATCHES
        held = [r.height for r in stored.select("height").distinct().orderBy("height").collect()]
        assert held == list(range(0, 54_001, 125))


def test_blocks_move_once_at_most(spark):
    """A height delivered twice: only the choice of rows is shuffled apart from one join of the blocks."""
    path = scratch_path(spark, "landed")
    land(spark, path, [block(1, 2), block(2, 1), block(1, 1)])
    raw = spark.read.schema(jobs.landing.BLOCK_SCHEMA).json(path).select(
        "*", F.lit(0).alias("landed_at"), F.lit("f").alias("file"), F.monotonically_increasing_id().alias("_row"))
    stored = scratch_path(spark, "stored")
    raw.write.parquet(stored)
    landed = spark.read.parquet(stored)
    newest, found = jobs.newest_blocks(landed)
    assert sorted(r.height for r in newest.select("height").collect()) == ["1", "2"] and found.count() == 2
    single, _ = jobs.newest_blocks(landed.filter("height = '2'"))
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and newest._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0


def test_a_stream_that_starts_over_never_loses_ticks(spark):
    """The checkpoint is lost, and the older files are gone: fuller bars stay."""
    source, later, out = (scratch_path(spark, n) for n in ("ticks", "later", "bars"))
    feed(spark, source, [tick("a", i * 30, float(i)) for i in range(8)], [tick("a", 250 + i, 50.0) for i in range(3)])
    bars = jobs.bar_stream(stream(spark, source))
    jobs.write_keyed(bars, out, scratch_path(spark, "state"), ["symbol", "open_time"], "open_time", "num_candles").awaitTermination()
    want = spark.read.parquet(out).collect()
    feed(spark, later, [tick("a", 250 + i, 50.0) for i in range(3)])
    bars = jobs.bar_stream(stream(spark, later))
    jobs.write_keyed(bars, out, scratch_path(spark, "state"), ["symbol", "open_time"], "open_time", "num_candles").awaitTermination()
    assert spark.read.parquet(out).collect() == want and want[0].num_candles == 11


def test_equal_times_follow_their_offsets(spark):
    source, bars, minutes, buffer = (scratch_path(spark, n) for n in ("ticks", "bars", "minutes", "buffer"))
    rows = [(3, 7.0), (1, 5.0), (4, 8.0), (2, 6.0)]
    for part in (rows[:2], rows[2:]):
        frame = spark.createDataFrame([(*tick("a", 10, p), n) for n, p in part], TICKS + ", offset bigint")
        frame.coalesce(1).write.mode("append").parquet(source)
    read = spark.readStream.schema(TICKS + ", offset bigint").option("maxFilesPerTrigger", 1).parquet(source)
    jobs.write_keyed(jobs.bar_stream(read, tie="offset"), bars, scratch_path(spark, "s"), ["symbol", "open_time"], "open_time").awaitTermination()
    assert [(r.open, r.close, r.num_candles) for r in spark.read.parquet(bars).collect()] == [(5.0, 8.0, 4)]
    kept = jobs.minute_stream(read, "open_time", ["symbol"], ["close"], tie="offset")
    jobs.write_keyed(kept, minutes, scratch_path(spark, "s"), ["symbol", "minute"], "minute", "n_ticks").awaitTermination()
    assert [(r.close, r.n_ticks) for r in spark.read.parquet(minutes).collect()] == [(8.0, 4)]
    jobs.write_newest(jobs.last_bars_stream(read, 3, tie="offset"), buffer, scratch_path(spark, "s"), ["open_time", "offset"], 3).awaitTermination()
    assert sorted(r.close for r in spark.read.parquet(buffer).collect()) == [6.0, 7.0, 8.0]


def test_scores_on_state_equal_batch_scores(spark):
    """Several micro-batches, a repeated bar, a new symbol and a restart; the live z-score changes in between."""
    source, out, state = (scratch_path(spark, n) for n in ("ticks", "scores", "state"))
    bars = [tick("a", i * 60, float(i * 7 % 11)) for i in range(30)]
    history = spark.createDataFrame(bars[:10], TICKS)
    z = {"now": 2.0}

    def score(frame):
        w = jobs.Window.partitionBy("symbol").orderBy("open_time").rowsBetween(-4, 0)
        return frame.withColumns({"probability": F.sum("close").over(w) / 40, "_n": F.count("*").over(w)}).filter("_n = 5").drop("_n")

    def run():
        jobs.score_ring(stream(spark, source), history, score, lambda: spark.range(1).select(F.lit(z["now"]).alias("zscore")),
                        out, state, size=6).awaitTermination()

    feed(spark, source, bars[10:13], [*bars[12:20], tick("b", 5, 1.0)])
    run()
    z["now"] = 0.5
    feed(spark, source, bars[20:], [tick("b", 6 + i, 30.0) for i in range(4)])
    run()
    got = {(r.symbol, r.open_time): (r.probability, r.signal) for r in spark.read.parquet(out).collect()}
    closes = [b[5] for b in bars]
    want = {}
    for i in range(10, 30):
        p = sum(closes[i - 4:i + 1]) / 40
        want["a", T0 + dt.timedelta(minutes=i)] = (p, "LONG" if p >= 0.6 and i < 20 else "WAIT")
    want["b", T0 + dt.timedelta(seconds=9)] = (121.0 / 40, "WAIT")
    assert got == want and {s for _, s in got.values()} == {"LONG", "WAIT"}


def bytes_written(spark):
    return sum(s.getBytesWritten() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if s.getScheme() == "file")


def stored_bytes(path):
    return sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("*.parquet"))


def hashed_blocks(heights):
    """Blocks of two transactions whose names do not compress."""
    out = []
    for h in heights:
        b, name = block(h, 2), lambda *parts: hashlib.md5(repr(parts).encode()).hexdigest()
        b["hash"] = name(h)
        for i, tx in enumerate(b["tx"]):
            tx["txid"], tx["hash"] = name(h, i), name(h, i, "w")
            for o in tx["vout"]:
                o["scriptPubKey"] = {"type": "pubkeyhash", "hex": name(h, i, o["n"])}
        out.append(b)
    return out


def test_a_merge_writes_its_rows_once(spark):
    """The second load touches every batch: what it writes are the landed blocks and each table, not each table twice."""
    landed, warehouse, state = (scratch_path(spark, n) for n in ("landed", "warehouse", "state"))
    land(spark, landed, hashed_blocks(h for h in range(6000) if h % 10))
    jobs.ingest_blocks(spark, landed, warehouse, state, blocks=2000).awaitTermination()
    land(spark, landed, hashed_blocks(range(0, 6000, 10)))
    before = bytes_written(spark)
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    tables_only = sum(stored_bytes(f"{warehouse}/{n}") for n in ("blocks", "txs", "inputs", "outputs"))
    assert spark.read.parquet(f"{warehouse}/txs").count() == 12_000
    assert bytes_written(spark) - before < 1.5 * tables_only
    assert not list(Path(shared_dir(spark)).glob("micro-*"))


def test_large_merges_shuffle_no_rows(spark, monkeypatch):
    """Where files would be large, every task writes its own rows; late, replaced and emptied blocks come out alike."""
    monkeypatch.setattr(tables, "SMALLEST_FILE", 0)
    monkeypatch.setattr(tables, "GROUP", 0)
    writer, spreads = tables._writer, []
    monkeypatch.setattr(tables, "_writer", lambda df, by, sort, spread=True: spreads.append(spread) or writer(df, by, sort, spread))
    landed, warehouse, state = (scratch_path(spark, n) for n in ("landed", "warehouse", "state"))
    land(spark, landed, [block(h, 2) for h in range(0, 700, 7)])
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    sources = {n: f"{warehouse}/{n}" for n in ("outputs", "inputs")}
    events = lambda part: utxo.utxo_events(part["outputs"], part["inputs"])
    follow = lambda: tables.refresh_batches(spark, sources, "outputs", f"{warehouse}/events", events, row_by_row=True)
    assert follow() == [0, 1, 2]
    replaced = block(7, 1)
    emptied = {**block(14), "tx": []}
    land(spark, landed, [block(3, 2), replaced, emptied])
    jobs.ingest_blocks(spark, landed, warehouse, state).awaitTermination()
    assert follow() == [0] and spreads == [False] * 12
    count = {r.height: r["count"] for r in spark.read.parquet(f"{warehouse}/txs").groupBy("height").count().collect()}
    assert count == {**{h: 2 for h in range(0, 700, 7) if h != 14}, 3: 2, 7: 1}
    events = {r.height: r["count"] for r in spark.read.parquet(f"{warehouse}/events").groupBy("height").count().collect()}
    assert events == {h: 2 * n + n - 1 for h, n in count.items()}
    odd = lambda part: part["outputs"].filter("height < 0").select("height")
    built = lambda: tables.refresh_batches(spark, {"outputs": sources["outputs"]}, "outputs", f"{warehouse}/odd", odd, row_by_row=True)
    assert built() == [0, 1, 2] and built() == [] and not list(Path(f"{warehouse}/odd").glob("batch_id=*"))


@pytest.mark.parametrize("most", [0, 2**21])
def test_rows_that_give_way(spark, monkeypatch, most):
    """Packed heights and a join agree, on negative, missing and repeated heights too."""
    monkeypatch.setattr(tables, "MOST_WORDS", most)
    rows = spark.createDataFrame([(h, i) for i, h in enumerate([-130, -65, -64, -1, 0, 63, 63, 64, 2**40 + 63, None])], "height bigint, v bigint")
    gone = spark.createDataFrame([(h,) for h in (-130, -64, 63, 63, 2**40 + 63, 5, None)], "height bigint")
    left = tables._without(rows, gone, ["height"])
    assert sorted(r.v for r in left.collect()) == [1, 3, 4, 7, 9] and left.columns == ["height", "v"]
    assert sorted(r.height for r in tables.numbers(tables.bit_words(gone, "height"), "height").collect()) == [-130, -64, 5, 63, 2**40 + 63]


def test_a_swap_that_died_between_two_batches(spark, monkeypatch):
    """One batch has moved, one is to move, one has lost all its rows."""
    path, staged = scratch_path(spark, "t"), scratch_path(spark, "staged")
    put(spark, path, (1, 1), (300, 3), (600, 6))
    frame = heights(spark, (1, 10), (301, 30)).withColumn("batch_id", tables.batch_id(F.col("height")))
    arrived = heights(spark, (1, 0), (301, 0), (600, 0))
    merge = lambda: tables.upsert_partitions(frame, path, ["height"], ["batch_id"], staged=staged, arrived=arrived, touched=[(0,), (1,), (2,)])
    real = tables.replace_partitions

    def dies(*args, **kwargs):
        tables.reset(spark, f"{path}/batch_id=0")
        Path(staged, "batch_id=0").rename(Path(path, "batch_id=0"))
        raise OSError("lost")

    monkeypatch.setattr(tables, "replace_partitions", dies)
    with pytest.raises(OSError):
        merge()
    monkeypatch.setattr(tables, "replace_partitions", real)
    merge()
    assert rows_of(spark, path) == [(1, 10), (300, 3), (301, 30)]
    assert not Path(path, "batch_id=2").exists() and not Path(staged).exists()


def test_staged_files_in_another_store_are_written_again(spark, monkeypatch):
    monkeypatch.setattr(tables, "_move_partitions", lambda *args: False)
    path = scratch_path(spark, "t")
    put(spark, path, (1, 1), (300, 3))
    put(spark, path, (1, 2), (2, 2))
    assert rows_of(spark, path) == [(1, 2), (2, 2), (300, 3)]
