"""Continuous loads and scores. Every sink is idempotent per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from chainstrata.functions.calendar import BAR_LENGTHS
from chainstrata.functions.ratios import MIN_CONFIDENCE, gated_signal_label, signal_label
from chainstrata.operators.candles import keep_one, newest_per_key, time_key
from chainstrata.session import COMPACT, at_once, materialized, scratch_path
from chainstrata.sources import landing, tables, versions

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_blocks(landed: DataFrame, name: str = "newest-blocks", folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored blocks, one per height, and their heights; the file that landed last wins, then its name.

    ``landed`` is a stored frame with a row number ``_row``. Heights are counted as
    bits. Where one repeats, the winners are chosen on narrow columns, and only then the
    blocks themselves move, once. What is stored goes to ``folder``, if given.
    """
    height = F.col("height").try_cast("bigint")
    narrow = landed.select(height.alias("height"), "landed_at", "file", "hash", "_row").filter("height is not null")
    held = materialized(tables.bit_words(narrow, "height"), "heights", folder, **COMPACT)
    readable = landed.filter(height.isNotNull())
    if readable.count() > (held.agg(F.sum(F.bit_count("_bits"))).first()[0] or 0):
        best = keep_one(narrow, ["height"], [F.desc("landed_at"), F.desc("file"), F.col("hash"), F.col("_row")])
        winners = materialized(best.select("_row"), "winners", folder, **COMPACT)
        readable = materialized(readable.join(winners, "_row", "left_semi"), name, folder, **COMPACT)
    return readable.drop("_row", "landed_at", "file"), tables.numbers(held, "height")


def ingest_blocks(spark: SparkSession, landed: str, warehouse: str, checkpoint: str,
                  files_per_batch: int | None = None, blocks: int | None = None) -> StreamingQuery:
    """Load every landed block file once into the four flat tables, then stop.

    The checkpoint remembers the files seen and advances only after a
    micro-batch is written; ``files_per_batch`` bounds one. A height that is
    delivered again replaces all its rows, so a reorganised block leaves nothing
    behind; within a micro-batch the file that landed last wins. JSON is parsed once
    per micro-batch, and the four tables are flattened from the stored blocks. Blocks
    without a readable height are kept apart in ``rejected``, by file. ``blocks`` is the
    width of a batch of new tables, as in ``tables.write_batches``. What a micro-batch
    stores on the way goes once it is loaded.
    """

    def load(micro: DataFrame, epoch: int) -> None:
        spark = micro.sparkSession
        folder = scratch_path(spark, "micro")
        raw = materialized(micro.withColumn("_row", F.monotonically_increasing_id()), "landed", folder, **COMPACT)
        odd = raw.filter(F.col("height").try_cast("bigint").isNull())
        (odd.drop("_row").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("file").json(f"{warehouse}/rejected"))
        newest, heights = newest_blocks(raw, folder=folder)
        flats = landing.flatten_blocks(newest)
        wide = max(versions.keep_width(spark, f"{warehouse}/{name}", blocks, tables.BATCH_BLOCKS) for name in flats)
        batch = tables.batch_id(F.col("height"), wide)
        arrived = heights.withColumn("batch_id", batch)
        touched = [tuple(r) for r in arrived.select("batch_id").distinct().collect()]
        at_once(partial(
            tables.upsert_partitions, flat.withColumn("batch_id", batch), f"{warehouse}/{name}",
            ["height"], ["batch_id"], staged=f"{checkpoint}/merged/{epoch}-{name}", arrived=arrived, touched=touched,
            read_from=f"{folder}/landed")
            for name, flat in flats.items())
        tables.reset(spark, folder)

    reader = spark.readStream.schema(landing.BLOCK_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.json(landed).select(
        "*", F.col("_metadata.file_modification_time").alias("landed_at"), F.col("_metadata.file_name").alias("file"))
    return (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def write_epochs(stream: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Write each micro-batch to a partition of its own; a retried one overwrites itself."""

    def store(micro: DataFrame, epoch: int) -> None:
        micro.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (stream.writeStream.outputMode(mode).foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def newest_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Last stored version of every key of an update-mode table."""
    stored = spark.read.parquet(path)
    rest = [c for c in stored.columns if c not in (*keys, "epoch")]
    picked = stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_row"))
    return picked.select(*keys, "_row.*")


def write_keyed(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str,
                progress: str | None = None, mode: str = "update") -> StreamingQuery:
    """Merge each micro-batch by key into partitions of the event's date (column ``date``).

    The table does not depend on epoch numbers: a stream that starts over after its
    checkpoint is lost writes the same keys again. ``progress`` names a column that
    grows with the input of a key (a count), so that the partial rows of a stream that
    starts over never replace fuller ones, even where old input is gone.
    """

    def store(micro: DataFrame, epoch: int) -> None:
        rows = materialized(micro.withColumn("date", F.to_date(ts)), "keyed")  # state must not advance twice
        tables.upsert_partitions(rows, path, keys, ["date"], staged=f"{checkpoint}/merged/{epoch}", progress=progress)

    return (stream.writeStream.outputMode(mode).foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def write_newest(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], size: int, key: str = "symbol") -> StreamingQuery:
    """Keep the newest ``size`` rows of every symbol, by ``keys``, whatever micro-batch brought them."""

    def store(micro: DataFrame, epoch: int) -> None:
        rows = materialized(micro, "newest")
        tables.upsert_partitions(
            rows, path, [key, *keys], [key], staged=f"{checkpoint}/merged/{epoch}",
            keep=lambda merged: newest_per_key(merged, [key], keys, size))

    return (stream.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def unique_ticks(ticks: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated deliveries of an event within the watermark."""
    return ticks.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def bar_stream(ticks: DataFrame, bar: str = "5m", delay: str | None = "10 minutes", tie: str | None = None) -> DataFrame:
    """Tumbling bars per symbol from closed candles or ticks with one row per symbol and time.

    ``tie`` names a unique integer (an offset) that orders rows of equal time. Pass
    ``delay=None`` after ``unique_ticks``, which has set the watermark already.
    """
    timed = ticks.withWatermark("open_time", delay) if delay else ticks
    return (
        timed.withColumn("_key", time_key(F.col("open_time"), F.col(tie) if tie else None))
        .groupBy("symbol", F.window("open_time", BAR_LENGTHS[bar]).alias("w"))
        .agg(F.min_by("open", "_key").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
             F.max_by("close", "_key").alias("close"), F.sum("volume").alias("volume"),
             F.sum("quote_volume").alias("quote_volume"), F.sum("trades").alias("trades"),
             F.count("*").alias("num_candles"))
        .withColumn("open_time", F.col("w.start")).drop("w")
    )


def minute_stream(ticks: DataFrame, ts: str, keys: Sequence[str], columns: Sequence[str],
                  delay: str = "2 minutes", tie: str | None = None) -> DataFrame:
    """At most one tick per key and minute, the last one, and how many there were (``n_ticks``)."""
    last = F.max_by(F.struct(ts, *columns), time_key(F.col(ts), F.col(tie) if tie else None)).alias("t")
    return (
        ticks.withWatermark(ts, delay).groupBy(*keys, F.window(ts, "1 minute").alias("w")).agg(last, F.count("*").alias("n_ticks"))
        .select(*keys, F.col("w.start").alias("minute"), "t.*", "n_ticks")
    )


class _LastBars(StatefulProcessor):
    """Keeps the newest rows of a symbol, by the leading columns of ``schema``, and emits them after each batch.

    With ``mark`` the column ``_new`` tells the rows of this batch, which are all emitted.
    """

    def __init__(self, size: int, schema: StructType, by: int = 1, mark: bool = False):
        self.size, self.schema, self.mark = size, schema, mark
        self.names = schema.fieldNames()
        self.by = self.names[:by]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bars = handle.getListState("bars", self.schema)

    def _ordered(self, parts: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(parts).drop_duplicates(self.by, keep="last").sort_values(self.by)

    def _put(self, rows: pd.DataFrame) -> None:
        kept = rows[self.names].tail(self.size).astype(object)
        self.bars.put([tuple(r) for r in kept.where(kept.notna(), None).itertuples(index=False)])

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._put(self._ordered([initialState]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame([tuple(r) for r in self.bars.get()], columns=self.names)
        parts = [held.assign(_new=0)] if len(held) else []
        for batch in rows:
            new = batch[self.names].assign(_new=1)
            parts.append(new if self.mark else new.sort_values(self.by).tail(self.size))
        kept = self._ordered(parts)
        self._put(kept)
        if self.mark:
            yield kept.assign(symbol=key[0])[["symbol", *self.names, "_new"]]
        else:
            yield kept.tail(self.size).assign(symbol=key[0])[["symbol", *self.names]]

    def close(self) -> None:
        pass


def last_bars_stream(bars: DataFrame, size: int = 48, tie: str | None = None) -> DataFrame:
    """Rolling buffer of the newest ``size`` bars per symbol, state bounded by that size.

    ``tie`` tells bars of equal time apart. Sets the session's state store to
    RocksDB, which list state needs.
    """
    bars.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    columns = "open_time timestamp, " + (f"{tie} bigint, " if tie else "") + "close double"
    schema = StructType.fromDDL(columns)
    return bars.select("symbol", *schema.fieldNames()).groupBy("symbol").transformWithStateInPandas(
        _LastBars(size, schema, 2 if tie else 1), outputStructType=f"symbol string, {columns}",
        outputMode="Update", timeMode="None")


def ring_stream(bars: DataFrame, history: DataFrame, size: int = 200) -> DataFrame:
    """After each micro-batch, per symbol with new bars, these (``_new`` 1) and the ``size`` bars before them.

    Keyed state holds the newest ``size`` bars, so no trigger reads stored bars;
    ``history`` fills the state once, when the stream first starts. Bars of a symbol
    and time that come again replace the held ones. Sets the session's state store
    to RocksDB.
    """
    bars.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    rest = [f for f in history.schema.fields if f.name not in ("symbol", "open_time")]
    schema = StructType([history.schema["open_time"], *rest])
    out = StructType([history.schema["symbol"], *schema.fields, StructType.fromDDL("_new int").fields[0]])
    return bars.select("symbol", *schema.fieldNames()).groupBy("symbol").transformWithStateInPandas(
        _LastBars(size, schema, mark=True), outputStructType=out, outputMode="Update", timeMode="None",
        initialState=history.select("symbol", *schema.fieldNames()).groupBy("symbol"))


def score_ring(bars: DataFrame, history: DataFrame, score: Callable[[DataFrame], DataFrame], live: Callable[[], DataFrame] | None,
               path: str, checkpoint: str, size: int = 200, min_confidence: float = MIN_CONFIDENCE, z_floor: float = 1.0) -> StreamingQuery:
    """Score the new bars of each micro-batch on the bars held in state, and store their signals by date.

    ``score`` adds features and a ``probability`` to bars in order and leaves out
    incomplete rows. ``live`` gives the one-row live z-score (``zscore``), read again in
    every micro-batch; a long entry then also needs it above ``z_floor``. A z-score
    that does not exist holds entries back.
    """

    def emit(micro: DataFrame, epoch: int) -> None:
        held = materialized(micro, "ring")
        scored = score(held).filter(F.col("_new") == 1).drop("_new")
        if live is None:
            label = signal_label(F.col("probability"), min_confidence)
        else:
            row = live().first()
            z = F.lit(row.zscore if row else None).cast("double")
            scored, label = scored.withColumn("live_zscore", z), gated_signal_label(F.col("probability"), z, min_confidence, z_floor)
        rows = materialized(scored.withColumn("signal", label).withColumn("date", F.to_date("open_time")), "signals")
        tables.upsert_partitions(rows, path, ["symbol", "open_time"], ["date"], staged=f"{checkpoint}/merged/{epoch}")

    return (ring_stream(bars, history, size).writeStream.outputMode("update").foreachBatch(emit)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def score_stream(bars: DataFrame, history: Callable[[], DataFrame], score: Callable[[DataFrame], DataFrame],
                 path: str, checkpoint: str, size: int = 200,
                 min_confidence: float = MIN_CONFIDENCE) -> StreamingQuery:
    """Score every new bar after each micro-batch and store its signal.

    ``history`` reads the bars stored so far, which may already hold the new ones;
    ``score`` adds features and a ``probability`` and leaves out incomplete rows. A
    symbol without new bars gives no signal, nor does a new bar that is incomplete.
    Each new bar sees at least the ``size`` bars before it.
    """

    def emit(micro: DataFrame, epoch: int) -> None:
        keys = ["symbol", "open_time"]
        stored = history()
        new = materialized(micro.select(*stored.columns).dropDuplicates(keys), "new-bars")
        marks = new.select(*keys).withColumn("_new", F.lit(1))
        known = stored.join(new.select("symbol").distinct(), "symbol", "left_semi").join(marks, keys, "left_anti")
        bars_now = known.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        back = Window.partitionBy("symbol").orderBy(F.desc("open_time"))
        # New bars among the newer ones keep a bar in reach of the oldest of them.
        ahead = F.max("_at").over(Window.partitionBy("symbol"))
        recent = (
            bars_now.withColumn("_nth", F.row_number().over(back))
            .withColumn("_at", F.when(F.col("_new") == 1, F.col("_nth")))
            .withColumn("_oldest", ahead).filter(F.col("_nth") <= F.col("_oldest") + size)
            .select(*stored.columns)
        )
        scored = score(recent).join(marks.drop("_new"), keys, "left_semi")
        scored.withColumn("signal", signal_label(F.col("probability"), min_confidence)).write.mode(
            "overwrite").parquet(f"{path}/epoch={epoch}")

    return (bars.writeStream.foreachBatch(emit).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
