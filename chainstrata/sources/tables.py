"""Table layouts on Parquet: height batches, months, years, dated snapshots, signal files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chainstrata.operators.candles import keep_one
from chainstrata.session import COMPACT, at_once, scratch_path
from chainstrata.sources import versions

# Fixed value: blocks per batch, where a table is not made with another width.
BATCH_BLOCKS = 250
# Rows are not shuffled where a task's file in every partition holds so many bytes on average; a task reads about SPLIT.
SMALLEST_FILE = 256 * 1024
SPLIT = 128 * 1024 * 1024
# Bytes of source files for each core that are derived in one go, so that a task's rows are sorted in memory.
GROUP = 32 * 1024 * 1024
# Sets of integers are broadcast up to so many words of 64 bits.
MOST_WORDS = 2**21
# Beside staged partitions: the folders that are to move, listed before the first one does.
MOVING = "_moving.txt"
SIGNAL_SCHEMA = "timestamp string, price double, signal string, confidence double, zscore double, rsi double"


def batch_id(height: Column, blocks: int = BATCH_BLOCKS) -> Column:
    return F.floor(height / F.lit(blocks)).cast("bigint")


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def reset(spark: SparkSession, path: str) -> None:
    """Drop a table's files so that a load starts over."""
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    if exists(spark, path):
        return spark.read.schema(like.schema).parquet(path)
    return like.filter("false")


def _writer(df: DataFrame, by: Sequence[str], sort: Sequence[str], spread: bool = True):
    """Writer of rows laid out in partitions.

    The rebalance hint lets AQE split a heavy partition over several tasks and
    files and merge light ones. Without ``spread`` rows are not shuffled: every task
    writes those it has, so they ought to come in large files or partition by partition.
    """
    out = df.hint("rebalance", *by) if spread else df
    if sort:
        out = out.sortWithinPartitions(*by, *sort)
    options = COMPACT if list(by) == ["batch_id"] else {"compression": "zstd"}
    return out.write.mode("overwrite").options(**options).partitionBy(*by)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), spread: bool = True,
                       staged: str | None = None) -> None:
    """Overwrite exactly the partitions ``df`` has rows for.

    ``staged`` may name the folder ``df`` is read from, if it is laid out by the same
    partitions: its files then move and are not written again, in a store that can move them.
    """
    if staged is None or not _move_partitions(df.sparkSession, staged, path, len(by)):
        _writer(df, by, sort, spread).option("partitionOverwriteMode", "dynamic").parquet(path)


def _partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Names of the folders of a table's partitions, ``a=1/b=2``."""
    fs, where = _hadoop(spark, path)
    names = [""]
    for _ in range(depth):
        names = [f"{n}/{s.getPath().getName()}".lstrip("/") for n in names
                 for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}" if n else path))
                 if s.isDirectory() and "=" in s.getPath().getName() and s.getPath().getName()[0] not in "._"]
    return names


def _staged_folders(spark: SparkSession, staged: str, depth: int) -> list[str]:
    """The partitions that were staged, those included that moved before a crash."""
    if exists(spark, f"{staged}/{MOVING}"):
        return versions.text(spark, f"{staged}/{MOVING}").splitlines()
    names = _partition_folders(spark, staged, depth)
    versions.put(spark, f"{staged}/{MOVING}", "\n".join(names))
    return names


def _move_partitions(spark: SparkSession, staged: str, path: str, depth: int) -> bool:
    """Put staged partitions in the place of the table's; a repetition moves those still there. False if the store cannot."""
    (fs, _), (to, _) = _hadoop(spark, staged), _hadoop(spark, path)
    if fs.getUri() != to.getUri():
        return False
    at = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    for i, name in enumerate(_partition_folders(spark, staged, depth)):
        target = at(path, name)
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        try:
            moved = fs.rename(at(staged, name), target)
        except Py4JJavaError:  # such as a move between mounts
            moved = False
        if not moved:
            if i:
                raise OSError(f"{staged}/{name} does not move to {target}; a repetition goes on there")
            return False
    spark.catalog.refreshByPath(path)
    return True


def _bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    out = 0
    for path in paths:
        fs, where = _hadoop(spark, path)
        out += fs.getContentSummary(where).getLength() if fs.exists(where) else 0
    return out


def _needs_spread(spark: SparkSession, size: int, partitions: int) -> bool:
    """Whether tasks that read ``size`` bytes would leave tiny files, were each to write to all partitions."""
    tasks = max(spark.sparkContext.defaultParallelism, size // SPLIT)
    return size < tasks * partitions * SMALLEST_FILE


def bit_words(df: DataFrame, name: str) -> DataFrame:
    """A set of integers as words of 64 bits: ``_word`` and ``_bits``."""
    return df.select(F.col(name).cast("bigint").alias("_n")).filter("_n IS NOT NULL").groupBy(
        F.expr("shiftright(_n, 6)").alias("_word")).agg(F.expr("bit_or(shiftleft(1L, CAST(_n & 63 AS INT)))").alias("_bits"))


def numbers(words: DataFrame, name: str) -> DataFrame:
    """The integers of ``bit_words``, each once."""
    return words.select("_word", "_bits", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_at")).filter(
        "shiftright(_bits, _at) & 1 = 1").select(F.expr("shiftleft(_word, 6) + _at").alias(name))


def _without(rows: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``gone``.

    Integers are packed in words, at most MOST_WORDS of which are broadcast, so that
    the rows stay where they are; more of them, and other keys, meet the rows in a join.
    """
    if len(keys) == 1 and dict(rows.dtypes)[keys[0]] == dict(gone.dtypes)[keys[0]] == "bigint":
        words = bit_words(gone, keys[0])
        if words.limit(MOST_WORDS + 1).count() <= MOST_WORDS:
            key = F.col(keys[0])
            met = rows.join(F.broadcast(words), F.shiftright(key, 6) == F.col("_word"), "left")
            free = F.expr(f"_bits IS NULL OR shiftright(_bits, CAST(`{keys[0]}` & 63 AS INT)) & 1 = 0")
            return met.filter(free).select(*rows.columns)
    return rows.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def write_batches(df: DataFrame, path: str, batches: Sequence[int] | None = None,
                  built_from: dict[int, dict[str, str]] | None = None, blocks: int | None = None, spread: bool = True) -> None:
    """Height-keyed table in batches of blocks; rerunning a batch replaces it.

    ``batches`` names the batches ``df`` stands for; those without rows are removed.
    Left out, they are found by a pass over the heights of ``df``. A batch is a folder:
    ``blocks`` gives a new table wider ones, so that small blocks fill them. The table
    keeps its width. Without ``spread`` rows are written by the tasks that have them.
    """
    blocks = versions.keep_width(df.sparkSession, path, blocks, BATCH_BLOCKS)
    spark, rows = df.sparkSession, df.withColumn("batch_id", batch_id(F.col("height"), blocks))
    if batches is None:
        batches = [r.batch_id for r in rows.select("batch_id").distinct().collect()]
    versions.begin(spark, path, batches)
    _replace_batches(rows, path, batches, ["height"], spread)
    versions.commit(spark, path, batches, built_from)


def _part_files(spark: SparkSession, path: str, batches: Iterable[int]) -> dict[int, set[str]]:
    out = {}
    for batch in batches:
        fs, where = _hadoop(spark, f"{path}/batch_id={batch}")
        out[batch] = {s.getPath().getName() for s in fs.listStatus(where)} if fs.exists(where) else set()
    return out


def _replace_batches(df: DataFrame, path: str, batches: Sequence[int], sort: Sequence[str], spread: bool = True) -> None:
    """``replace_partitions`` that also removes batches ``df`` has no rows for: their files stay the same."""
    spark = df.sparkSession
    before = _part_files(spark, path, batches)
    replace_partitions(df, path, ["batch_id"], sort, spread)
    after = _part_files(spark, path, batches)
    _drop_batches(spark, path, [b for b in batches if before[b] and before[b] == after[b]])


def _groups(sizes: dict[int, int], most: int) -> list[list[int]]:
    """Batches in order, as many together as hold ``most`` bytes, or one."""
    out, held = [], 0
    for batch, size in sorted(sizes.items()):
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1].append(batch)
        held += size
    return out


def _drop_batches(spark: SparkSession, path: str, batches: Iterable[int]) -> None:
    for batch in batches:
        reset(spark, f"{path}/batch_id={batch}")


def read_heights(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Rows of a closed height range: whole batches are pruned, then row groups."""
    blocks = versions.width(spark, path, BATCH_BLOCKS)
    batches = F.col("batch_id").between(first // blocks, last // blocks)
    return spark.read.parquet(path).filter(batches & F.col("height").between(first, last))


def tip_height(df: DataFrame) -> DataFrame:
    return df.agg(F.max("height").alias("tip"))


def _partition_filter(values: Sequence, by: Sequence[str]) -> Column:
    """Condition on partition columns that prunes directories."""
    if len(by) == 1:
        return F.col(by[0]).isin(*[v[0] for v in values])
    test = F.lit(False)
    for value in values:
        one = F.lit(True)
        for name, part in zip(by, value):
            one = one & (F.col(name) == part)
        test = test | one
    return test


def upsert_partitions(new: DataFrame, path: str, keys: Sequence[str], by: Sequence[str],
                      newest_wins: bool = True, staged: str | None = None, arrived: DataFrame | None = None,
                      touched: Sequence[tuple] | None = None, progress: str | None = None,
                      keep: Callable[[DataFrame], DataFrame] | None = None, read_from: str | None = None) -> None:
    """Merge rows into the partitions they touch.

    With ``newest_wins`` all stored rows whose key arrives again give way, so a
    key may stand for a group of rows (a block's transactions). Otherwise the
    stored row stays and ``new`` adds one row per unknown key. ``arrived`` may name
    the keys that give way, as some may have no rows any more, and ``touched`` the
    partitions. With ``progress`` a key has one row, the one with the largest value
    in that column, stored or new: a partial row never replaces a fuller one. ``keep``
    may choose among the merged rows of the partitions. ``read_from`` names the folder
    ``new`` is read from without a shuffle, if it is: large merges then shuffle nothing.

    The merged partitions are first written to ``staged`` (by default a fresh
    path in the shared folder), laid out like the table, and their files then moved in. A rerun with the same path
    after a failure finds that copy and only repeats the swap, so no row is lost
    in between. Only partition values (directory names) reach the driver. Batch
    tables (``by`` batch_id) record a version of every batch touched.
    """
    spark = new.sparkSession
    staged = staged or scratch_path(spark, "upsert")
    touched = touched if touched is not None else [tuple(r) for r in new.select(*by).distinct().collect()]
    if not exists(spark, f"{staged}/_SUCCESS"):
        if not touched:
            return
        old = read_or_empty(spark, path, new).filter(_partition_filter(touched, by))
        if progress:
            rest = F.xxhash64(*[c for c in new.columns if c not in keys])
            merged = keep_one(old.unionByName(new), keys, [F.desc(progress), rest])
        elif newest_wins:
            merged = _without(old, new if arrived is None else arrived, keys).unionByName(new)
        else:
            both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
            rest = F.xxhash64(*[c for c in new.columns if c not in keys])
            merged = keep_one(both, keys, [F.col("_age"), rest]).drop("_age")
        if keep:
            merged = keep(merged)
        spread = True
        if read_from and newest_wins and list(by) == ["batch_id"]:
            stored = (f"{path}/batch_id={v[0]}" for v in touched)
            spread = _needs_spread(spark, _bytes(spark, [read_from, *stored]), len(touched))
        _writer(merged, by, list(keys), spread).option("partitionOverwriteMode", "static").parquet(staged)
    batches = [v[0] for v in touched] if list(by) == ["batch_id"] else []
    versions.begin(spark, path, batches)
    whole = set(_staged_folders(spark, staged, len(by)))
    replace_partitions(spark.read.schema(new.schema).parquet(staged), path, by, list(keys), staged=staged)
    _drop_batches(spark, path, [b for b in batches if f"batch_id={b}" not in whole])
    versions.commit(spark, path, batches)
    reset(spark, staged)


def rollback(spark: SparkSession, path: str, last_height: int) -> None:
    """Remove everything above ``last_height``: later batches go, a cut one is rewritten.

    Tables built from this one follow with their next ``refresh_batches``.
    """
    cut = last_height // versions.width(spark, path, BATCH_BLOCKS)
    fs, where = _hadoop(spark, path)
    later = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("batch_id=")
             and int(s.getPath().getName().split("=")[1]) > cut]
    gone = {int(p.getName().split("=")[1]) for p in later} | {b for b in versions.state(spark, path) if b > cut}
    edge = spark.read.parquet(path).filter(F.col("batch_id") == cut)
    above = not edge.filter(F.col("height") > last_height).isEmpty()
    changed = {cut} if above else set()
    if above:
        kept, staged = edge.filter(F.col("height") <= last_height), scratch_path(spark, "rollback")
        kept.write.options(**COMPACT).parquet(staged)
        rest = spark.read.schema(kept.schema).parquet(staged)
    versions.begin(spark, path, changed | gone)
    if above and rest.isEmpty():
        reset(spark, f"{path}/batch_id={cut}")
        gone.add(cut)
    elif above:
        replace_partitions(rest, path, ["batch_id"], ["height"])
    if above:
        reset(spark, staged)
    for folder in later:
        fs.delete(folder, True)
    versions.commit(spark, path, changed - gone, gone=gone)
    spark.catalog.refreshByPath(path)


def rollback_all(spark: SparkSession, paths: Iterable[str], last_height: int) -> None:
    """``rollback`` of several tables at once."""
    at_once(partial(rollback, spark, path, last_height) for path in paths)


def refresh_batches(spark: SparkSession, sources: dict[str, str], lead: str, target: str,
                    build: Callable[[dict[str, DataFrame]], DataFrame], row_by_row: bool = False) -> list[int]:
    """Bring a derived table up to date with its sources, whole batches at a time.

    ``lead`` names the source whose batches the table has; all sources have its width. Built are the batches of
    which any source has another version than at the last build, so late rows,
    replaced blocks and cut tails arrive; batches gone from ``lead`` are removed. A
    batch is always rebuilt completely and replaced, so reruns neither lose nor
    repeat rows. Which batches are due is known without reading data. With ``row_by_row``
    ``build`` makes rows from single rows of the same height, without a shuffle: large
    batches are then built some at a time and written by the tasks that read them.
    """
    due, gone = versions.due(spark, sources, lead, target)
    if gone:
        versions.begin(spark, target, gone)
        _drop_batches(spark, target, gone)
        versions.commit(spark, target, [], gone=gone)
    if due:
        batches, width = sorted(due), versions.width(spark, sources[lead], BATCH_BLOCKS)
        frames = {name: spark.read.parquet(path) for name, path in sources.items()}
        of = lambda some: build({name: f.filter(F.col("batch_id").isin(*some)) for name, f in frames.items()})
        sizes = {b: _bytes(spark, [f"{path}/batch_id={b}" for path in sources.values()]) for b in batches} if row_by_row else {}
        spread = not row_by_row or _needs_spread(spark, sum(sizes.values()), len(batches))
        for some in [batches] if spread else _groups(sizes, spark.sparkContext.defaultParallelism * GROUP):
            write_batches(of(some), target, some, {b: due[b] for b in some}, width, spread)
    if due or gone:
        spark.catalog.refreshByPath(target)
    return sorted(due)


def with_month(candles: DataFrame) -> DataFrame:
    return candles.withColumns({"year": F.year("open_time"), "month": F.month("open_time")})


def upsert_candles(new: DataFrame, path: str, keys: Sequence[str] = ("open_time",)) -> None:
    """Add candles; a candle already stored stays, only touched months are rewritten."""
    upsert_partitions(with_month(new), path, list(keys), ["year", "month"], newest_wins=False)


def delete_candles_from(spark: SparkSession, path: str, cut: Column) -> None:
    """Remove candles at or after ``cut``, keeping the earlier days of its month."""
    table = spark.read.parquet(path)
    months = [tuple(r) for r in table.filter(F.col("open_time") >= cut).select("year", "month").distinct().collect()]
    if not months:
        return
    staged = scratch_path(spark, "cut")
    kept = table.filter(_partition_filter(months, ["year", "month"]) & (F.col("open_time") < cut))
    kept.write.parquet(staged)
    rest = spark.read.schema(kept.schema).parquet(staged)
    left = {tuple(r) for r in rest.select("year", "month").distinct().collect()}
    replace_partitions(rest, path, ["year", "month"], ["open_time"])
    for year, month in months:
        if (year, month) not in left:
            reset(spark, f"{path}/year={year}/month={month}")
    spark.catalog.refreshByPath(path)


def write_years(daily: DataFrame, path: str, date: str = "date") -> None:
    """Full rewrite of a daily table, one partition per year."""
    out = daily.withColumn("year", F.year(date))
    out.hint("rebalance", "year").sortWithinPartitions("year", date).write.mode("overwrite").partitionBy("year").parquet(path)


def write_dated(df: DataFrame, path: str, as_of: str) -> None:
    """Keep one version per date; writing a date again replaces it."""
    replace_partitions(df.withColumn("as_of", F.to_date(F.lit(as_of))), path, ["as_of"])


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The version with the newest date."""
    table = spark.read.parquet(path)
    return table.filter(F.col("as_of") == table.agg(F.max("as_of")).scalar())


def append_weeks(snapshots: DataFrame, path: str) -> None:
    """Store weekly snapshots; a week that runs twice is stored once."""
    replace_partitions(snapshots, path, ["week"])


def write_query(df: DataFrame, path: str, block_bytes: int = 128 * 1024 * 1024) -> None:
    """Result of a query to Parquet with a chosen row-group size."""
    df.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", block_bytes).parquet(path)


def write_clustered(df: DataFrame, path: str, key: str) -> None:
    """Files with disjoint, sorted key ranges, so that range reads skip most row groups."""
    df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def append_signals(signals: DataFrame, path: str) -> None:
    signals.write.mode("append").option("header", True).csv(path)


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SIGNAL_SCHEMA).option("header", True).csv(path)
