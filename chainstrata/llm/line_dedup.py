"""Exact line deduplication that returns keep bitmaps, in DataFrame operations only.

Lines travel as two hashes (128 bits), a document and a position. They are dealt
by hash ranges and sorted by document and position, so that a streaming window
sees each line's first document first. A very common line does not land in one
task: a first pass deals by (hash, slice of documents), drops what a document of
the same slice holds already, and lets only each slice's first document through
to a second pass over the hashes alone. A line thus reaches the second pass at
most once per slice, with as many slices as shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.llm.columns import BLANK, ROW_KEY, ascii_lower, row_key, shuffle_width
from chainstrata.session import materialized

MIN_CHARS = 10


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(BLANK)))


def _later(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Mark lines that an earlier document of the same keys holds too (column ``_repeat``)."""
    order = Window.partitionBy(*keys).orderBy("_no_id", "_id", "_position")
    first = F.first(F.struct("_no_id", "_id")).over(order)
    return lines.withColumn("_repeat", first != F.struct("_no_id", "_id"))


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Runs of lines to drop, for the documents that have any.

    One row per distinct (id, text) with ``starts`` and ``ends`` (exclusive), the
    0-based line positions of the runs. A null text is an empty one; documents
    without an id come after all others, and count as one document.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(*row_key(F.col(doc_id), F.col(text)), F.posexplode(F.split(body, "\n")).alias("_position", "_line"))
    keyed = split.select(*ROW_KEY, "_position", line_key(F.col("_line")).alias("_key"))
    lines = keyed.filter(F.char_length("_key") >= min_chars).select(
        F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), F.col("_key")).alias("_h2"),
        F.pmod(F.xxhash64("_no_id", "_id"), F.lit(width)).cast("int").alias("_slice"), *ROW_KEY, "_position")
    sliced = lines.repartitionByRange(width, "_h1", "_h2", "_slice")
    marked = materialized(_later(sliced, ["_h1", "_h2", "_slice"]).drop("_slice"), "lines")
    heads = marked.filter(~F.col("_repeat")).drop("_repeat").repartitionByRange(width, "_h1", "_h2")
    dropped = (
        marked.filter("_repeat").select(*ROW_KEY, "_position")
        .unionByName(_later(heads, ["_h1", "_h2"]).filter("_repeat").select(*ROW_KEY, "_position"))
    )
    at = F.col("_at")
    return (
        dropped.groupBy(*ROW_KEY).agg(F.sort_array(F.collect_set("_position")).alias("_at"))
        .select(*ROW_KEY,
                F.filter("_at", lambda x, i: (i == 0) | (F.element_at(at, F.greatest(i, F.lit(1))) < x - 1)).alias("starts"),
                F.transform(F.filter("_at", lambda x, i: (i == F.size(at) - 1)
                                     | (F.element_at(at, F.least(i + 2, F.size(at))) > x + 1)), lambda x: x + 1).alias("ends"))
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Decide for every line of every row whether it stays.

    Returns ``row`` (the input row as a struct, so no column name can clash),
    ``n_lines``, ``n_dropped``, ``keep_bitmap`` and ``kept_text``. The bitmap is
    run-length coded: lengths of alternating runs of kept and dropped lines, kept
    first (0 if the first line goes). Texts are split at newlines; a null or empty
    text is one empty line and stays. Lines whose key has at least ``min_chars``
    code points and occurs in at least two documents stay only in the smallest
    document holding them, with all their occurrences there.
    """
    runs = repeated_runs(docs, doc_id, text, min_chars)
    body = docs.select(F.struct("*").alias("row"), *row_key(F.col(doc_id), F.col(text)))
    joined = body.join(runs, ROW_KEY, "left").select(
        "row", F.split(F.coalesce(F.col(f"row.`{text}`"), F.lit("")), "\n").alias("_lines"), "starts", "ends")
    starts, ends, lines = F.col("starts"), F.col("ends"), F.col("_lines")

    def before(i: Column) -> Column:
        return F.when(i == 0, F.lit(0)).otherwise(F.element_at(ends, F.greatest(i, F.lit(1))))

    last = F.element_at(ends, -1)
    bitmap = F.when(starts.isNull(), F.array(F.size(lines))).otherwise(F.concat(
        F.flatten(F.transform(starts, lambda s, i: F.array(s - before(i), F.element_at(ends, i + 1) - s))),
        F.array(F.size(lines) - last)))
    kept = F.when(starts.isNull(), F.col(f"row.`{text}`")).otherwise(F.array_join(F.concat(
        F.flatten(F.transform(starts, lambda s, i: F.slice(lines, before(i) + 1, s - before(i)))),
        F.slice(lines, last + 1, F.size(lines) - last)), "\n"))
    dropped = F.coalesce(F.aggregate(F.zip_with(ends, starts, lambda e, s: (e - s).cast("bigint")), F.lit(0).cast("bigint"),
                                     lambda a, x: a + x), F.lit(0))
    return joined.select("row", F.size(lines).cast("bigint").alias("n_lines"), dropped.cast("bigint").alias("n_dropped"),
                         bitmap.alias("keep_bitmap"), F.coalesce(kept, F.lit("")).alias("kept_text"))
