"""Importance resampling of documents towards a target distribution, with hashed word n-grams.

Features fall into buckets by the CRC-32 of their bytes. A batch's distinct features
are grouped by byte length; each group is a two-dimensional uint8 array whose CRCs
are all updated column by column, and the results are scattered back to the distinct
features and from there to every occurrence. Words are cut from the Arrow buffers
themselves, without a Python object per word.

Ranks need no ordering of all documents in one place: scores are whole numbers in a
range that the formulas bound, so counts per score give each score's first rank, and
documents are numbered within their score only.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.llm.columns import ROW_KEY, in_small_batches, row_key
from chainstrata.session import materialized

NGRAMS, BUCKETS, SEED, LEAST_WORDS = 1, 10_000, 2024, 20
SHARE = (10, 100)
# Features of more bytes are so rare that a column step each would cost more than it saves.
LONG = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _crc_table() -> np.ndarray:
    """The byte table of the reflected CRC-32 polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def crc_matrix(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a two-dimensional uint8 array, all rows a column at a time."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def crcs(features: pa.Array) -> np.ndarray:
    """CRC-32 of every value of a binary array without nulls."""
    n = len(features)
    offsets = np.frombuffer(features.buffers()[1], np.int64, n + 1, features.offset * 8)
    data = np.frombuffer(features.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    out = np.zeros(n, np.uint32)
    order = np.argsort(sizes, kind="stable")
    lengths, first = np.unique(sizes[order], return_index=True)
    for length, places in zip(lengths.tolist(), np.split(order, first[1:])):
        if length > LONG:
            for i in places.tolist():
                out[i] = zlib.crc32(data[offsets[i]:offsets[i + 1]])
        elif length:
            out[places] = crc_matrix(data[offsets[places][:, None] + np.arange(length)])
    return out


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as one binary array, and the number of words of each text (null: none).

    Words are runs of digits, a-z and everything beyond ASCII, after lower-casing A-Z.
    """
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]]
    inside = _IN_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets - offsets[0]
    fresh = edges[edges < len(data)]
    starts[fresh] = inside[fresh]
    at = np.flatnonzero(starts)
    ends = np.append(np.cumsum(inside)[at] - 1, inside.sum()) if len(at) else np.zeros(1, np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(at), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    return found, np.diff(np.searchsorted(at, edges))


def feature_buckets(texts: pa.Array, ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, the text it is of, and the number of words of each text."""
    singles, counts = words(texts)
    of_text = np.repeat(np.arange(len(counts)), counts)
    grams, owner, found, owners = singles, of_text, [], []
    for n in range(1, ngrams + 1):
        if n > 1:
            grams = pc.binary_join_element_wise(grams[:-1], singles[n - 1:], pa.scalar(b" ", pa.large_binary())) if len(grams) else grams
            owner = owner[:len(grams)]
        whole = of_text[n - 1:] == owner if n > 1 else np.ones(len(owner), bool)
        coded = grams.dictionary_encode()
        found.append((crcs(coded.dictionary) % np.uint32(buckets)).astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)][whole])
        owners.append(owner[whole])
    return np.concatenate(found), np.concatenate(owners), counts


def _counting(ngrams: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(feature_buckets(batch.column(0), ngrams, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, text: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over a whole table. At most ``buckets`` numbers reach the driver."""
    parts = in_small_batches(texts).select(F.col(text)).mapInArrow(_counting(ngrams, buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target, one feature added to every bucket."""
    s, t, n = corpus.astype(float), target.astype(float), float(len(corpus))
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighing(gain: np.ndarray, ngrams: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner, n_words = feature_buckets(batch.column(batch.num_columns - 1), ngrams, len(gain))
            rows = batch.num_rows
            n = np.bincount(owner, minlength=rows)
            # Doubles hold these whole sums exactly: a batch has far fewer than 2^36 features of 17 bits.
            total = np.bincount(owner, gain[found], rows).astype(np.int64)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight)],
                [*batch.schema.names[:-1], "n_words", "n_features", "weight"])
    return run


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 g) of a Gumbel number that the seed and the id alone determine."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
          ngrams: int = NGRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """A stored row (id, row key, n_words, n_features, weight, score) for every document."""
    gain = gains(bucket_counts(docs, text, ngrams, buckets), bucket_counts(target, target_text, ngrams, buckets))
    rows = in_small_batches(docs).select(F.col(doc_id).cast("bigint").alias("id"), *row_key(F.col(doc_id), F.col(text)), F.col(text).alias("_body"))
    schema = "id bigint, _no_id boolean, _id bigint, _text_hash bigint, n_words bigint, n_features bigint, weight bigint"
    weighed = rows.mapInArrow(_weighing(gain, ngrams), schema)
    return materialized(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "importance")


def draw(weighed: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``weighed`` with ``rank`` from 1 for the drawn documents and null for the others.

    Of the documents with at least ``least_words`` words the share (rounded down) of
    highest scores is drawn, ties to smaller ids.
    """
    able = weighed.filter(F.col("n_words") >= least_words)
    per_score = able.groupBy("score").agg(F.count("*").alias("_n"))
    # As many rows as there are scores: whole thousandths of logarithms, some hundred thousand at any size.
    down = Window.orderBy(F.desc("score"))
    before = per_score.select("score", (F.sum("_n").over(down) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    wanted = F.expr(f"_all * {share[0]} div {share[1]}")
    reach = before.withColumn("_wanted", wanted).filter("_before < _wanted").select("score", "_before", "_wanted")
    joined = weighed.join(F.broadcast(reach), "score", "left")
    inside = joined.filter((F.col("n_words") >= least_words) & F.col("_before").isNotNull())
    same = Window.partitionBy("score").orderBy("_no_id", "_id", "_text_hash")
    place = F.col("_before") + F.row_number().over(same)
    ranked = inside.withColumn("rank", F.when(place <= F.col("_wanted"), place))
    rest = joined.filter((F.col("n_words") < least_words) | F.col("_before").isNull()).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).drop("_before", "_wanted")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The drawn documents as ``row`` (the input row as a struct) with weight, score and rank.

    Null texts have no words, weight 0 and are never drawn, nor are texts of fewer
    than ``LEAST_WORDS`` words. Rows without an id share one random number and come
    after the others in ties; equal rows may each be drawn, with ranks of their own.
    Texts of any length are read whole. Without documents the result is empty;
    without target texts only the corpus counts shape the weights.
    """
    drawn = draw(weigh(docs, target, doc_id, text, **settings)).filter(F.col("rank").isNotNull())
    key = [*ROW_KEY, "_copy"]
    copy = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(F.lit(0))).alias("_copy")
    chosen = drawn.select(*ROW_KEY, F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy("rank")).alias("_copy"), "weight", "score", "rank")
    rows = docs.select(F.struct("*").alias("row"), *row_key(F.col(doc_id), F.col(text))).select("row", *ROW_KEY, copy)
    return rows.join(chosen, key).drop(*key)
