"""Exact top-k search by distributed histogram selection.

Everything is scored, in blocks of queries against blocks of rows. A first pass
counts each query's scores in wide bins and adds the counts over all blocks, which
tells the bin that holds the k-th best score; further passes split only that bin,
until the k-th value is known or few scores are left at or above it. A last pass
scores again, keeps what reaches the value, and breaks ties by id.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.llm import vectors as v
from chainstrata.session import materialized

K, SCALE = 5, 256
QUERY_BLOCK, ROW_BLOCK, GROUP = 1024, 2048, 16
STEP_BITS = 8
ENOUGH = 4  # stop refining once every query has at most this many times k scores left
_EXACT = float(1 << 53)
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
_LARGEST = sys.float_info.max


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as double, computed in double precision and held at the largest one."""
    return F.transform(vector, lambda x: _floor(F.greatest(F.least(x.cast("double") * scale, F.lit(_LARGEST)), F.lit(-_LARGEST))))


def _floor(x: Column) -> Column:
    # floor() gives a long and would fail beyond its range; such doubles are whole already.
    return F.when(F.abs(x) >= _EXACT, x).otherwise(F.floor(F.when(F.abs(x) < _EXACT, x)).cast("double"))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole inner products as int64; exact, and held at the limits of int64 beyond them."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    largest = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    if largest < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in queries], object) @ np.array([[int(x) for x in r] for r in rows], object).T
    return np.clip(whole, _LOW, _HIGH).astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]):
    """(q, g, query ids, extras, scores, row ids, allowed) for every meeting of two blocks."""
    for batch in batches:
        at = {n: i for i, n in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            def one(name: str):
                return batch.column(at[name])[i].as_py()
            ids, others = v.ids_of(one("ids")), v.ids_of(one("c_ids"))
            if not len(ids) or not len(others):
                continue
            found = scores(v.matrix(one("vectors"), len(ids)), v.matrix(one("c_vectors"), len(others)))
            yield one("q"), one("g"), ids, one, found, others, ids[:, None] != others[None, :]


def _histogram(shift: int, above: int, k: int):
    """Counts of scores by ``score >> shift``, within each query's bin of the pass before (``score >> above``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = None, {}

        def rows() -> pa.RecordBatch:
            keys = list(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()), pa.array(list(counts.values()), pa.int64())],
                ["query_id", "bin", "n"])

        for q, g, ids, one, found, others, allowed in _pairs(batches):
            if held != (q, g):
                if counts:
                    yield rows()
                held, counts = (q, g), {}
            inside = np.frombuffer(one("bins"), np.int64) if above else None
            for i, query in enumerate(ids.tolist()):
                own = found[i][allowed[i]]
                if above:
                    own = own[own >> above == inside[i]]
                if not len(own):
                    continue
                bins, n = np.unique(own >> shift, return_counts=True)
                # Bins below this block's own k-th best cannot hold the overall one.
                first = max(0, len(n) - 1 - int(np.searchsorted(np.cumsum(n[::-1]), k)))
                for b, c in zip(bins[first:].tolist(), n[first:].tolist()):
                    counts[query, b] = counts.get((query, b), 0) + c
        if counts:
            yield rows()
    return run


def _survivors(k: int):
    """Rows that reach each query's floor; of a group the best ``k``, ties to smaller ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, best = None, {}

        def rows() -> pa.RecordBatch:
            flat = [(query, r, s) for query, found in best.items() for s, r in found]
            return pa.RecordBatch.from_arrays([pa.array([x[j] for x in flat], pa.int64()) for j in range(3)], ["query_id", "vec_id", "score"])

        for q, g, ids, one, found, others, allowed in _pairs(batches):
            if held != (q, g):
                if best:
                    yield rows()
                held, best = (q, g), {}
            floors = np.frombuffer(one("bins"), np.int64)
            for i, query in enumerate(ids.tolist()):
                keep = np.flatnonzero(allowed[i] & (found[i] >= floors[i]))
                if not len(keep):
                    continue
                if len(keep) > k:  # ~s falls as s rises, and unlike -s it cannot overflow
                    keep = keep[np.lexsort((others[keep], ~found[i][keep]))[:k]]
                more = best.get(query, []) + list(zip(found[i][keep].tolist(), others[keep].tolist()))
                best[query] = sorted(more, key=lambda x: (-x[0], x[1]))[:k]
        if best:
            yield rows()
    return run


def _with_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put each query's number (its bin or floor) in the order of its block's ids."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = v.ids_of(batch.column(1)[i].as_py())
            known = {r["query_id"]: r["value"] for r in batch.column(3)[i].as_py() or []}
            yield pa.RecordBatch.from_arrays(
                [batch.column(j).slice(i, 1) for j in range(3)]
                + [pa.array([np.array([known.get(q, _HIGH) for q in ids.tolist()], np.int64).tobytes()], pa.binary())],
                ["block", "ids", "vectors", "bins"])


def _attach(queries: DataFrame, places: DataFrame, values: DataFrame) -> DataFrame:
    """Query blocks with a number per query, from (query_id, value); blocks bound the lists."""
    lists = places.join(values, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "value")).alias("found"))
    return queries.join(lists, "block", "left").select("block", "ids", "vectors", "found").mapInArrow(
        _with_bins, v.BLOCK + ", bins binary")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = v.ids_of(batch.column(1)[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), batch.column(0)[i].as_py())), pa.array(ids)], ["block", "query_id"])


def _one_length(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) candidates for the top k, all vectors being of one length."""
    queries, n_queries = v.blocks(asked, QUERY_BLOCK)
    offered, n_rows = v.blocks(rows, ROW_BLOCK)
    places = materialized(queries.mapInArrow(_places, "block bigint, query_id bigint").distinct(), "query-places")
    norms = rows.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 0.0
    top = max(1, min(63, int(norms).bit_length() + 1)) if math.isfinite(norms) else 63  # |score| is at most the largest squared length
    state = places.select("query_id", F.lit(k).cast("bigint").alias("want")).distinct()
    above, inside = 0, queries.withColumn("bins", F.lit(b"").cast("binary"))
    shift = max(0, top - STEP_BITS)
    while True:
        found = v.meet(inside, n_queries, offered, n_rows, GROUP, _histogram(shift, above, k), "query_id bigint, bin bigint, n bigint")
        bins = found.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        counted = bins.join(state, "query_id").withColumn("upto", F.sum("n").over(down))
        # The bin in which the wanted number is reached; the lowest one if there are fewer.
        lowest = Window.partitionBy("query_id")
        at = counted.withColumn("last", F.min("bin").over(lowest)).filter(
            ((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want")))
            | ((F.col("upto") < F.col("want")) & (F.col("bin") == F.col("last"))))
        state = materialized(at.select("query_id", "bin", (F.col("want") - F.col("upto") + F.col("n")).alias("want"),
                                       "n"), "kth-bins")
        left = state.agg(F.max(F.col("n"))).first()[0]
        if shift == 0 or left is None or left <= ENOUGH * k:
            break
        above, shift = shift, max(0, shift - STEP_BITS)
        inside = materialized(_attach(queries, places, state.select("query_id", F.col("bin").alias("value"))), "query-bins")
        state = state.select("query_id", "want")
    floors = state.select("query_id", F.shiftleft("bin", shift).alias("value"))
    reach = materialized(_attach(queries, places, floors), "query-floors")
    return v.meet(reach, n_queries, offered, n_rows, GROUP, _survivors(k), "query_id bigint, vec_id bigint, score bigint")


def lengths(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(F.size("vector")).distinct().collect())


def top_k(rows: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest whole inner product for each query row.

    Components become floor(scale * x). A query's candidates are all rows but those
    of its own id; ties go to the smaller id, equal rows may both appear. Vectors
    null or holding null or non-finite components, and rows without an id, take no
    part; vectors of another length are no candidates. Scores beyond a long are
    held at its limits. Fewer candidates than ``k``: all of them. Query rows equal in
    id and vector are one query; different vectors of one id are ranked together.
    """
    given = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).alias("vector"), is_query.alias("asked"))
    good = materialized(given.filter(F.col("id").isNotNull() & v.usable(F.col("vector"))).select(
        "id", quantized(F.col("vector"), scale).alias("vector"), "asked"), "quantized")
    found = None
    for length in lengths(good):
        same = good.filter(F.size("vector") == length)
        part = _one_length(same.select("id", "vector"), same.filter("asked").select("id", "vector").distinct(), k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return given.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
