"""Vectors in blocks: queries meet all rows block by block, never row by row.

Rows are dealt evenly into blocks; a block is one row of a stored table with the
ids and the vectors of its rows as bytes. Query blocks and candidate blocks are
joined on (query block, group of candidate blocks), so work spreads over pairs of
blocks, memory holds two blocks, and one query block's state lives in one task for
a group at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chainstrata.session import materialized

BLOCK = "block bigint, ids binary, vectors binary"


def usable(vector: Column) -> Column:
    """Vectors that are neither null nor hold null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _pack(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column(1)[i].values
                ids = rows.field("id").to_numpy(zero_copy_only=False).astype(np.int64)
                values = rows.field("vector").flatten().to_numpy(zero_copy_only=False).astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([ids.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())],
                    ["block", "ids", "vectors"])
    return run


def blocks(rows: DataFrame, size: int, kind: str = "float64") -> tuple[DataFrame, int]:
    """A stored table of blocks of about ``size`` rows of (id, vector), and the number of blocks.

    Rows are dealt by a hash of their place in the input, so equal rows do not
    meet in one block more often than others.
    """
    count = max(1, -(-rows.count() // size))
    dealt = rows.select("id", "vector", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).alias("block"))
    grouped = dealt.groupBy("block").agg(F.collect_list(F.struct("id", "vector")).alias("rows"))
    return materialized(grouped.mapInArrow(_pack(kind), BLOCK), "vector-blocks"), count


def ids_of(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.int64)


def matrix(value: bytes, rows: int, kind: str = "float64") -> np.ndarray:
    return np.frombuffer(value, kind).reshape(rows, -1)


def meet(queries: DataFrame, query_blocks: int, candidates: DataFrame, candidate_blocks: int, group: int,
         run: Callable, schema: str) -> DataFrame:
    """Apply ``run`` to batches of (query block, group, columns of both) in order of query block and group.

    Query columns keep their names, candidate columns get the prefix ``c_``. Blocks
    are numbered from 0; every pair of them meets once.
    """
    groups = -(-candidate_blocks // group)
    asked = queries.withColumnRenamed("block", "q").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    offered = candidates.select(
        F.floor(F.col("block") / group).cast("int").alias("g"), *[F.col(c).alias(f"c_{c}") for c in candidates.columns],
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint"))).alias("q"))
    return asked.join(offered, ["q", "g"]).mapInArrow(run, schema)
