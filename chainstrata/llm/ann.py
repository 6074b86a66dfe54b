"""Approximate nearest neighbours by randomly rotated one-bit codes.

Each vector is rotated at random and kept as one sign bit per dimension plus two
scalars: its length, and the inner product of its unit vector with its code. The
inner product of a query with the code, corrected by these, is an unbiased estimate
of the true one, and its error bound is known. A row is reranked, by the exact inner
product of the original vectors, only if the upper end of its bound reaches the
query's k-th best exact score so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.llm import vectors as v
from chainstrata.llm.topk import lengths
from chainstrata.session import materialized

K, SEED = 20, 10
QUERY_BLOCK, ROW_BLOCK, GROUP = 512, 1024, 32
# Width of the error bound in standard deviations of the estimate.
SIGMAS = 2.5


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(rows: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, lengths, inner products of unit vectors with their unit codes) of non-zero rows."""
    # Scaled by a power of two first, as squares of large components overflow and those of small ones vanish.
    power = np.frexp(np.abs(rows).max(axis=1))[1]
    scaled = np.ldexp(rows, -power[:, None])
    size = np.linalg.norm(scaled, axis=1)
    turned = (scaled / size[:, None]) @ turn
    with np.errstate(over="ignore"):
        length = np.ldexp(size, power)
    return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(1) / np.sqrt(rows.shape[1])


def estimates(queries: np.ndarray, bits: np.ndarray, length: np.ndarray, fit: np.ndarray, turn: np.ndarray,
              sigmas: float = SIGMAS) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries and coded rows, and the half width of their bounds."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    power = np.frexp(np.abs(queries).max(axis=1, initial=0))[1]
    scaled = np.ldexp(queries, -power[:, None])
    near = ((scaled @ turn).astype(np.float32) @ signs.T).astype(float) / np.sqrt(dim)
    reach = np.linalg.norm(scaled, axis=1)
    spread = np.sqrt(np.maximum(1 - fit * fit, 0)) / fit / np.sqrt(max(dim - 1, 1))
    with np.errstate(over="ignore", invalid="ignore"):
        middle = np.ldexp(near * (length / fit), power[:, None])
        width = np.ldexp(sigmas * reach[:, None] * (length * spread), power[:, None])
    # A bound that cannot be told is no bound: such rows are looked at.
    lost = ~np.isfinite(middle) | ~np.isfinite(width)
    return np.where(lost, 0.0, middle), np.where(lost, np.inf, width)


def exact(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Inner products of chosen pairs in double precision, added component by component from the first."""
    out = np.zeros(len(q))
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(queries.shape[1]):
            out += queries[q, j] * rows[r, j]
    return np.where(np.isnan(out), -np.inf, out)


def _index(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                rows = v.matrix(batch.column(2)[i].as_py(), len(v.ids_of(batch.column(1)[i].as_py())))
                if rows.shape[1] not in turns:
                    turns[rows.shape[1]] = rotation(rows.shape[1], seed)
                bits, length, fit = encode(rows, turns[rows.shape[1]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(j).slice(i, 1) for j in range(3)]
                    + [pa.array([x.tobytes()], pa.binary()) for x in (bits, length, fit)],
                    ["block", "ids", "vectors", "bits", "lengths", "fits"])
    return run


def index(rows: DataFrame, seed: int = SEED) -> tuple[DataFrame, int]:
    """Every row's code beside its vector, in stored blocks; nothing is fitted to the data."""
    stored, count = v.blocks(rows, ROW_BLOCK)
    return materialized(stored.mapInArrow(_index(seed), v.BLOCK + ", bits binary, lengths binary, fits binary"), "one-bit-codes"), count


class _Best:
    """The best k exact scores per query of a block so far, ties to smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.free = np.ones((queries, k), bool)

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -scores, q))
        q, scores, ids = q[order], scores[order], ids[order]
        first = np.searchsorted(q, np.arange(len(self.scores)))
        nth = np.arange(len(q)) - first[q]
        q, scores, ids, nth = (x[nth < self.k] for x in (q, scores, ids, nth))
        wide_scores, wide_ids = np.full_like(self.scores, -np.inf), np.full_like(self.ids, np.iinfo(np.int64).max)
        wide_free = np.ones_like(self.free)
        wide_scores[q, nth], wide_ids[q, nth], wide_free[q, nth] = scores, ids, False
        both = [np.hstack(x) for x in ((self.scores, wide_scores), (self.ids, wide_ids), (self.free, wide_free))]
        keep = np.lexsort((both[1], -both[0], both[2]), axis=1)[:, :self.k]
        self.scores, self.ids, self.free = (np.take_along_axis(x, keep, 1) for x in both)


def _search(k: int, seed: int, sigmas: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, best, ids, turns = None, None, None, {}

        def rows() -> pa.RecordBatch:
            q, nth = np.nonzero(~best.free)
            return pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(best.ids[q, nth]), pa.array(best.scores[q, nth])],
                                              ["query_id", "vec_id", "score"])

        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                one = {n: batch.column(j)[i].as_py() for n, j in at.items()}
                if held != (one["q"], one["g"]):
                    if best is not None:
                        yield rows()
                    held, ids = (one["q"], one["g"]), v.ids_of(one["ids"])
                    queries, best = v.matrix(one["vectors"], len(ids)), _Best(len(ids), k)
                    dim = queries.shape[1]
                    if dim not in turns:
                        turns[dim] = rotation(dim, seed)
                others = v.ids_of(one["c_ids"])
                offered = v.matrix(one["c_vectors"], len(others))
                bits = np.frombuffer(one["c_bits"], np.uint8).reshape(len(others), -1)
                near, wide = estimates(queries, bits, np.frombuffer(one["c_lengths"]), np.frombuffer(one["c_fits"]), turns[dim], sigmas)
                near[ids[:, None] == others[None, :]] = -np.inf  # never looked at, nor looked at again
                if best.free[:, -1].any():
                    # No k-th score yet: rerank the most promising ones first.
                    top = min(3 * k, len(others))
                    chosen = np.argpartition(-near, top - 1, axis=1)[:, :top]
                    q, r = np.repeat(np.arange(len(ids)), top), chosen.ravel()
                    real = np.isfinite(near[q, r])
                    q, r = q[real], r[real]
                    best.add(q, exact(queries, offered, q, r), others[r])
                    near[q, r] = -np.inf
                open_ = np.isfinite(near)
                q, r = np.nonzero(open_ & (np.where(open_, near, 0.0) + wide >= best.scores[:, -1:]))
                for cut in range(0, len(q), 1 << 18):
                    some = slice(cut, cut + (1 << 18))
                    best.add(q[some], exact(queries, offered, q[some], r[some]), others[r[some]])
        if best is not None:
            yield rows()
    return run


def nearest(rows: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding",
            seed: int = SEED, sigmas: float = SIGMAS) -> DataFrame:
    """(query_id, rank, vec_id, score): about the ``k`` rows of largest inner product for each query row.

    Scores are exact, in double precision; only the choice of rows is approximate,
    and ``sigmas`` sets how rarely a bound misses. A query's candidates are all rows
    but those of its own id; ties go to the smaller id, equal rows may both appear.
    Vectors null, zero or holding null or non-finite components, and rows without an
    id, take no part; vectors of another length are no candidates. Products beyond a
    double are infinite, sums of opposite infinities rank last. Query rows equal in id
    and vector are one query; different vectors of one id are ranked together.
    """
    given = rows.select(F.col(vec_id).cast("bigint").alias("id"),
                        F.transform(embedding, lambda x: x.cast("double")).alias("vector"), is_query.alias("asked"))
    good = materialized(given.filter(F.col("id").isNotNull() & v.usable(F.col("vector")) & F.exists("vector", lambda x: x != 0)), "vectors")
    found = None
    for length in lengths(good):
        same = good.filter(F.size("vector") == length)
        queries, n_queries = v.blocks(same.filter("asked").select("id", "vector").distinct(), QUERY_BLOCK)
        codes, n_codes = index(same.select("id", "vector"), seed)
        part = v.meet(queries, n_queries, codes, n_codes, GROUP, _search(k, seed, sigmas), "query_id bigint, vec_id bigint, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return given.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
