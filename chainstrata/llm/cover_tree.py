"""Compression of vectors by product codes, fitted with Lloyd rounds over cover trees.

Vectors become whole numbers and are cut into parts; every part position has its own
codebook. Rows are dealt into blocks, and each block gets one cover tree per part
position, built once and stored: a node is a centre, a radius that covers its points,
and a range of the block's points in tree order, so that running sums give the count
and the sum of any subtree. In a round a whole subtree goes to the entry nearest to
its centre if by the triangle inequality no other entry can be nearest to any of its
points. Only other nodes are opened, and points are compared one by one only in open
leaves. Rounds send one sum per codebook component and task.

All comparisons that decide are in whole numbers; square roots only serve bounds, with
a margin on the safe side. Results do not depend on how rows are dealt into blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chainstrata.llm import vectors as v
from chainstrata.llm.columns import shuffle_width
from chainstrata.session import materialized

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK, LEAF = 4096, 12
# Components are held at these limits, so that they fit a long and their sums a decimal.
_MOST = 1 << 62
_SLACK = 1e-9
_LONG_MAX = (1 << 63) - 1


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as long, held at +-2^62."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(_MOST))), F.lit(-float(_MOST)))))


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in a type in which squared distances between their rows cannot overflow."""
    width = max(1, arrays[0].shape[-1])
    largest = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    kind = np.int64 if 4 * largest * largest * width < _LONG_MAX else object
    return [a.astype(kind) for a in arrays]


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, a row per point and a column per centre."""
    out = np.zeros((len(points), len(centres)), points.dtype)
    for j, centre in enumerate(centres):
        gap = points - centre
        out[:, j] = (gap * gap).sum(axis=1)
    return out


class Tree:
    """A cover tree over the rows of ``points``, which it keeps in tree order.

    ``nodes`` has a row (centre, start, end, first child, children) per node, children
    of a node stand together, and ``order`` maps places in the tree to rows given.
    """

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.points, self.order, self.nodes, self.radius = points[order], order, nodes, radius
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), points.dtype), np.cumsum(self.points, axis=0, dtype=points.dtype)])

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        """Halve the radius from level to level; a child's centre lies in no earlier sibling's half radius."""
        order, nodes, radius = np.arange(len(points)), [[0, 0, len(points), 0, 0]], []
        at = 0
        while at < len(nodes):
            _, start, end, _, _ = nodes[at]
            rows = order[start:end]
            gaps = np.sqrt(_squares(points[rows], points[rows[:1]])[:, 0].astype(float))
            reach = float(gaps.max()) * (1 + _SLACK)
            radius.append(reach)
            if len(rows) > LEAF and reach > 0:
                groups, half = [], reach / 2
                near = gaps <= half
                while True:
                    groups.append(rows[near])
                    rows = rows[~near]
                    if not len(rows):
                        break
                    near = np.sqrt(_squares(points[rows], points[rows[:1]])[:, 0].astype(float)) <= half
                order[start:end] = np.concatenate(groups)
                nodes[at][3:] = [len(nodes), len(groups)]
                for group in groups:
                    nodes.append([0, start, start + len(group), 0, 0])
                    start += len(group)
            at += 1
        nodes = np.array(nodes, np.int64)
        nodes[:, 0] = nodes[:, 1]  # a node's centre is the first of its points
        return cls(points, order, nodes, np.array(radius))

    def assign(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Nearest centre of every point in tree order (ties to lower index), counts and sums per centre,
        and how many points were compared one by one."""
        codes = np.zeros(len(self.points), np.int64)
        counts = np.zeros(len(centres), np.int64)
        sums = np.zeros((len(centres), self.points.shape[1]), self.points.dtype)
        compared, front = 0, np.array([0])
        while len(front):
            nodes, radius = self.nodes[front], self.radius[front]
            squares = _squares(self.points[nodes[:, 0]], centres)
            best = squares.argmin(axis=1)
            away = np.sqrt(squares.astype(float))
            first = away[np.arange(len(front)), best]
            away[np.arange(len(front)), best] = np.inf
            second = away.min(axis=1)
            settled = second * (1 - _SLACK) > first * (1 + _SLACK) + 2 * radius * (1 + _SLACK)
            done, to = nodes[settled], best[settled]
            sizes = done[:, 2] - done[:, 1]
            codes[_ranges(done[:, 1], sizes)] = np.repeat(to, sizes)
            np.add.at(counts, to, sizes)
            np.add.at(sums, to, self.sums[done[:, 2]] - self.sums[done[:, 1]])
            leaf = ~settled & (nodes[:, 4] == 0)
            single = _ranges(nodes[leaf, 1], nodes[leaf, 2] - nodes[leaf, 1])
            if len(single):
                own = _squares(self.points[single], centres).argmin(axis=1)
                codes[single] = own
                np.add.at(counts, own, 1)
                np.add.at(sums, own, self.points[single])
                compared += len(single)
            inner = nodes[~settled & (nodes[:, 4] > 0)]
            front = _ranges(inner[:, 3], inner[:, 4])
        return codes, counts, sums, compared


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, ..., start + size - 1 of all pairs, one after another."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - ends + sizes, sizes)


_TREES = "array<struct<order:binary,nodes:binary,radius:binary>>"


def _building(parts: int) -> Callable:
    def block(ids: pa.Array, labels: pa.Array, vectors: np.ndarray, names: list[str]) -> pa.RecordBatch:
        trees = []
        for part in np.split(vectors, parts, axis=1):
            tree = Tree.build(*_exact(part))
            trees.append({"order": tree.order.astype(np.int32).tobytes(), "nodes": tree.nodes.astype(np.int32).tobytes(),
                          "radius": tree.radius.tobytes()})

        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        kind = pa.list_(pa.struct([("order", pa.binary()), ("nodes", pa.binary()), ("radius", pa.binary())]))
        return pa.RecordBatch.from_arrays([one(ids), one(labels), pa.array([vectors.tobytes()], pa.binary()), pa.array([trees], kind)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        names = ["ids", "labels", "vectors", "trees"]

        def flush(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
            joined = pa.Table.from_batches(batches).combine_chunks()
            ids, labels, lists = (joined.column(i).combine_chunks() for i in range(3))
            return block(ids, labels, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), -1), names)

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(at, BLOCK))
                rows += held[-1].num_rows
                if rows >= BLOCK:
                    yield flush(held)
                    held, rows = [], 0
        if rows:
            yield flush(held)
    return run


def _blocks_of(batches: Iterator[pa.RecordBatch], parts: int):
    """(batch, row, vectors by part, trees' stored form) of every stored block."""
    for batch in batches:
        at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            n = len(at["ids"][i])
            vectors = np.frombuffer(at["vectors"][i].as_py(), np.int64).reshape(n, -1)
            yield at, i, np.split(vectors, parts, axis=1), at["trees"][i].as_py()


def _tree(part: np.ndarray, stored: dict, codebook: np.ndarray) -> tuple[Tree, np.ndarray]:
    points, centres = _exact(part, codebook)
    tree = Tree(points, np.frombuffer(stored["order"], np.int32), np.frombuffer(stored["nodes"], np.int32).reshape(-1, 5).astype(np.int64),
                np.frombuffer(stored["radius"]))
    return tree, centres


_SUMS = "part int, entry int, component int, n bigint, total decimal(38,0)"


def _summing(codebooks: np.ndarray) -> Callable:
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        totals = np.zeros((parts, entries, width), object)
        for _, _, vectors, trees in _blocks_of(batches, parts):
            for p in range(parts):
                tree, centres = _tree(vectors[p], trees[p], codebooks[p])
                _, n, total, _ = tree.assign(centres)
                counts[p] += n
                totals[p] += total.astype(object)
        # A component of -1 stands for the entry itself, so that counts pass even without components.
        rows = [(p, e, c, int(counts[p, e]), Decimal(0) if c < 0 else Decimal(int(totals[p, e, c])))
                for p in range(parts) for e in range(entries) for c in range(-1, width) if counts[p, e]]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], ["part", "entry", "component", "n", "total"])
    return run


def _coding(codebooks: np.ndarray) -> Callable:
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, i, vectors, trees in _blocks_of(batches, parts):
            ids = at["ids"][i].values
            codes = np.zeros((len(ids), parts), np.uint8)
            error = np.zeros(len(ids), object)
            for p in range(parts):
                tree, centres = _tree(vectors[p], trees[p], codebooks[p])
                own = tree.assign(centres)[0]
                gap = tree.points - centres[own]
                codes[tree.order, p] = own
                error[tree.order] += (gap * gap).sum(axis=1).astype(object)
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [ids, at["labels"][i].values, pa.array([text[j:j + 2 * parts] for j in range(0, len(text), 2 * parts)], pa.string()),
                 pa.array([min(int(e), _LONG_MAX) for e in error], pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def _first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    return np.array([r.vector for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)


def _moved(codebooks: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Entries at the floored means of their parts; entries without parts stay."""
    out = codebooks.copy()
    totals = sums.groupBy("part", "entry", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    for r in totals.filter("component >= 0").collect():
        out[r.part, r.entry, r.component] = int(r.total) // r.n
    return out


def codebook_digest(codebooks: np.ndarray) -> str:
    """sha256 of all components as decimal numbers, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """A stored (vec_id, label, code, error) per usable vector, and the codebooks (part, entry, component).

    Vectors that are null or hold null or non-finite components are left out; whole
    components beyond 2^62 are held there. Vectors shorter than the longest one, and
    lengths that ``parts`` does not divide, are filled up with zeros. Rows without an
    id come last in the order that chooses the first entries, rows of equal id in
    order of their components; repeated rows count as often as they occur. Fewer rows
    than entries give shorter codebooks, no rows an empty result. An error beyond a
    long is held at its limit. Other columns play no part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes hold one byte per part: entries must be from 1 to 256")
    spark = rows.sparkSession
    given = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("vector"))
    good = given.filter(v.usable(F.col("vector"))).withColumn("vector", whole(F.col("vector"), scale))
    kind = given.schema["label"].dataType.simpleString()
    schema = f"vec_id bigint, label {kind}, code string, error bigint"
    longest = good.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    length = max(1, -(-longest // parts)) * parts
    filled = good.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0).cast("bigint"), F.lit(length) - F.size("vector"))))
    dealt = filled.select("vec_id", "label", "vector").repartition(shuffle_width(spark))
    blocks = materialized(dealt.mapInArrow(
        _building(parts), f"ids array<bigint>, labels array<{kind}>, vectors binary, trees {_TREES}"), "cover-trees")
    codebooks = _first_codebooks(filled, parts, entries)
    for _ in range(rounds):
        codebooks = _moved(codebooks, blocks.mapInArrow(_summing(codebooks), _SUMS))
    return materialized(blocks.mapInArrow(_coding(codebooks), schema), "codes"), codebooks


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the errors of all rows of equal label added up, null labels together."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG_MAX).cast("decimal(38,0)")).cast("bigint")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
