"""Exact order statistics without gathering a group in one task.

A sketch proposes cut values. Cuts only decide how little data the last step
sees, never the answer: exact row counts between cuts tell which interval holds
a wanted rank, and only that interval is ranked.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.session import materialized

ACCURACY = 10_000
MARGIN = 2.0 / ACCURACY
# Distinct values of one piece of an ordered scan.
PIECE_ROWS = 100_000


def _cut_at(rows: DataFrame, sample: DataFrame, keys: list[str], probes: list[float]) -> DataFrame:
    """Add ``_bucket``, the number of the sample's sketched cut values below each row's value."""
    cuts = sample.groupBy(*keys).agg(F.percentile_approx("value", probes, ACCURACY).alias("_cuts"))
    if keys:
        placed = rows.join(materialized(cuts, "cuts"), keys)
        values = [F.col("_cuts")[i] for i in range(len(probes))]
    else:
        placed = rows
        values = [F.lit(c) for c in cuts.first()[0] or []]
    below = functools.reduce(operator.add, [(c < F.col("value")).cast("int") for c in values], F.lit(0))
    return placed.withColumn("_bucket", below).drop("_cuts")


def _before(column: str, keys: list[str]) -> Column:
    """Sum over the group's earlier buckets."""
    w = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(w), F.lit(0))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles, one column per entry of ``wanted``.

    Values are not shuffled, apart from the narrow intervals around the wanted
    ranks, about four rows in ``ACCURACY`` each. Should the sketch miss, a wider
    interval is ranked and the result is the same. Reads ``df`` three times, so
    pass a stored table; runs actions for the two per-group tables.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value"))
    probes = sorted({min(max(q + side, 0.0), 1.0) for q in wanted.values() for side in (-MARGIN, MARGIN)})
    placed = _cut_at(rows, rows, keys, probes)
    counts = placed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_rows")).select(
        *keys, "_bucket", "_rows", _before("_rows", keys).alias("_below"),
        F.sum("_rows").over(Window.partitionBy(*keys)).alias("total_n"))
    ranks = {name: F.lit(float(q)) * (F.col("total_n") - 1) for name, q in wanted.items()}
    hit = functools.reduce(operator.or_, [
        (F.ceil(r) >= F.col("_below")) & (F.floor(r) < F.col("_below") + F.col("_rows")) for r in ranks.values()])
    inside = Window.partitionBy(*keys, "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        placed.join(materialized(counts.filter(hit), "wanted-buckets"), [*keys, "_bucket"])
        .groupBy(*keys, "_bucket", "_below", "total_n", "value").agg(F.count("*").alias("n"))
        .withColumn("_to", F.col("_below") + F.sum("n").over(inside))
        .withColumn("_from", F.col("_to") - F.col("n"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("value")))

    found = ranked.groupBy(*keys).agg(
        F.max("total_n").alias("total_n"),
        *[at(F.floor(r)).alias(f"_lo_{n}") for n, r in ranks.items()],
        *[at(F.ceil(r)).alias(f"_hi_{n}") for n, r in ranks.items()],
    )
    return found.select(*keys, *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * (r - F.floor(r))).cast("double").alias(n)
        for n, r in ranks.items()
    ])


def ordered_pieces(df: DataFrame, value: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``df``, stored, with ``_bucket``: pieces of about ``piece_rows`` rows in order of ``value``.

    Equal values share a piece. Splitters are sampled, so their number grows with the
    rows and pieces stay small. Stores the input too, as it is sampled and then dealt.
    """
    stored = materialized(df, "unordered")
    count = max(1, -(-stored.count() // piece_rows))
    return materialized(stored.repartitionByRange(count, value).withColumn("_bucket", F.spark_partition_id()), "ordered-pieces")


def ordered_numbers(df: DataFrame, value: str, name: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Number rows of distinct values from 0 in their order, without one task seeing all of them."""
    placed = ordered_pieces(df, value, piece_rows)
    starts = placed.groupBy("_bucket").agg(F.count("*").alias("_rows")).select("_bucket", _before("_rows", []).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy(value)
    return placed.join(starts, "_bucket").withColumn(name, F.col("_start") + F.row_number().over(inside) - 1).drop("_bucket", "_start")


def ranked_values(df: DataFrame, value: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Distinct values in order with exact running counts and sums.

    Adds ``below_n`` and ``below_sum`` (rows and sum of all smaller values) and
    the totals ``total_n`` and ``total_sum``. Repeats collapse before the
    shuffle; the values are cut in pieces of bounded size, and each task scans one.
    """
    rows = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("value"))
    placed = ordered_pieces(rows.groupBy("value").agg(F.count("*").alias("n")), "value", piece_rows)
    amount = F.col("n") * F.col("value")
    pieces = placed.groupBy("_bucket").agg(F.sum("n").alias("_rows"), F.sum(amount).alias("_sum")).select(
        "_bucket", _before("_rows", []).alias("_rows_below"), _before("_sum", []).alias("_sum_below"),
        F.sum("_rows").over(Window.partitionBy()).alias("total_n"),
        F.sum("_sum").over(Window.partitionBy()).alias("total_sum"))
    inside = Window.partitionBy("_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(pieces, "_bucket").select(
        "value", "n", "total_n", "total_sum",
        (F.col("_rows_below") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("below_n"),
        (F.col("_sum_below") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).alias("below_sum"))
