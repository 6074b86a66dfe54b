"""Ordered series at scale: row positions, chunks with a halo, prefix scans, smoothing.

A plain window over one long series runs in a single task. These helpers cut a
series into bounded pieces, so the widest task holds ``chunk + halo`` rows no
matter how long (or how dominant) one series is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

CHUNK = "_chunk"
CHUNK_ROWS = 2048
SHORT_SPAN = 9
VANISHING = 1e-20


def row_positions(df: DataFrame, keys: Sequence[str], order: str, piece: Column,
                  name: str = "row_position") -> DataFrame:
    """0-based position of every row in its series.

    ``piece`` must grow with ``order`` (say, the day) and bound the rows of a
    piece. Rows are numbered inside pieces; piece totals, a small table, are
    prefix-summed and added. Both sides shuffle on the same keys.
    """
    keys = list(keys)
    pieces = df.withColumn("_piece", piece)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(*keys, "_piece").agg(F.count("*").alias("_n"))
        .select(*keys, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*keys, "_piece").orderBy(order)
    return (
        pieces.withColumn("_at", F.row_number().over(inside))
        .join(starts, [*keys, "_piece"])
        .withColumn(name, F.col("_start") + F.col("_at") - 1)
        .drop("_piece", "_start", "_at")
    )


def chunked(df: DataFrame, keys: Sequence[str], order: str, piece: Column, compute: Callable[[DataFrame, list[str]], DataFrame],
            back: int, ahead: int = 0, chunk: int = CHUNK_ROWS) -> DataFrame:
    """Run a windowed computation on chunks that carry their neighbours' rows.

    Each chunk of ``chunk`` consecutive rows also receives the ``back`` rows
    before it and the ``ahead`` rows after it. ``compute(frame, part)`` adds
    columns using windows partitioned by ``part`` and ordered by ``order``; the
    borrowed rows are dropped afterwards. A window that looks at most ``back``
    rows back and ``ahead`` rows on gives exactly the plain window's result.
    """
    at = F.col("_position")
    first = F.greatest(F.floor((at - ahead) / chunk), F.lit(0).cast("bigint"))
    last = F.floor((at + back) / chunk)
    spread = (
        row_positions(df, keys, order, piece, "_position")
        .withColumn(CHUNK, F.explode(F.sequence(first, last)))
    )
    out = compute(spread, [*keys, CHUNK])
    return out.filter(F.floor(at / chunk) == F.col(CHUNK)).drop(CHUNK, "_position")


def trailing(window: WindowSpec, n: int) -> WindowSpec:
    return window.rowsBetween(-(n - 1), 0)


def centered(window: WindowSpec, n: int) -> WindowSpec:
    """``n`` rows around the current one; an even ``n`` takes the extra row before it."""
    return window.rowsBetween(-(n // 2), n - 1 - n // 2)


def full_mean(x: Column, frame: WindowSpec, n: int) -> Column:
    """Mean over a frame, null until it holds ``n`` non-null values."""
    return F.when(F.count(x).over(frame) == n, F.avg(x).over(frame))


def full_std(x: Column, frame: WindowSpec, n: int) -> Column:
    return F.when(F.count(x).over(frame) == n, F.stddev_samp(x).over(frame))


def rolling_mean(x: Column, window: WindowSpec, n: int) -> Column:
    return full_mean(x, trailing(window, n), n)


def rolling_std(x: Column, window: WindowSpec, n: int) -> Column:
    return full_std(x, trailing(window, n), n)


def centered_mean(x: Column, window: WindowSpec, n: int) -> Column:
    return full_mean(x, centered(window, n), n)


def rolling_zscore(x: Column, window: WindowSpec, n: int) -> Column:
    return F.try_divide(x - rolling_mean(x, window, n), rolling_std(x, window, n))


def pct_change(x: Column, window: WindowSpec, n: int = 1) -> Column:
    return F.try_divide(x, F.lag(x, n).over(window)) - 1


def log_return(x: Column, window: WindowSpec) -> Column:
    return F.ln(F.try_divide(x, F.lag(x, 1).over(window)))


def difference(x: Column, window: WindowSpec, n: int = 1) -> Column:
    return x - F.lag(x, n).over(window)


def _short_mean(x: Column, window: WindowSpec, weight: float) -> Column:
    if weight >= 1:
        return x
    reach = math.ceil(math.log(VANISHING) / math.log(1 - weight))
    seen = F.collect_list(F.struct(x.alias("x"))).over(window.rowsBetween(-reach, 0))
    return F.aggregate(F.slice(seen, 2, reach), seen[0]["x"],
                       lambda y, row: y * (1 - weight) + F.coalesce(row["x"], F.lit(0.0)) * weight)


def exponential_mean(x: Column, window: WindowSpec, span: int) -> Column:
    """Recursive smoothing with weight 2 / (span + 1), seeded by the first row.

    The recursion y = d*y' + (1-d)*x unrolls to d^t * sum(x_i * d^-i), so a
    running sum of rescaled values gives it in one linear pass, as long as d^-rows
    stays finite over a chunk and its halo. Below ``SHORT_SPAN`` it does not; there
    the recursion runs over the last rows only, beyond which weights vanish in a double.
    """
    weight = 2.0 / (span + 1)
    if span < SHORT_SPAN:
        return _short_mean(x, window, weight)
    decay = F.lit(1.0 - weight)
    at = (F.row_number().over(window) - 1).cast("double")
    scaled = x * F.pow(decay, -at) * F.when(at == 0, 1.0).otherwise(weight)
    running = window.rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(scaled).over(running) * F.pow(decay, at)


def running_sum(df: DataFrame, keys: Sequence[str], order: str, piece: Column, value: Column, name: str) -> DataFrame:
    """Cumulative sum along each series: sums inside pieces plus the totals of earlier pieces."""
    keys = list(keys)
    pieces = df.withColumn("_piece", piece).withColumn("_x", value)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(*keys, "_piece").agg(F.sum("_x").alias("_t"))
        .select(*keys, "_piece", F.sum("_t").over(before).alias("_start"))
    )
    inside = Window.partitionBy(*keys, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        pieces.withColumn("_run", F.sum("_x").over(inside))
        .join(starts, [*keys, "_piece"])
        .withColumn(name, F.coalesce("_run", F.lit(0)) + F.coalesce("_start", F.lit(0)))
        .drop("_piece", "_x", "_run", "_start")
    )
