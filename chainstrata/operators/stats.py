"""Distribution statistics: describe, boxes, correlation, histogram, density, concentration."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.functions.ratios import ratio
from chainstrata.operators.quantiles import PIECE_ROWS, exact_quantiles, ordered_numbers, ranked_values
from chainstrata.session import materialized

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
FENCE = 1.5


def describe(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """n, mean, sample deviation, min, quartiles and max per group."""
    keys = list(keys)
    moments = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    return moments.join(exact_quantiles(df, keys, value, QUARTILES), keys, "left")


def boxes(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Quartiles, whisker ends within 1.5 spreads, and the number of points beyond, per label."""
    keys = list(keys)
    spread = F.col("q75") - F.col("q25")
    low, high = F.col("q25") - FENCE * spread, F.col("q75") + FENCE * spread
    v = F.col(value)
    inside = (v >= low) & (v <= high)
    quartiles = exact_quantiles(df, keys, value, QUARTILES)
    return (
        df.filter(v.isNotNull()).join(materialized(quartiles, "quartiles"), keys).groupBy(*keys, *QUARTILES).agg(
            F.count("*").alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def alphabetical_codes(df: DataFrame, label: str, code: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Replace a label by its 0-based alphabetical position, null by -1.

    Distinct labels are dealt by range; each piece is numbered on its own, after the
    labels of the pieces before it. Stores the dictionary first (an action).
    """
    distinct = df.filter(F.col(label).isNotNull()).select(label).distinct()
    labels = ordered_numbers(distinct, label, code, piece_rows).withColumn(code, F.col(code).cast("double"))
    return df.join(materialized(labels, "labels"), label, "left").withColumn(code, F.coalesce(code, F.lit(-1.0)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form, from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(x).alias("var_a"), F.lit(y).alias("var_b"), F.col(f"`{a}|{b}`").alias("corr"))
        for a, b in pairs for x, y in ({(a, b), (b, a)})
    ]
    return one.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins over the value range, the last one closed, empty ones kept."""
    x = F.col(value).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    # a single repeated value gets a unit-wide range around it
    same = F.col("lo") == F.col("hi")
    ends = ends.select(F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                       F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    at = F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("bigint")
    counts = df.filter(x.isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    step = (hi - lo) / bins
    return df.sparkSession.range(bins).withColumnRenamed("id", "bin").join(counts, "bin", "left").select(
        "bin", (lo + F.col("bin") * step).alias("bin_low"), (lo + (F.col("bin") + 1) * step).alias("bin_high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def density(df: DataFrame, key: str, value: str, bins: int = 512, grid: int = 64, cut: float = 3.0) -> DataFrame:
    """Gaussian density per group on an even grid, bandwidth n^(-1/5) * deviation.

    Points are first folded into ``bins`` fine bins per group, so the kernel sum
    runs over bins times grid points whatever the number of rows. Stores the
    per-group shape first (an action).
    """
    x = F.col(value).cast("double")
    rows = df.filter(x.isNotNull() & F.col(key).isNotNull())
    shape = (
        rows.groupBy(key).agg(F.count("*").alias("_n"), F.stddev_samp(x).alias("_sd"),
                              F.min(x).alias("_lo"), F.max(x).alias("_hi"))
        .filter("_sd > 0")
        .withColumn("_bw", F.pow(F.col("_n").cast("double"), F.lit(-0.2)) * F.col("_sd"))
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1))
    fine = (
        rows.join(materialized(shape, "shape"), key)
        .groupBy(key, "_n", "_bw", "_lo", "_hi", at.alias("_at")).agg(F.count("*").alias("_m"))
    )
    middle = F.col("_lo") + (F.col("_at") + 0.5) * width
    start = F.col("_lo") - cut * F.col("_bw")
    step = (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_bw")) / (grid - 1)
    gap = (F.col("x") - middle) / F.col("_bw")
    kernel = F.exp(-0.5 * gap * gap) / (F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi))
    return (
        fine.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .withColumn("x", start + F.col("point") * step)
        .groupBy(key, "point", "x").agg(F.sum(F.col("_m") * kernel).alias("density"))
    )


def outliers(df: DataFrame, value: str, q: float, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows, in the given order, at or above an exact quantile."""
    threshold = exact_quantiles(df, [], value, {"cut": q}).select("cut").scalar()
    return df.filter(F.col(value) >= threshold).orderBy(*order).limit(n)


def concentration(df: DataFrame, value: str, points: int = 10) -> DataFrame:
    """Lorenz curve: share of the total held by the smallest k rows, at even steps.

    Each row also carries the Gini index. Equal values are handled as one run,
    and running sums come from bucket prefixes, so no task sees the whole series.
    ``value`` is an integer whose total fits a bigint. Writes the ranked values
    once, as curve and index both read them.
    """
    wide = "decimal(38,0)"
    ranked = materialized(ranked_values(df, value), "ranked")
    n, below, total_n, v = F.col("n"), F.col("below_n"), F.col("total_n"), F.col("value")
    # ranks below+1 .. below+n of a run sum to n (2 below + n + 1) / 2
    ranks = n.cast("decimal(20,0)") * (2 * below + n + 1).cast("decimal(18,0)") / 2
    rank_sum = F.sum((ranks.cast("decimal(22,0)") * v.cast("decimal(16,0)")).cast(wide))
    first = F.floor(below * points / total_n) + 1
    last = F.floor((below + n) * points / total_n)
    steps = ranked.filter(last >= first).withColumn("point", F.explode(F.sequence(first, last)))
    # the cut row of a step can lie in the run before when the division is not exact
    cut = F.floor(F.col("point") * total_n / points)
    held = (F.col("below_sum") + (cut - below) * v).cast("double") / F.col("total_sum").cast("double")
    curve = steps.select(F.col("point").cast("bigint").alias("point"), cut.alias("rows_below"), held.alias("share_below"))
    all_n, all_sum = F.max("total_n").cast("double"), F.max("total_sum").cast("double")
    gini = ranked.agg((F.lit(2.0) * ratio(rank_sum, all_n * all_sum) - (all_n + 1) / all_n).alias("gini"))
    return curve.withColumn("gini", gini.scalar())


def weekday_hour_means(df: DataFrame, ts: Column, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """7 x 24 matrix of means, one row per weekday (Monday 0), absent cells null."""
    hours = list(range(24))
    cells = (
        df.withColumn("weekday", F.weekday(ts)).withColumn("_hour", F.hour(ts))
        .groupBy(*keys, "weekday").pivot("_hour", hours).agg(F.avg(value))
    )
    cells = cells.select(*keys, "weekday", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    days = df.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday"))
    if keys:
        groups = cells.select(*keys).distinct()
        days = groups.withColumn("weekday", F.explode(F.sequence(F.lit(0), F.lit(6))))
    return days.join(cells, [*keys, "weekday"], "left")


def slot_stats(df: DataFrame, ts: Column, value: str, load: str) -> DataFrame:
    return (
        df.groupBy(F.weekday(ts).alias("weekday"), F.hour(ts).alias("hour"))
        .agg(F.avg(value).alias("avg_value"), F.count(value).alias("n"),
             F.max(value).alias("max_value"), F.avg(load).alias("avg_load"))
    )
