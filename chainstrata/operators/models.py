"""Model jobs on ``pyspark.ml`` and density regimes.

Fits are distributed; only fitted parameters and fixed-length feature lists
reach the driver.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from chainstrata.functions.calendar import days_to_next
from chainstrata.functions.ratios import percent
from chainstrata.operators import series
from chainstrata.operators.evaluate import FOLDS, Period, time_folds, with_periods
from chainstrata.operators.fees import by_date
from chainstrata.operators.indicators import FEATURES
from chainstrata.session import at_once, checkpointed, materialized, scratch_path

# Fee model inputs and the fee level of a normal day, in coins.
FEE_FEATURES = (
    "fees_log", "fees_lag1_log", "fees_lag2_log", "fees_lag7_log",
    "fees_ma7_log", "fees_ma30_log", "fees_std30", "fees_zscore",
    "btc_price", "price_lag1", "price_ma7", "price_ma30",
    "log_return", "volatility_30d", "range_pct",
    "day_of_week", "days_to_halving",
)
NORMAL_DAY_COINS = 100.0
LEARNING_RATE = 0.05
TREES = 200
MIN_TRAIN, MIN_TEST = 100, 10
CLUSTER_FEATURES = ("fees_log", "price_log", "volatility", "log_return", "range_pct")


def fee_model_frame(joined: DataFrame) -> DataFrame:
    """Inputs and label (next day's fees, log1p) of the fee model, complete rows only."""
    w, fees, price = by_date(), F.col("fees_btc"), F.col("btc_price")
    out = joined.withColumns({
        "target": F.lead("fees_btc").over(w),
        "fees_log": F.log1p("fees_btc"),
        **{f"fees_lag{n}_log": F.log1p(F.lag("fees_btc", n).over(w)) for n in (1, 2, 7)},
        "_ma7": series.rolling_mean(fees, w, 7),
        "_ma30": series.rolling_mean(fees, w, 30),
        "fees_std30": series.rolling_std(fees, w, 30),
        "price_lag1": F.lag("btc_price").over(w),
        "price_ma7": series.rolling_mean(price, w, 7),
        "price_ma30": series.rolling_mean(price, w, 30),
        "day_of_week": F.weekday("date"),
        "days_to_halving": days_to_next(F.col("date")),
    })
    out = out.withColumns({
        "target_log": F.log1p("target"),
        "fees_ma7_log": F.log1p("_ma7"),
        "fees_ma30_log": F.log1p("_ma30"),
        "fees_zscore": F.try_divide(fees - F.col("_ma30"), F.col("fees_std30")),
    })
    return out.select("date", "fees_btc", "target", "target_log", *[c for c in FEE_FEATURES]).dropna()


def _vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def _stored_parts(rows: DataFrame, by: Sequence[str], name: str) -> tuple[DataFrame, dict[tuple, int]]:
    """Rows in one folder per value of ``by``, and the rows of each, so that a fit reads its part only."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, name)
    rows.hint("rebalance", *by).write.partitionBy(*by).parquet(path)
    kept = [rows.schema[c] for c in rows.columns if c not in by] + [rows.schema[c] for c in by]
    parts = spark.read.schema(StructType(kept)).parquet(path)
    counted = parts.groupBy(*by).agg(F.count("*").alias("n")).collect()
    return parts, {tuple(r[c] for c in by): r["n"] for r in counted}


def _together(frames: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def fee_cross_validation(frame: DataFrame, normal_below: float = NORMAL_DAY_COINS, trees: int = TREES,
                         k: int = FOLDS) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold predictions in coins, and mean feature importance.

    Runs one distributed fit per fold, all at once; each reads its own part of the
    stored folds. The result can be stored with ``model_store.stored_once``, so that
    error, residuals and importance share the fits.
    """
    normal = frame.filter(F.col("fees_btc") < normal_below)
    folded, _ = _stored_parts(_vectors(time_folds(normal, "date", k), FEE_FEATURES)
                              .select("date", "fold", "role", "features", "target_log"), ["fold", "role"], "fee-folds")
    fitted = {}

    def fit(fold: int) -> None:
        part = folded.filter((F.col("fold") == fold) & (F.col("role") == "train"))
        fitted[fold] = GBTRegressor(labelCol="target_log", maxIter=trees, stepSize=LEARNING_RATE, maxDepth=5,
                                    minInstancesPerNode=20, seed=42).fit(part)

    at_once([functools.partial(fit, fold) for fold in range(1, k + 1)])
    every = _together([
        fitted[fold].transform(folded.filter((F.col("fold") == fold) & (F.col("role") == "test")))
        .select("date", "fold", F.expm1("target_log").alias("actual"), F.expm1("prediction").alias("predicted"))
        for fold in sorted(fitted)])
    gains = [fitted[fold].featureImportances.toArray() for fold in sorted(fitted)]
    rows = [(name, float(sum(g[at] for g in gains) / k)) for at, name in enumerate(FEE_FEATURES)]
    return every, frame.sparkSession.createDataFrame(rows, "feature string, importance double")


def fee_persistence(frame: DataFrame, normal_below: float = NORMAL_DAY_COINS, k: int = FOLDS) -> DataFrame:
    """Predictions of the same folds by today's fees, which a fitted model has to beat."""
    folded = time_folds(frame.filter(F.col("fees_btc") < normal_below), "date", k).filter("role = 'test'")
    return folded.select("date", "fold", F.col("target").alias("actual"), F.col("fees_btc").alias("predicted"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Row weight n / (2 * rows of the class), so both classes weigh the same."""
    totals = df.agg(F.struct(F.count("*").alias("n"), F.sum(label).alias("ones")).alias("t")).scalar()
    of_class = F.when(F.col(label) == 1, totals["ones"]).otherwise(totals["n"] - totals["ones"])
    return df.withColumn("weight", totals["n"] / (2.0 * of_class))


def fit_classifier(rows: DataFrame, trees: int = TREES, features: Sequence[str] = FEATURES, label: str = "target"):
    """Gradient-boosted next-bar classifier on class-balanced rows."""
    ready = balanced_weights(_vectors(rows, features), label).select("features", label, "weight")
    return GBTClassifier(labelCol=label, weightCol="weight", maxIter=trees, stepSize=LEARNING_RATE, maxDepth=5,
                         subsamplingRate=0.8, minInstancesPerNode=100, seed=42).fit(ready)


def score(model, rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Add the probability of the positive class; only rows with every feature."""
    out = model.transform(_vectors(rows.dropna(subset=list(features)), features))
    return out.withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")


def walk_forward(matrix: DataFrame, periods: Sequence[Period], trees: int = TREES,
                 min_train: int = MIN_TRAIN, min_test: int = MIN_TEST) -> tuple[DataFrame, DataFrame]:
    """Scored test spans, and a row per period with its sizes and whether it was fitted.

    One distributed fit per period on its training span, all at once; each reads its
    own part of the stored spans. A period with too few rows is not fitted, and said
    to be skipped. A training span of one class has no fit either.
    """
    rows, sizes = _stored_parts(with_periods(matrix, periods), ["period", "role"], "walk-forward")
    spans = walk_forward_spans(rows, periods, min_train, min_test)
    able = [p for p in periods if sizes.get((p.name, "train"), 0) >= min_train and sizes.get((p.name, "test"), 0) >= min_test]
    fitted = {}

    def fit(name: str) -> None:
        fitted[name] = fit_classifier(rows.filter((F.col("period") == name) & (F.col("role") == "train")), trees)

    classes = {r.period: r.n for r in rows.filter("role = 'train'").groupBy("period").agg(
        F.count_distinct("target").alias("n")).collect()}
    able = [p.name for p in able if classes[p.name] > 1]
    at_once([functools.partial(fit, name) for name in able])
    if not able:
        return rows.filter("false").withColumn("probability", F.lit(None).cast("double")), spans
    return _together([score(fitted[name], rows.filter((F.col("period") == name) & (F.col("role") == "test")))
                      for name in able]), spans


def walk_forward_spans(rows: DataFrame, periods: Sequence[Period], min_train: int = MIN_TRAIN,
                       min_test: int = MIN_TEST) -> DataFrame:
    """Per period the rows of its two spans, the classes of the training span, and ``fit`` or ``skipped``.

    ``rows`` are spans as ``with_periods`` gives them. A period without any row is listed too.
    """
    of = lambda role, value: F.count(F.when(F.col("role") == role, value))
    found = rows.groupBy(F.col("period").alias("_period")).agg(
        of("train", F.lit(1)).alias("_train"), of("test", F.lit(1)).alias("_test"),
        F.count_distinct(F.when(F.col("role") == "train", F.col("target"))).alias("_classes"))
    named = rows.sparkSession.createDataFrame([(p.name,) for p in periods], "period string")
    out = named.join(found, F.col("period") == F.col("_period"), "left").select(
        "period", *[F.coalesce(f"_{c}", F.lit(0)).alias(c) for c in ("train", "test", "classes")])
    able = (F.col("train") >= min_train) & (F.col("test") >= min_test) & (F.col("classes") > 1)
    return out.withColumn("status", F.when(able, "fit").otherwise("skipped"))


def cluster_frame(joined: DataFrame) -> DataFrame:
    return joined.withColumns({
        "fees_log": F.log1p("fees_btc"),
        "price_log": F.ln("btc_price"),
        "volatility": F.col("volatility_30d"),
    }).dropna(subset=list(CLUSTER_FEATURES))


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    moments = df.agg(F.struct(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    )).scalar()

    def scaled(c: str) -> Column:
        gap, sd = F.col(c) - F.col(f"_m.m_{c}"), F.col(f"_m.s_{c}")
        return gap / F.when(sd == 0, 1.0).otherwise(sd)

    # one reference to the moments, so that they are planned once
    return df.withColumn("_m", moments).withColumns({f"{c}{suffix}": scaled(c) for c in columns}).drop("_m")


def principal_components(df: DataFrame, columns: Sequence[str], k: int = 2) -> tuple[DataFrame, list[float]]:
    """Projection of centered columns on the first components, and explained shares.

    Component signs are arbitrary; each is turned so its largest loading is positive.
    """
    vectors = _vectors(df, columns)
    model = PCA(k=k, inputCol="features", outputCol="_pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] > 0 else -1.0 for i in range(k)]
    projected = model.transform(vectors).withColumn("_pc", vector_to_array("_pc"))
    out = projected.withColumns({f"pca{i + 1}": F.col("_pc")[i] * signs[i] for i in range(k)})
    return out.drop("features", "_pc"), [float(v) for v in model.explainedVariance]


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node, for edges ``a``-``b``.

    Alternates star contractions (Kiveris et al., 2014), which need a
    logarithmic number of rounds where label passing needs the graph's diameter.
    Each round ends in a checkpoint; only its row count and fingerprint are read.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hubs = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(hubs, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = checkpointed(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _squared(gaps) -> Column:
    """Sum of squares, written out so that it stays in generated code."""
    return functools.reduce(lambda total, x: total + x, [gap * gap for gap in gaps])


def _distance(p: str, q: str, dims: int) -> Column:
    """Squared distance of two points."""
    return _squared(F.col(p)[i] - F.col(q)[i] for i in range(dims))


def _box(p: str, dims: int) -> list[Column]:
    """Smallest box around the points of a group."""
    return [F.array(*[bound(F.col(p)[i]) for i in range(dims)]).alias(name) for name, bound in (("lo", F.min), ("hi", F.max))]


def _least(a: str, b: str, dims: int) -> Column:
    """Squared distance of two boxes where they are closest."""
    lo_a, hi_a, lo_b, hi_b = (F.col(c) for c in (f"{a}lo", f"{a}hi", f"{b}lo", f"{b}hi"))
    return _squared(F.greatest(lo_a[i] - hi_b[i], lo_b[i] - hi_a[i], F.lit(0.0)) for i in range(dims))


def _most(a: str, b: str, dims: int) -> Column:
    """Squared distance of the two points of two boxes that are farthest apart."""
    lo_a, hi_a, lo_b, hi_b = (F.col(c) for c in (f"{a}lo", f"{a}hi", f"{b}lo", f"{b}hi"))
    return _squared(F.greatest(hi_a[i] - lo_b[i], hi_b[i] - lo_a[i]) for i in range(dims))


def _as(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(side + c) for c in df.columns])


def _cell_pairs(cells: DataFrame, dims: int, reach: int, limit: float) -> DataFrame:
    """Ordered pairs of cells whose boxes come within the radius, each cell with itself included.

    Cells are dealt to blocks ``reach`` cells wide; partners lie in the same or an
    adjacent block.
    """
    block = F.transform("at", lambda x: F.floor(x / reach))
    steps = (f"array({', '.join(map(str, step))})" for step in itertools.product((-1, 0, 1), repeat=dims))
    offsets = F.expr(f"array({', '.join(steps)})")
    left = _as(cells, "a_").withColumn("block", F.explode(F.transform(
        offsets, lambda step: F.zip_with(F.transform("a_at", lambda x: F.floor(x / reach)), step, lambda x, o: x + o))))
    right = _as(cells.withColumn("block", block), "b_").withColumnRenamed("b_block", "block")
    return left.join(right, "block").filter(_least("a_", "b_", dims) <= limit).select(
        "a_cell", "b_cell", "b_n", "b_lo", "b_hi", (_most("a_", "b_", dims) <= limit).alias("whole"))


def _masses(sparse: DataFrame, points: DataFrame, pairs: DataFrame, dims: int, limit: float) -> DataFrame:
    """(p, mass): rows within the radius of each point, itself included.

    Boxes that lie inside the radius count as a whole; only points of boxes that the
    radius cuts are met one by one.
    """
    met = sparse.select("p", F.col("cell").alias("a_cell")).join(pairs, "a_cell")
    met = met.withColumns({"lo": F.col("p"), "hi": F.col("p")}).filter(_least("", "b_", dims) <= limit)
    met = met.withColumn("inside", F.col("whole") | (_most("", "b_", dims) <= limit))
    whole = met.filter("inside").select("p", F.col("b_n").alias("mass"))
    cut = met.filter("not inside").select("p", "b_cell").join(_as(points.select("cell", "p", "n"), "b_"), "b_cell")
    return whole.unionByName(cut.filter(_distance("p", "b_p", dims) <= limit).select("p", F.col("b_n").alias("mass"))).groupBy("p").agg(
        F.sum("mass").alias("mass"))


def _core_links(core: DataFrame, pairs: DataFrame, dims: int, side: float, limit: float, levels: int) -> DataFrame:
    """(a, b) of cells, a before b, that hold core points within the radius of each other.

    Boxes around the core points settle most pairs. An open pair is halved along
    every axis, level by level: parts too far apart go, parts that lie inside the
    radius or whose first points do link the cells. Points meet points only in
    parts still open after the last level.
    """
    def parts(level: int) -> DataFrame:
        place = F.transform("p", lambda x: F.floor(x * 2.0**level / side))
        return core.withColumn("part", place).groupBy("cell", "part").agg(*_box("p", dims), F.min("p").alias("first")).withColumn(
            "above", F.transform("part", lambda x: F.shiftright(x, 1)))

    whole = parts(0)
    ends = whole.select("cell", "part")
    open_pairs = (pairs.filter("a_cell < b_cell").select("a_cell", "b_cell")
                  .join(_as(ends, "a_"), "a_cell").join(_as(ends, "b_"), "b_cell"))
    links = []
    for level in range(levels + 1):
        own = materialized(parts(level), "regime-parts")
        if level == 0:
            own = own.withColumn("above", F.col("part"))
        above = open_pairs.withColumnRenamed("a_part", "a_above").withColumnRenamed("b_part", "b_above")
        met = above.join(_as(own, "a_"), ["a_cell", "a_above"]).join(_as(own, "b_"), ["b_cell", "b_above"])
        met = materialized(met.filter(_least("a_", "b_", dims) <= limit).select(
            "a_cell", "b_cell", "a_part", "b_part",
            ((_most("a_", "b_", dims) <= limit) | (_distance("a_first", "b_first", dims) <= limit)).alias("near")), "regime-open")
        links.append(met.filter("near").select("a_cell", "b_cell").distinct())
        open_pairs = met.join(links[-1], ["a_cell", "b_cell"], "left_anti").select("a_cell", "b_cell", "a_part", "b_part")
        if open_pairs.isEmpty():
            break
    else:
        place = F.transform("p", lambda x: F.floor(x * 2.0**levels / side))
        placed = core.select("cell", place.alias("part"), "p")
        met = open_pairs.join(_as(placed, "a_"), ["a_cell", "a_part"]).join(_as(placed, "b_"), ["b_cell", "b_part"])
        links.append(met.filter(_distance("a_p", "b_p", dims) <= limit).select("a_cell", "b_cell").distinct())
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    return every.select(F.col("a_cell").alias("a"), F.col("b_cell").alias("b"))


def density_regimes(df: DataFrame, columns: Sequence[str], radius: float = 0.5, min_samples: int = 10,
                    min_cluster_size: int = 30, levels: int = 2) -> DataFrame:
    """Density clusters of standardised columns; sparse rows and small clusters get -1.

    A row with at least ``min_samples`` rows within ``radius``, itself included, is
    core; core rows within the radius of each other share a cluster; any other row
    within the radius of core rows joins the nearest one's. Rows with a null value
    belong to none. Exact, and without meeting all rows of a crowd: equal rows are one
    point, points fold into grid cells whose diagonal is the radius, so all of a
    crowded cell are core at once, and boxes decide most of the rest. Clusters are
    numbered by the hash of their smallest cell. For up to five columns.
    """
    if len(columns) > 5:
        raise ValueError("grid neighbourhoods are built for at most five columns")
    dims, limit = len(columns), radius * radius
    side = radius / math.sqrt(dims) * (1 - 1e-9)  # no two points of a cell are farther apart than the radius
    coordinates = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in columns])
    keyed = df.withColumn("_p", F.when(~F.exists(coordinates, lambda x: x.isNull() | F.isnan(x)), coordinates))
    points = keyed.filter("_p is not null").groupBy(F.col("_p").alias("p")).agg(F.count("*").alias("n"))
    points = points.withColumn("at", F.transform("p", lambda x: F.floor(x / side)))
    points = materialized(points.withColumn("cell", F.concat_ws(",", F.transform("at", lambda x: x.cast("string")))), "regime-points")
    cells = materialized(points.groupBy("cell", "at").agg(F.sum("n").alias("n"), *_box("p", dims)), "regime-cells")
    pairs = materialized(_cell_pairs(cells, dims, math.floor(radius / side) + 1, limit), "regime-pairs")

    sized = points.select("cell", "p", "n").join(cells.select("cell", F.col("n").alias("crowd")), "cell")
    sparse = sized.filter(F.col("crowd") < min_samples)
    masses = _masses(sparse, points, pairs, dims, limit)
    judged = materialized(
        sized.filter(F.col("crowd") >= min_samples).select("cell", "p", "n", F.lit(True).alias("core")).unionByName(
            sparse.join(masses, "p").select("cell", "p", "n", (F.col("mass") >= min_samples).alias("core"))), "regime-cores")
    core = judged.filter("core").select("cell", "p", "n")

    links = materialized(_core_links(core, pairs, dims, side, limit, levels), "regime-links")
    members = core.select("cell").distinct().join(
        connected_components(links).withColumnRenamed("node", "cell"), "cell", "left").select(
        "cell", F.coalesce("component", "cell").alias("component"))
    members = materialized(members, "regime-members")

    # A point beside core points takes the nearest one's cluster; of equally near ones that of the smaller cell.
    beside = judged.filter("not core").select("p", "n", F.col("cell").alias("a_cell")).join(
        pairs.select("a_cell", "b_cell", "b_lo", "b_hi"), "a_cell")
    beside = beside.withColumns({"lo": F.col("p"), "hi": F.col("p")}).filter(_least("", "b_", dims) <= limit)
    beside = beside.select("p", "n", "b_cell").join(_as(core.select("cell", "p"), "b_"), "b_cell")
    nearest = beside.withColumn("gap", _distance("p", "b_p", dims)).filter(F.col("gap") <= limit).groupBy("p", "n").agg(
        F.min(F.struct("gap", "b_cell"))["b_cell"].alias("cell"))
    placed = materialized(core.select("p", "n", "cell").unionByName(nearest.select("p", "n", "cell")).join(members, "cell")
                          .select("p", "n", "component"), "regime-placed")
    large = placed.groupBy("component").agg(F.sum("n").alias("size")).filter(F.col("size") >= min_cluster_size)
    number = F.shiftrightunsigned(F.xxhash64("component"), 1)
    labels = placed.join(large, "component", "left_semi").select(F.col("p").alias("_p"), number.alias("_cluster"))
    return keyed.join(labels, "_p", "left").withColumn("cluster", F.coalesce("_cluster", F.lit(-1))).drop("_p", "_cluster")


def cluster_profiles(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Size, share, date span, means, and percent deviation of each mean from the overall mean."""
    overall = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()
    sizes = df.groupBy(cluster).agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
    )
    return sizes.withColumns({
        "pct": percent(F.col("n"), F.sum("n").over(Window.partitionBy())),
        **{f"dev_{c}": percent(F.col(f"mean_{c}") - overall[c], overall[c]) for c in columns},
    })
