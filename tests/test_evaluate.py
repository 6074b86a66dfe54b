import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chainstrata.operators import evaluate, models, quantiles, stats
from chainstrata.plans.models import fee_frame

T0 = dt.datetime(2024, 1, 1)


def test_trades_and_metrics_of_a_short_period(spark):
    """Worked by hand: a capped gain, a stopped loss, a small gain; the unsure bar and the last one give no trade."""
    price, probability = [100.0, 102.0, 100.98, 100.98, 101.28294], [0.9, 0.8, 0.1, 0.7, 0.9]
    rows = [("s", "p", T0 + dt.timedelta(minutes=5 * i), p, q, 0.0) for i, (p, q) in enumerate(zip(price, probability))]
    scored = spark.createDataFrame(
        rows, "symbol string, period string, open_time timestamp_ntz, close double, probability double, fees_zscore double")
    curve = evaluate.equity(evaluate.trades(scored)).orderBy("open_time").toPandas()
    assert list(curve["pnl_pct"]) == pytest.approx([0.005, -0.002, 0.003])
    assert list(curve["capital"]) == pytest.approx([10_001.0, 10_001.0 * 0.99996, 10_001.0 * 0.99996 * 1.00006])
    got = evaluate.period_metrics(spark.createDataFrame(curve)).first()
    assert (got.trades, got.win_rate, got.profit_factor) == (3, pytest.approx(2 / 3), pytest.approx(4.0))
    assert got.total_return == pytest.approx(1.0001 * 0.99996 * 1.00006 - 1)
    assert got.max_drawdown == pytest.approx(0.00004)
    # Steps 1e-4, -4e-5, 6e-5: mean 4e-5, variance (36 + 64 + 4) / 3 * 1e-10.
    assert got.sharpe == pytest.approx(4e-5 / math.sqrt(104 / 3 * 1e-10) * math.sqrt(252), rel=1e-4)


def test_profit_factor_without_losses_and_flat_sharpe(spark):
    rows = [("s", "p", T0 + dt.timedelta(minutes=i), 0.001, 0.0) for i in range(3)]
    curve = spark.createDataFrame(rows, "symbol string, period string, open_time timestamp_ntz, pnl_pct double, drawdown double")
    got = evaluate.period_metrics(curve).first()
    assert math.isinf(got.profit_factor) and got.sharpe == 0.0 and got.max_drawdown == 0.0


def test_periods_are_half_open(spark):
    p = evaluate.Period("x", "2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03")
    rows = [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 3),)]
    out = evaluate.with_periods(spark.createDataFrame(rows, "open_time timestamp_ntz"), [p]).orderBy("open_time").collect()
    assert [(r.open_time.day, r.role) for r in out] == [(1, "train"), (2, "test")]
    assert len(evaluate.HALF_YEARS) == 12


def test_expanding_folds(spark):
    n = 32
    df = spark.createDataFrame([(i,) for i in range(n)], "i int")
    out = evaluate.time_folds(df, "i").toPandas()
    for fold in range(1, 6):
        start = n - (6 - fold) * 5
        part = out[out.fold == fold]
        assert sorted(part[part.role == "test"].i) == list(range(start, start + 5))
        assert sorted(part[part.role == "train"].i) == list(range(start))


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "a double, p double")
    got = evaluate.regression_metrics(df, [], "a", "p").first()
    a, p = np.array([1, 2, 4.0]), np.array([1.5, 2, 3.0])
    assert got.mae == pytest.approx(abs(a - p).mean())
    assert got.r2 == pytest.approx(1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum())


def test_connected_components(spark):
    rng = np.random.default_rng(2)
    edges = [(f"n{a:03d}", f"n{b:03d}") for a, b in rng.integers(0, 150, (90, 2))] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = {r.node: r.component for r in models.connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {node: root(node) for node in parent}


def test_density_regimes(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(0, 0.2, (300, 3)), rng.normal(5, 0.2, (100, 3)), rng.uniform(-20, -10, (15, 3)),
                             np.tile([[9.0, -9.0, 9.0]], (20, 1))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "i int, x double, y double, z double")
    out = models.density_regimes(df, ["x", "y", "z"]).toPandas().sort_values("i")
    labels = out["cluster"].to_numpy()
    assert len(labels) == len(points)
    first, second = labels[:300], labels[300:400]
    main = pd.Series(first).mode()[0], pd.Series(second).mode()[0]
    assert main[0] != main[1] and -1 not in main
    assert (first == main[0]).mean() > 0.95 and (second == main[1]).mean() > 0.95
    assert set(labels[400:415]) == {-1}   # scattered
    assert set(labels[415:]) == {-1}      # dense, but smaller than a cluster may be


def _plain_regimes(points, radius, least, smallest):
    """Every point against every other; clusters by walking from core point to core point."""
    gaps = ((points[:, None] - points[None]) ** 2).sum(-1)
    near = gaps <= radius * radius
    core = near.sum(1) >= least
    label = np.full(len(points), -1)
    for start in np.flatnonzero(core):
        walk = [start] if label[start] < 0 else []
        while walk:
            at = walk.pop()
            if label[at] < 0:
                label[at] = start
                walk.extend(np.flatnonzero(near[at] & core & (label < 0)))
    for at in np.flatnonzero(~core):
        beside = np.flatnonzero(near[at] & core)
        if len(beside):
            label[at] = label[beside[gaps[at, beside].argmin()]]
    sizes = np.bincount(label[label >= 0], minlength=len(points))
    return np.where((label >= 0) & (sizes[label] >= smallest), label, -1)


@pytest.mark.parametrize("levels", [0, 2])
def test_density_regimes_equal_plain_clustering(spark, levels):
    rng = np.random.default_rng(12)
    ring = np.stack([3 * np.cos(np.linspace(0, 6, 500)), 3 * np.sin(np.linspace(0, 6, 500)), np.zeros(500)], axis=1)
    points = np.concatenate([
        rng.normal(0, 0.4, (700, 3)), ring + rng.normal(0, 0.15, (500, 3)), rng.uniform(-4, 4, (400, 3)),
        np.tile([[2.0, -2.0, 2.0]], (400, 1)), np.tile([[2.3, -2.3, 2.2]], (9, 1)), np.round(rng.normal(-3, 0.5, (300, 3)), 1)])
    rows = [(i, *map(float, p)) for i, p in enumerate(points)] + [(-1, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "i int, x double, y double, z double")
    got = {r.i: r.cluster for r in models.density_regimes(df, ["x", "y", "z"], levels=levels).collect()}
    assert len(got) == len(rows) and got.pop(-1) == -1
    got = np.array([got[i] for i in range(len(points))])
    want = _plain_regimes(points, 0.5, 10, 30)
    assert len(set(want)) > 3 and (want == -1).any()
    assert ((got == -1) == (want == -1)).all()
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_standardize_and_components(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(0, 3, 200)
    data = np.stack([base + rng.normal(0, 0.1, 200), 2 * base + 7, np.full(200, 4.0)], axis=1)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "i int, a double, b double, c double")
    scaled = models.standardize(df, ["a", "b", "c"])
    got = scaled.orderBy("i").toPandas()
    np.testing.assert_allclose(got["b_z"], (data[:, 1] - data[:, 1].mean()) / data[:, 1].std())
    assert (got["c_z"] == 0).all()
    projected, shares = models.principal_components(scaled, ["a_z", "b_z"])
    assert shares[0] > 0.99 and sum(shares) == pytest.approx(1)
    assert projected.agg(F.corr("pca1", "b_z")).first()[0] > 0.99


def test_walk_forward_and_fee_model(spark):
    rng = np.random.default_rng(8)
    n = 420
    features = models.FEATURES
    rows = []
    for i in range(n):
        x = rng.normal(0, 1, len(features))
        rows.append(("s", T0 + dt.timedelta(hours=i), 100.0 + float(rng.normal()), int(x[0] > 0), *map(float, x)))
    schema = "symbol string, open_time timestamp_ntz, close double, target int, " + ", ".join(f"{f} double" for f in features)
    matrix = spark.createDataFrame(rows, schema)
    fit = evaluate.Period("fit", "2024-01-01", "2024-01-13", "2024-01-13", "2024-01-18")
    short = evaluate.Period("short", "2023-01-01", "2023-02-01", "2024-01-13", "2024-01-18")
    scored, spans = models.walk_forward(matrix, [fit, short], trees=3)
    assert {tuple(r) for r in spans.collect()} == {("fit", 288, 120, 2, "fit"), ("short", 0, 120, 0, "skipped")}
    nothing, spans = models.walk_forward(matrix, [short], trees=3)
    assert nothing.isEmpty() and "probability" in nothing.columns and spans.first().status == "skipped"
    one_class = matrix.withColumn("target", F.lit(1))
    nothing, spans = models.walk_forward(one_class, [fit], trees=3)
    assert nothing.isEmpty() and tuple(spans.first()) == ("fit", 288, 120, 1, "skipped")
    assert scored.select("period").distinct().collect()[0][0] == "fit"  # too few rows: left out
    hit = scored.agg(F.avg(((F.col("probability") >= 0.5).cast("int") == F.col("target")).cast("double"))).first()[0]
    assert scored.count() == 120 and hit > 0.9

    days = [(dt.date(2018, 1, 1) + dt.timedelta(days=i), 100.0 + i, float(10 + 5 * math.sin(i / 3) + rng.random()), 0.0, 0.1, 1.0)
            for i in range(260)]
    joined = spark.createDataFrame(days, "date date, btc_price double, fees_btc double, log_return double, volatility_30d double, range_pct double")
    frame = models.fee_model_frame(joined)
    assert frame.count() == 260 - 29 - 1
    predictions, importance = models.fee_cross_validation(frame, trees=3, k=2)
    assert importance.count() == len(models.FEE_FEATURES)
    assert predictions.groupBy("fold").count().count() == 2
    assert predictions.filter("predicted is null").isEmpty()


def test_normal_days_keep_their_share_at_every_size(spark):
    kept = F.avg((F.col("fees_btc") < models.NORMAL_DAY_COINS).cast("double"))
    small, large = (fee_frame(spark, f"/root/testdata/{size}").agg(kept).first()[0] for size in ("sf0.01", "sf0.1"))
    assert small > 0.95 and large == pytest.approx(small, abs=0.05)


def test_equity_scan_equals_a_plain_loop(spark):
    """One dominant symbol over many pieces, a null symbol, several trades a day, and highs in earlier pieces."""
    rng = random.Random(4)
    rows = [("a", 1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * i), rng.uniform(-0.3, 0.3)) for i in range(400)]
    rows += [(None, 1, dt.datetime(2024, 1, 1, i), rng.uniform(-0.3, 0.3)) for i in range(9)] + [("a", 2, dt.datetime(2024, 1, 1), -0.2)]
    done = spark.createDataFrame(rows, "symbol string, period int, open_time timestamp_ntz, pnl_pct double").repartition(4)
    for piece in (None, F.year("open_time"), F.col("open_time")):
        got = {(r.symbol, r.period, r.open_time): (r.capital, r.drawdown) for r in evaluate.equity(done, piece=piece).collect()}
        capital, top = {}, {}
        for symbol, period, at, pnl in rows:
            key = symbol, period
            capital[key] = capital.get(key, evaluate.INITIAL_CAPITAL) * (1 + pnl * evaluate.POSITION_SIZE)
            top[key] = max(top.get(key, evaluate.INITIAL_CAPITAL), capital[key])
            assert got[(*key, at)] == pytest.approx((capital[key], capital[key] / top[key] - 1), rel=1e-9, abs=1e-12)
        assert len(got) == len(rows)


def test_ordered_scans_use_as_many_pieces_as_rows_need(spark):
    values = spark.createDataFrame([(i * 7919 % 1000, f"k{i * 31 % 500:03d}") for i in range(3000)], "v bigint, s string").repartition(5)
    sizes = [quantiles.ordered_pieces(values.select("v").distinct(), "v", n).select("_bucket").distinct().count() for n in (2000, 250, 50)]
    assert sizes[0] == 1 and 3 <= sizes[1] <= 4 and 15 <= sizes[2] <= 20
    for n in (2000, 50):
        ranked = {r.value: r for r in quantiles.ranked_values(values, "v", n).collect()}
        below = 0
        for v in range(1000):
            assert (ranked[v].below_n, ranked[v].below_sum, ranked[v].total_n) == (3 * v, 3 * below, 3000)
            below += v
        coded = stats.alphabetical_codes(values, "s", "code", n).select("s", "code").distinct().collect()
        assert sorted((r.s, r.code) for r in coded) == [(f"k{i:03d}", float(i)) for i in range(500)]
