"""Standardising, clusters, projection and fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chainstrata.operators import candles, evaluate, fees, indicators, models, stats
from chainstrata.operators.evaluate import Period
from chainstrata.plans import standins as t
from chainstrata.plans.market import COMPLETE, FEATURES, PERIODS
from chainstrata.plans.registry import present, query, r
from chainstrata.session import materialized
from chainstrata.sources import model_store

DIMENSIONS = tuple(f"e{i:02d}" for i in range(64))
# A period before the tables begin: it has no rows and is skipped.
EARLY = Period("first", "2023-11-01", "2023-12-01", "2023-12-01", "2024-01-01")
MEAN_DAY_COINS = 20.0  # mean daily fees of the stand-in series


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(DIMENSIONS)])


@query(f"""WITH v AS (SELECT vec_id, {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(DIMENSIONS))} FROM embeddings)
  SELECT vec_id, {", ".join(f"{r(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()', 5)} AS {c}_z" for c in DIMENSIONS)} FROM v""")
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    scaled = models.standardize(_vectors(spark, sf), DIMENSIONS)
    return present(scaled.select("vec_id", *[f"{c}_z" for c in DIMENSIONS]), 5)


@query(f"""WITH {t.JOINED}, overall AS (SELECT avg(fees_btc) AS f, avg(btc_price) AS p FROM scored)
  SELECT regime, count(*) AS n, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date,
  {r('avg(fees_btc)', 3)} AS mean_fees_btc, {r('avg(btc_price)', 3)} AS mean_btc_price,
  {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct, {r('(avg(fees_btc) - max(f)) / max(f) * 100', 5)} AS dev_fees_btc,
  {r('(avg(btc_price) - max(p)) / max(p) * 100', 5)} AS dev_btc_price FROM scored, overall GROUP BY 1""")
def cluster_profiles(spark: SparkSession, sf: str) -> DataFrame:
    daily = fees.divergence(fees.prices_with_fees(t.daily_prices(spark, sf), t.daily_fees(spark, sf)))
    out = models.cluster_profiles(daily, ["fees_btc", "btc_price"], "regime")
    return present(out, mean_fees_btc=3, mean_btc_price=3, dev_fees_btc=5, dev_btc_price=5)


def _market_days(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars of the lines' prices with that day's fees, in coins."""
    lines = t.table(spark, sf, "lineitem")
    price = F.col("l_extendedprice")
    daily = candles.resample(lines.select(
        F.lit("ALL").alias("symbol"), F.date_trunc("day", F.col("l_shipdate")).cast("timestamp_ntz").alias("open_time"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tie"),
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
        F.col("l_quantity").alias("volume"), price.alias("quote_volume"), F.lit(1).cast("bigint").alias("trades"),
    ), "1d", tie="tie").withColumn("date", F.to_date("open_time"))
    measured = candles.daily_measures(daily).withColumn("btc_price", F.col("close"))
    prices = measured.select("date", "btc_price", "log_return", "volatility_30d", "range_pct")
    return fees.prices_with_fees(prices, t.daily_fees(spark, sf, 1e8))


def fee_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the fee model.

    A day of the stand-in holds more fees the larger the tables are, so the series
    is set to one mean level; the bound of a normal day then keeps the same share of
    days at every size.
    """
    daily = _market_days(spark, sf)
    level = F.col("fees_btc") / F.avg("fees_btc").over(Window.partitionBy())
    return models.fee_model_frame(daily.withColumn("fees_btc", level * MEAN_DAY_COINS))


# Market days in SQL.
MARKET_DAYS = t.DAILY + """,
day_bars AS (
  SELECT date, arg_min(price, k) AS open, max(price) AS high, min(price) AS low, arg_max(price, k) AS close
  FROM (SELECT CAST(l_shipdate AS DATE) AS date, l_extendedprice AS price, l_orderkey * 10 + l_linenumber AS k FROM lineitem) GROUP BY 1),
day_returns AS (
  SELECT *, ln(nullif(close / nullif(lag(close) OVER (ORDER BY date), 0), 0)) AS log_return FROM day_bars),
day_measures AS (
  SELECT date, close AS btc_price, log_return, (high - low) / nullif(open, 0) * 100 AS range_pct,
         CASE WHEN count(log_return) OVER w = 30 THEN stddev_samp(log_return) OVER w * sqrt(365) END AS volatility
  FROM day_returns WINDOW w AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""

# Rows of the fee model in SQL, and their folds.
FEE_FOLDS = MARKET_DAYS + f""",
levels AS (
  SELECT *, f / avg(f) OVER () * {MEAN_DAY_COINS} AS fees
  FROM (SELECT m.*, coalesce(d.fee_units / 1e8, 0) AS f FROM day_measures m LEFT JOIN daily d ON d.date = m.date WHERE btc_price > 0)),
inputs AS (
  SELECT date, fees, lead(fees) OVER w AS target, lag(fees, 7) OVER w AS week_before, log_return, volatility, range_pct,
         avg(fees) OVER w30 AS mean30, stddev_samp(fees) OVER w30 AS std30, count(*) OVER w30 AS n30
  FROM levels WINDOW w AS (ORDER BY date), w30 AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
numbered AS (
  SELECT *, (fees - mean30) / std30 AS zscore, row_number() OVER (ORDER BY date) - 1 AS place, count(*) OVER () AS n
  FROM inputs WHERE target IS NOT NULL AND n30 = 30 AND std30 > 0 AND fees < {models.NORMAL_DAY_COINS}
    AND log_return IS NOT NULL AND volatility IS NOT NULL AND range_pct IS NOT NULL),
blocks AS (
  SELECT *, n - ({evaluate.FOLDS + 1} - fold) * (n // {evaluate.FOLDS + 1}) AS test_from
  FROM numbered, (SELECT CAST(unnest(range(1, {evaluate.FOLDS + 1})) AS BIGINT) AS fold)),
folds AS (
  SELECT *, CASE WHEN place < test_from THEN 'train' ELSE 'test' END AS role FROM blocks WHERE place < test_from + n // {evaluate.FOLDS + 1}),
naive AS (SELECT fold, target AS actual, fees AS predicted, target - fees AS residual FROM folds WHERE role = 'test')"""
_METRICS = f"""count(*) AS n, {r('avg(abs(residual))')} AS mae,
  {r('1 - sum(residual * residual) / (var_pop(actual) * count(*))')} AS r2 FROM naive"""


@query(f"""WITH {FEE_FOLDS} SELECT fold, role, count(*) AS n, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date,
  {r('avg(ln(1 + target))')} AS mean_target, {r('avg(ln(1 + week_before))')} AS mean_lag7, {r('avg(zscore)', 5)} AS mean_zscore FROM folds GROUP BY 1, 2""")
def fee_folds(spark: SparkSession, sf: str) -> DataFrame:
    """The spans the fee model learns from and is tested on."""
    frame = fee_frame(spark, sf)
    folded = evaluate.time_folds(frame.filter(F.col("fees_btc") < models.NORMAL_DAY_COINS), "date")
    return present(folded.groupBy("fold", "role").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.avg("target_log").alias("mean_target"), F.avg("fees_lag7_log").alias("mean_lag7"),
        F.avg("fees_zscore").alias("mean_zscore")), mean_zscore=5)


@query(f"""WITH {FEE_FOLDS} SELECT fold, {_METRICS} GROUP BY 1
  UNION ALL SELECT CAST(NULL AS BIGINT), {_METRICS}""")
def fee_persistence_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the forecast a fitted model has to beat: tomorrow is as today."""
    predictions = models.fee_persistence(fee_frame(spark, sf))
    by_fold = evaluate.regression_metrics(predictions, ["fold"], "actual", "predicted")
    overall = evaluate.regression_metrics(predictions, [], "actual", "predicted")
    return present(by_fold.unionByName(overall.withColumn("fold", F.lit(None).cast("int"))))


@query(f"""WITH {FEE_FOLDS}, ends AS (SELECT min(residual) AS lo, max(residual) AS hi, avg(residual) AS m, stddev_pop(residual) AS s FROM naive),
  hits AS (SELECT least(floor((residual - lo) / (hi - lo) * 80), 79) AS bin, count(*) AS n FROM naive, ends GROUP BY 1)
  SELECT CAST(g.range AS BIGINT) AS bin, {r('lo + g.range * ((hi - lo) / 80)')} AS bin_low, {r('lo + (g.range + 1) * ((hi - lo) / 80)')} AS bin_high,
  coalesce(n, 0) AS n, {r('m')} AS mean_residual, {r('s')} AS std_residual FROM range(80) g LEFT JOIN hits ON hits.bin = g.range, ends""")
def fee_persistence_residuals(spark: SparkSession, sf: str) -> DataFrame:
    return _residual_bars(models.fee_persistence(fee_frame(spark, sf)))


def _residual_bars(predictions: DataFrame) -> DataFrame:
    rated = predictions.withColumn("residual", F.col("actual") - F.col("predicted"))
    stored = materialized(rated, "residuals")
    summary = evaluate.residual_summary(stored, "actual", "predicted")
    bars = stats.histogram(stored, "residual", 80)
    return present(bars.withColumns({
        "mean_residual": summary.select("mean_residual").scalar(),
        "std_residual": summary.select("std_residual").scalar(),
    }))


def _fee_fit(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Predictions and importance of the published fit, done once per content of the frame."""
    frame = materialized(fee_frame(spark, sf), "fee-frame")

    def build() -> dict[str, DataFrame]:
        predictions, importance = models.fee_cross_validation(frame)
        return {"predictions": predictions, "importance": importance}

    key = f"{models.TREES}-{evaluate.FOLDS}-{model_store.fingerprint(frame)}"
    return model_store.stored_once(spark, "fee-fit", key, build)


@query()
def fee_gbt_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Error per fold and overall (fold null) of the next-day fee model."""
    predictions = _fee_fit(spark, sf)["predictions"]
    by_fold = evaluate.regression_metrics(predictions, ["fold"], "actual", "predicted")
    overall = evaluate.regression_metrics(predictions, [], "actual", "predicted")
    return present(by_fold.unionByName(overall.withColumn("fold", F.lit(None).cast("int"))))


@query()
def fee_residuals(spark: SparkSession, sf: str) -> DataFrame:
    """Histogram of residuals beside their mean and deviation."""
    return _residual_bars(_fee_fit(spark, sf)["predictions"])


@query()
def fee_importance(spark: SparkSession, sf: str) -> DataFrame:
    return present(_fee_fit(spark, sf)["importance"].orderBy(F.desc("importance")))


def _cluster_rows(spark: SparkSession, sf: str) -> DataFrame:
    return models.standardize(models.cluster_frame(_market_days(spark, sf)), models.CLUSTER_FEATURES)


# Standardised market days in SQL.
CLUSTER_ROWS = MARKET_DAYS + f""",
market AS (
  SELECT *, ln(1 + fees_btc) AS fees_log, ln(btc_price) AS price_log
  FROM (SELECT m.*, coalesce(d.fee_units / 1e8, 0) AS fees_btc FROM day_measures m LEFT JOIN daily d ON d.date = m.date)
  WHERE btc_price > 0 AND log_return IS NOT NULL AND range_pct IS NOT NULL AND volatility IS NOT NULL),
z AS (
  SELECT date, fees_btc, btc_price, volatility, {", ".join(
      f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END AS z{i}"
      for i, c in enumerate(models.CLUSTER_FEATURES))}
  FROM market)"""
REGIME_ROUNDS = 100
_GAP = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(models.CLUSTER_FEATURES)))


@query(f"""WITH RECURSIVE {CLUSTER_ROWS},
near AS (SELECT a.date AS a, b.date AS b, {_GAP} AS gap FROM z a, z b WHERE {_GAP} <= 0.25),
core AS (SELECT a AS day FROM near GROUP BY 1 HAVING count(*) >= 10),
links AS (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
spread(i, day, root) AS (
  SELECT 0, day, day FROM core UNION ALL
  SELECT max(s.i) + 1, l.a, min(s.root) FROM spread s JOIN links l ON l.b = s.day WHERE s.i < {REGIME_ROUNDS} GROUP BY l.a),
roots AS (SELECT day, root FROM spread WHERE i = {REGIME_ROUNDS}),
placed AS (
  SELECT day, root FROM roots UNION ALL
  SELECT n.a, arg_min(r.root, n.gap) FROM near n JOIN roots r ON r.day = n.b WHERE n.a NOT IN (FROM core) GROUP BY 1),
large AS (SELECT root FROM placed GROUP BY 1 HAVING count(*) >= 30),
labelled AS (SELECT z.*, l.root FROM z LEFT JOIN placed p ON p.day = z.date LEFT JOIN large l ON l.root = p.root),
overall AS (SELECT avg(fees_btc) AS f, avg(btc_price) AS p, avg(volatility) AS v FROM z)
SELECT CASE WHEN root IS NULL THEN -1 ELSE row_number() OVER (ORDER BY root IS NULL, count(*) DESC, min(date)) END AS cluster,
  count(*) AS n, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date,
  {r('avg(fees_btc)')} AS mean_fees_btc, {r('avg(btc_price)')} AS mean_btc_price, {r('avg(volatility)')} AS mean_volatility,
  {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct, {r('(avg(fees_btc) - max(f)) / max(f) * 100')} AS dev_fees_btc,
  {r('(avg(btc_price) - max(p)) / max(p) * 100')} AS dev_btc_price, {r('(avg(volatility) - max(v)) / max(v) * 100')} AS dev_volatility
FROM labelled, overall GROUP BY root""")
def regime_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of the density regimes, numbered by size; -1 is noise."""
    columns = [f"{c}_z" for c in models.CLUSTER_FEATURES]
    rows = materialized(_cluster_rows(spark, sf), "regimes")
    labelled = models.density_regimes(rows, columns)
    profiles = models.cluster_profiles(labelled, ["fees_btc", "btc_price", "volatility"])
    nth = F.row_number().over(Window.orderBy(F.col("cluster") == -1, F.desc("n"), "first_date"))
    return present(profiles.withColumn("cluster", F.when(F.col("cluster") == -1, -1).otherwise(nth)))


def _component_sql(nth: int, of: str) -> str:
    """Leading component of a covariance table by repeated squaring: the powers tend to the component times itself."""
    return f"""power{nth}(step, i, j, c) AS (
  SELECT 0, i, j, c FROM {of} UNION ALL
  SELECT step + 1, i, j, c / max(abs(c)) OVER () FROM (
    SELECT max(x.step) AS step, x.i, y.j, sum(x.c * y.c) AS c FROM power{nth} x JOIN power{nth} y ON x.j = y.i WHERE x.step < 40 GROUP BY x.i, y.j)),
column{nth} AS (
  SELECT i, c FROM power{nth} WHERE step = 40 AND j = (SELECT arg_max(i, c) FROM power{nth} WHERE step = 40 AND i = j)),
loading{nth} AS (
  SELECT i, c / sqrt(sum(c * c) OVER ()) * sign(first_value(c) OVER (ORDER BY abs(c) DESC)) AS x FROM column{nth}),
value{nth} AS (SELECT sum(a.x * {of}.c * b.x) AS v FROM {of} JOIN loading{nth} a USING (i) JOIN loading{nth} b ON b.i = {of}.j)"""


@query(f"""WITH RECURSIVE {CLUSTER_ROWS},
long AS (SELECT date, unnest([0, 1, 2, 3, 4]) AS k, unnest([z0, z1, z2, z3, z4]) AS v FROM z),
covariance AS (SELECT a.k AS i, b.k AS j, covar_samp(a.v, b.v) AS c FROM long a JOIN long b USING (date) GROUP BY 1, 2),
{_component_sql(1, "covariance")},
rest AS (SELECT s.i, s.j, s.c - v * a.x * b.x AS c FROM covariance s JOIN loading1 a USING (i) JOIN loading1 b ON b.i = s.j, value1),
{_component_sql(2, "rest")},
total AS (SELECT sum(c) AS v FROM covariance WHERE i = j)
SELECT CAST(date AS VARCHAR) AS date, {r('sum(v * a.x)')} AS pca1, {r('sum(v * b.x)')} AS pca2,
  (SELECT {r('value1.v / total.v')} FROM value1, total) AS explained1, (SELECT {r('value2.v / total.v')} FROM value2, total) AS explained2
FROM long JOIN loading1 a ON a.i = k JOIN loading2 b ON b.i = k GROUP BY date""")
def pca_2d(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialized(_cluster_rows(spark, sf), "pca")
    projected, shares = models.principal_components(rows, [f"{c}_z" for c in models.CLUSTER_FEATURES])
    return present(projected.select("date", "pca1", "pca2", *[
        F.lit(share).alias(f"explained{i}") for i, share in enumerate(shares, 1)]))


def _walk_forward(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    bars = indicators.with_daily_zscore(t.stored_bars(spark, sf), t.shifted_zscores(spark, sf), lag_days=1)
    matrix = materialized(indicators.feature_matrix(bars), "matrix")

    def build() -> dict[str, DataFrame]:
        scored, spans = models.walk_forward(matrix, (EARLY, *PERIODS))
        return {"scored": scored, "spans": spans}

    key = f"{models.TREES}-{model_store.fingerprint(matrix)}"
    return model_store.stored_once(spark, "walk-forward-fit", key, build)


@query(f"""WITH RECURSIVE {FEATURES}, periods AS (SELECT * FROM (VALUES {", ".join(
      f"('{p.name}', TIMESTAMP '{p.train_start}', TIMESTAMP '{p.train_end}', TIMESTAMP '{p.test_start}', TIMESTAMP '{p.test_end}')"
      for p in (EARLY, *PERIODS))}) p(period, a, b, c, d)),
  sizes AS (SELECT period, count(open_time) FILTER (open_time >= a AND open_time < b) AS train,
    count(open_time) FILTER (open_time >= c AND open_time < d) AS test,
    count(DISTINCT target) FILTER (open_time >= a AND open_time < b) AS classes
    FROM periods LEFT JOIN (SELECT * FROM f WHERE {COMPLETE}) ON open_time >= a AND open_time < d GROUP BY 1)
  SELECT *, CASE WHEN train >= {models.MIN_TRAIN} AND test >= {models.MIN_TEST} AND classes > 1 THEN 'fit' ELSE 'skipped' END AS status FROM sizes""")
def walk_forward_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of every period and whether the model is fitted on it."""
    bars = indicators.with_daily_zscore(t.stored_bars(spark, sf), t.shifted_zscores(spark, sf), lag_days=1)
    periods = (EARLY, *PERIODS)
    return present(models.walk_forward_spans(evaluate.with_periods(indicators.feature_matrix(bars), periods), periods))


@query()
def walk_forward_gbt(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics per symbol and period of the fitted next-bar model."""
    curve = evaluate.equity(evaluate.trades(_walk_forward(spark, sf)["scored"]))
    return present(evaluate.period_metrics(curve))
