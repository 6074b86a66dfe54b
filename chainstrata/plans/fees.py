"""Fee series, momentum, regimes, calendar tables and headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainstrata.functions import calendar, money
from chainstrata.operators import cohorts, evaluate, fees, series, stats, streaks
from chainstrata.plans import standins as t
from chainstrata.plans.registry import present, query, r
from chainstrata.sources import catalog

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query(f"WITH {t.DAILY} SELECT CAST(date AS VARCHAR) AS date, {r('fees_btc', 2)} AS fees_btc, num_blocks FROM daily")
def daily_fees(spark: SparkSession, sf: str) -> DataFrame:
    return present(t.daily_fees(spark, sf).select("date", "fees_btc", "num_blocks").orderBy("date"), fees_btc=2)


@query(f"""WITH {t.ZSCORES} SELECT CAST(date AS VARCHAR) AS date, {r('fees_btc', 2)} AS fees_btc,
  {r('fees_ma30', 3)} AS fees_ma30, {r('fees_std30', 3)} AS fees_std30, {r('fees_zscore')} AS fees_zscore, regime
  FROM momentum""")
def daily_fee_momentum(spark: SparkSession, sf: str) -> DataFrame:
    out = fees.momentum(t.daily_fees(spark, sf)).orderBy("date")
    return present(out.select("date", "fees_btc", "fees_ma30", "fees_std30", "fees_zscore", "regime"),
                   fees_btc=2, fees_ma30=3, fees_std30=3)


@query(f"""WITH {t.DAILY} SELECT CAST(date AS VARCHAR) AS date, {r('fees_btc', 2)} AS fees_btc,
  CASE WHEN count(*) OVER w7 = 7 THEN {r('avg(fees_btc) OVER w7', 3)} END AS ma7,
  CASE WHEN count(*) OVER w30 = 30 THEN {r('avg(fees_btc) OVER w30', 3)} END AS ma30
  FROM daily WINDOW w7 AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),
  w30 AS (ORDER BY date ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)""")
def fee_centered_ma(spark: SparkSession, sf: str) -> DataFrame:
    out = fees.centered_averages(t.daily_fees(spark, sf))
    return present(out.select("date", "fees_btc", "ma7", "ma30").orderBy("date"), fees_btc=2, ma7=3, ma30=3)


def _divergence(spark: SparkSession, sf: str) -> DataFrame:
    return fees.divergence(fees.prices_with_fees(t.daily_prices(spark, sf), t.daily_fees(spark, sf)))


@query(f"""WITH {t.JOINED} SELECT CAST(date AS VARCHAR) AS date, {r('btc_price', 8)} AS btc_price, {r('fees_btc', 2)} AS fees_btc,
  {r('fees_zscore')} AS fees_zscore, {r('price_zscore')} AS price_zscore, {r('divergence')} AS divergence, regime,
  CASE WHEN count(fees_zscore) OVER c7 = 7 THEN {r('avg(fees_zscore) OVER c7')} END AS fees_zscore_ma7,
  CASE WHEN count(price_zscore) OVER t7 = 7 THEN {r('avg(price_zscore) OVER t7')} END AS price_zscore_ma7,
  CASE WHEN count(divergence) OVER t30 = 30 THEN {r('avg(divergence) OVER t30')} END AS divergence_ma30
  FROM scored WINDOW c7 AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),
  t7 AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
  t30 AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def fee_price_divergence(spark: SparkSession, sf: str) -> DataFrame:
    out = _divergence(spark, sf).select(
        "date", "btc_price", "fees_btc", "fees_zscore", "price_zscore", "divergence", "regime",
        "fees_zscore_ma7", "price_zscore_ma7", "divergence_ma30")
    return present(out.orderBy("date"), btc_price=8, fees_btc=2)


@query(f"""WITH {t.DAILY}, {t.PRICES}, f AS (
  SELECT *, CASE WHEN count(*) OVER w = 30 THEN avg(fees_btc) OVER w END AS ma30 FROM daily
  WINDOW w AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
  SELECT CAST(f.date AS VARCHAR) AS date, {r('fees_btc', 2)} AS fees_btc, {r('ma30', 3)} AS ma30, v.volume,
  {r('c.btc_price', 8)} AS btc_price
  FROM f LEFT JOIN prices v ON v.date = f.date JOIN prices c ON c.date = f.date""")
def fees_with_volume(spark: SparkSession, sf: str) -> DataFrame:
    """Fee series with volume (left) and price (inner) of the same day."""
    daily, prices = t.daily_fees(spark, sf), t.daily_prices(spark, sf)
    w = fees.by_date()
    with_ma = daily.withColumn("ma30", series.rolling_mean(F.col("fees_btc"), w, 30))
    out = (
        with_ma.join(prices.select("date", "volume"), "date", "left")
        .join(prices.select("date", "btc_price"), "date")
    )
    return present(out.select("date", "fees_btc", "ma30", "volume", "btc_price").orderBy("date"),
                   fees_btc=2, ma30=3, btc_price=8)


NORMAL_DAY = 1.25  # of the mean day

STREAKS = t.JOINED + """,
flagged AS (
  SELECT *, sum(changed) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS streak_id FROM (
    SELECT *, CASE WHEN lag(regime) OVER (ORDER BY date) IS NOT DISTINCT FROM regime THEN 0 ELSE 1 END AS changed FROM scored)),
runs AS (
  SELECT streak_id, min(date) AS start_date, max(date) AS end_date, count(*) AS days, max(fees_zscore) AS max_zscore,
         avg(fees_btc) AS avg_fees, arg_min(btc_price, date) AS price_start, arg_max(btc_price, date) AS price_end
  FROM flagged WHERE regime = 'elevated' GROUP BY 1)"""


@query(f"""WITH {STREAKS} SELECT CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, days,
  {r('max_zscore')} AS max_zscore, {r('avg_fees', 5)} AS avg_fees, {r('price_start', 8)} AS price_start,
  {r('price_end', 8)} AS price_end FROM runs""")
def regime_streaks(spark: SparkSession, sf: str) -> DataFrame:
    runs = streaks.streaks(_divergence(spark, sf), "regime", "elevated").drop("streak_id")
    return present(runs.orderBy(F.desc("max_zscore"), "start_date"), avg_fees=5, price_start=8, price_end=8)


@query(f"WITH {STREAKS} SELECT count(*) AS streaks, {r('avg(days)')} AS avg_days, max(days) AS max_days FROM runs")
def streak_totals(spark: SparkSession, sf: str) -> DataFrame:
    return present(streaks.streak_totals(streaks.streaks(_divergence(spark, sf), "regime", "elevated")))


@query(f"""WITH {t.ZSCORES} SELECT regime, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct
  FROM momentum GROUP BY 1""")
def regime_share(spark: SparkSession, sf: str) -> DataFrame:
    return present(cohorts.label_share(fees.momentum(t.daily_fees(spark, sf)), "regime").orderBy("regime"))


@query(f"""WITH {t.DAILY} SELECT count(*) AS n, count(*) FILTER (low) AS kept,
  {r('count(*) FILTER (low) * 100.0 / count(*)')} AS kept_pct
  FROM (SELECT fees_btc < {NORMAL_DAY} * avg(fees_btc) OVER () AS low FROM daily)""")
def normal_day_share(spark: SparkSession, sf: str) -> DataFrame:
    """Share of days below a fee level, set by the mean day so that it means the same at every size."""
    daily = t.daily_fees(spark, sf)
    level = daily.agg(F.avg("fees_btc") * NORMAL_DAY).scalar()
    return present(cohorts.predicate_share(daily, F.col("fees_btc") < level))


@query(f"""WITH {t.DAILY} SELECT count(*) AS days, {r('avg(fees_btc)', 3)} AS mean_fees,
  {r('quantile_cont(fees_btc, 0.5)', 3)} AS median_fees, {r('max(fees_btc)', 2)} AS max_fees,
  CAST(arg_max(date, (fees_btc, -(date - DATE '1970-01-01'))) AS VARCHAR) AS max_date,
  CAST(sum(fee_units) AS BIGINT) AS total_units, CAST(min(date) AS VARCHAR) AS first_date,
  CAST(max(date) AS VARCHAR) AS last_date FROM daily""")
def fee_summary(spark: SparkSession, sf: str) -> DataFrame:
    return present(fees.fee_summary(t.daily_fees(spark, sf)), 3)


@query(f"""WITH {t.DAILY} SELECT CAST(date AS VARCHAR) AS date, {r('fees_btc', 2)} AS fees_btc, num_blocks
  FROM daily ORDER BY fee_units DESC, daily.date LIMIT 10""")
def top_fee_days(spark: SparkSession, sf: str) -> DataFrame:
    out = t.daily_fees(spark, sf).orderBy(F.desc("fee_units"), "date").limit(10)
    return present(out.select("date", "fees_btc", "num_blocks"), 2)


@query(f"""WITH {t.JOINED} SELECT CAST(date AS VARCHAR) AS date, {r('fees_btc', 2)} AS fees_btc,
  {r('btc_price', 0)} AS btc_price, {r('fees_zscore', 4)} AS fees_zscore, {r('price_zscore', 4)} AS price_zscore,
  {r('divergence', 4)} AS divergence, regime
  FROM scored WHERE fees_zscore IS NOT NULL ORDER BY scored.fees_zscore DESC, scored.date LIMIT 10""")
def top_momentum_days(spark: SparkSession, sf: str) -> DataFrame:
    out = _divergence(spark, sf).filter("fees_zscore is not null").orderBy(F.desc("fees_zscore"), "date").limit(10)
    return present(out.select("date", "fees_btc", "btc_price", "fees_zscore", "price_zscore", "divergence", "regime"),
                   4, fees_btc=2, btc_price=0)


@query(f"""WITH {t.DAILY} SELECT CAST(date AS VARCHAR) AS date, {r('fees_btc', 2)} AS fees_btc FROM daily
  WHERE date >= (SELECT max(date) - INTERVAL 2 YEAR FROM daily)""")
def recent_two_years(spark: SparkSession, sf: str) -> DataFrame:
    out = fees.since_years_before_last(t.daily_fees(spark, sf), 2)
    return present(out.select("date", "fees_btc").orderBy("date"), 2)


ORDER_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
ORDER_HEIGHT = "CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS BIGINT)"


@query(f"""SELECT count(*) AS blocks, CAST(sum({ORDER_CENTS}) AS BIGINT) AS total_fee_units,
  max({ORDER_CENTS}) AS max_fee_units, max({ORDER_HEIGHT}) AS last_block FROM orders""")
def kpi_row(spark: SparkSession, sf: str) -> DataFrame:
    return present(fees.kpi_row(t.orders(spark, sf), t.height_of(F.col("o_orderdate")), money.cents(F.col("o_totalprice"))))


@query(f"""WITH {t.ZSCORES} SELECT CAST(max(date) AS VARCHAR) AS date, {r('arg_max(fees_btc, date)', 2)} AS fees_btc,
  {r('arg_max(fees_zscore, date)')} AS fees_zscore FROM momentum""")
def latest_row(spark: SparkSession, sf: str) -> DataFrame:
    daily = fees.momentum(t.daily_fees(spark, sf))
    newest = daily.agg(F.max_by(F.struct("date", "fees_btc", "fees_zscore"), "date").alias("row"))
    return present(newest.select("row.*"), fees_btc=2)


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TABLES))
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.row_counts({name: t.table(spark, sf, name) for name in TABLES})


def _hour_cells(value: str, digits: int) -> str:
    return ", ".join(f"{r(f'avg({value}) FILTER (hour = {h})', digits)} AS h{h:02d}" for h in range(24))


@query(f"""WITH e AS (SELECT isodow(ts) - 1 AS weekday, hour(ts) AS hour, value FROM events)
  SELECT CAST(d.range AS BIGINT) AS weekday, {_hour_cells('value', 8)}
  FROM range(7) d LEFT JOIN e ON e.weekday = d.range GROUP BY 1""")
def hour_weekday_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    events = t.table(spark, sf, "events")
    return present(stats.weekday_hour_means(events, F.col("ts"), "value").orderBy("weekday"), 8)


@query(f"""WITH e AS (SELECT isodow(ts) - 1 AS weekday, hour(ts) AS hour, value,
    CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events),
  s AS (SELECT weekday, hour, avg(value) AS a, count(*) AS n, max(value) AS m, avg(k) AS l FROM e GROUP BY 1, 2)
  SELECT ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][weekday + 1] || ' ' || lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS slot,
  {r('a', 8)} AS avg_value, {r('m', 2)} AS max_value, n, {r('l', 8)} AS avg_load
  FROM s ORDER BY a DESC, weekday, hour LIMIT 10""")
def slot_stats_top10(spark: SparkSession, sf: str) -> DataFrame:
    events = t.table(spark, sf, "events").withColumn("load", F.get_json_object("props", "$.k").cast("bigint"))
    slots = stats.slot_stats(events, F.col("ts"), "value", "load")
    top = slots.orderBy(F.desc("avg_value"), "weekday", "hour").limit(10)
    label = calendar.slot_label(F.col("weekday"), F.col("hour")).alias("slot")
    return present(top.select(label, "avg_value", "max_value", "n", "avg_load"), 8, max_value=2)


CYCLES = (("2024-01-07", "first"), ("2024-01-15", "second"), ("2024-01-22", "third"))


@query(f"""WITH e AS (SELECT isodow(ts) - 1 AS weekday, hour(ts) AS hour, value,
    CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-07' THEN 'first' WHEN CAST(ts AS DATE) <= DATE '2024-01-15' THEN 'second'
         WHEN CAST(ts AS DATE) <= DATE '2024-01-22' THEN 'third' ELSE 'fourth' END AS regime FROM events)
  SELECT g.regime, CAST(d.range AS BIGINT) AS weekday, {_hour_cells('value', 8)}
  FROM (SELECT DISTINCT regime FROM e) g CROSS JOIN range(7) d
  LEFT JOIN e ON e.weekday = d.range AND e.regime = g.regime GROUP BY 1, 2""")
def date_regime_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    label = calendar.cycle_label(F.to_date("ts"), CYCLES, "fourth")
    events = t.table(spark, sf, "events").withColumn("regime", label)
    return present(stats.weekday_hour_means(events, F.col("ts"), "value", ["regime"]).orderBy("regime", "weekday"), 8)


EVENT_DATES = ("1996-07-09", "1998-11-28", "2000-03-26")


@query("""SELECT CAST(date AS VARCHAR) AS date, coalesce((SELECT min(CAST(e - date AS BIGINT)) FROM
    (SELECT unnest([DATE '1996-07-09', DATE '1998-11-28', DATE '2000-03-26']) AS e) WHERE e > date), 999) AS days_to_event
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)""")
def days_to_event(spark: SparkSession, sf: str) -> DataFrame:
    days = t.orders(spark, sf).select(F.to_date("o_orderdate").alias("date")).distinct()
    return present(days.withColumn("days_to_event", calendar.days_to_next(F.col("date"), EVENT_DATES)))


@query(f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, {ORDER_CENTS} / 1e2 AS fee FROM orders),
  today AS (SELECT max(date) AS day FROM o)
  SELECT {r('avg(fee) FILTER (date = day)', 5)} AS avg_today, {r('avg(fee)', 5)} AS avg_window,
  {r('stddev_pop(fee)', 5)} AS std_window,
  {r('coalesce((avg(fee) FILTER (date = day) - avg(fee)) / nullif(stddev_pop(fee), 0), 0)')} AS zscore
  FROM o, today WHERE date >= day - 30""")
def live_zscore(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.orders(spark, sf)
    date = F.to_date("o_orderdate")
    today = orders.agg(F.max(date)).scalar()
    out = fees.live_zscore(orders, date, money.cents(F.col("o_totalprice")) / 100, today)
    return present(out, avg_today=5, avg_window=5, std_window=5)


@query(f"""WITH {t.DAILY}, n AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS n FROM daily),
  f AS (SELECT n.*, fold, n.n // 6 AS size, n.n - (6 - fold) * (n.n // 6) AS start
        FROM n CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS fold))
  SELECT CAST(fold AS BIGINT) AS fold, CASE WHEN pos < start THEN 'train' ELSE 'test' END AS role, count(*) AS n,
  CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date, CAST(sum(fee_units) AS BIGINT) AS fee_units
  FROM f WHERE pos < start + size GROUP BY 1, 2""")
def time_series_folds(spark: SparkSession, sf: str) -> DataFrame:
    folds = evaluate.time_folds(t.daily_fees(spark, sf), "date")
    return present(folds.groupBy("fold", "role").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum("fee_units").alias("fee_units")))


@query("""WITH o AS (SELECT o_orderkey AS key, o_orderkey * 140 AS height,
    CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT) AS time FROM orders),
  coinbase AS (SELECT DISTINCT l_orderkey AS key FROM lineitem WHERE l_returnflag = 'R'),
  paid AS (SELECT l_orderkey AS key, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sats
           FROM lineitem SEMI JOIN coinbase ON l_orderkey = key GROUP BY 1)
  SELECT height, md5(CAST(o.key AS VARCHAR)) AS block_hash, time, CAST(1 AS BIGINT) AS "nTx", subsidy AS subsidy_sats,
         greatest(coalesce(sats, 0) - subsidy, 0) AS fees_sats
  FROM (SELECT *, CASE WHEN height // 210000 >= 64 THEN 0 ELSE 5000000000 >> CAST(least(height // 210000, 62) AS INTEGER) END AS subsidy
        FROM o) o LEFT JOIN paid ON paid.key = o.key""")
def block_fee_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Heights run past the 64th halving; lines with flag R mark coinbase transactions."""
    blocks = t.orders(spark, sf).select(
        (F.col("o_orderkey") * 140).alias("height"), t.txid(F.col("o_orderkey")).alias("hash"),
        F.unix_seconds(F.to_date("o_orderdate").cast("timestamp")).alias("time"), F.lit(1).alias("nTx"))
    lines = t.table(spark, sf, "lineitem")
    key = [t.txid(F.col("l_orderkey")).alias("txid"), (F.col("l_orderkey") * 140).alias("height")]
    inputs = lines.select(*key, (F.col("l_returnflag") == "R").alias("is_coinbase"))
    outputs = lines.select(*key, money.cents(F.col("l_extendedprice")).alias("value_sats"))
    return present(fees.block_metrics(blocks, inputs, outputs).orderBy("height"))


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus FROM orders
  ORDER BY orders.o_orderkey LIMIT 5""")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.orders(spark, sf).withColumn("day", F.to_date("o_orderdate")).orderBy("o_orderkey")
    return present(catalog.preview(orders, ["o_orderkey", "day", "o_orderstatus"]))


ADHOC = """SELECT year(o_orderdate) AS y, o_orderstatus, count(*) AS n, max(o_orderkey) AS newest
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


@query(ADHOC)
def adhoc_sql(spark: SparkSession, sf: str) -> DataFrame:
    catalog.register(spark, {name: f"{sf}/{name}.parquet" for name in TABLES})
    catalog.refresh(spark, TABLES)
    return present(catalog.ask(spark, ADHOC))
