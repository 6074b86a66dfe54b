"""Outputs, balances, cohorts, distributions and holder snapshots."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainstrata.functions import calendar, money, scripts
from chainstrata.functions.bins import AGE_COHORTS, COIN_COHORTS, ERAS
from chainstrata.functions.columns import require_columns
from chainstrata.functions.ratios import log10_positive
from chainstrata.operators import cohorts, snapshots, stats, utxo
from chainstrata.operators.quantiles import exact_quantiles
from chainstrata.plans import standins as t
from chainstrata.plans.registry import present, query, r
from chainstrata.session import materialized, scratch_path
from chainstrata.sources import catalog, tables

# Cents per coin for cohort tables, so that the published edges divide the data.
COHORT_UNITS = 100_000.0
MIN_UNITS = 5_000_000


@query(f"""WITH {t.CREATES} SELECT 'create' AS event_type, txid, vout, value_sats, address, height, substr(txid, 1, 4) AS prefix
  FROM creates UNION ALL SELECT 'spend', txid, vout, 0, '', height, substr(txid, 1, 4) FROM spends""")
def utxo_union_events(spark: SparkSession, sf: str) -> DataFrame:
    return utxo.narrow_events(t.utxo_events(spark, sf))


def _narrow(spark: SparkSession, sf: str) -> DataFrame:
    return utxo.narrow_events(t.utxo_events(spark, sf))


def _unspent(spark: SparkSession, sf: str) -> DataFrame:
    narrow = _narrow(spark, sf)
    return utxo.unspent(utxo.creates(narrow), utxo.spends(narrow))


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    return utxo.balances(_unspent(spark, sf))


@query(f"WITH {t.UNSPENT} SELECT * FROM unspent")
def utxo_unspent(spark: SparkSession, sf: str) -> DataFrame:
    return _unspent(spark, sf)


@query(f"""WITH {t.UNSPENT} SELECT CAST(CAST('0x' || substr(txid, 1, 4) AS BIGINT) // 1024 AS BIGINT) AS bucket,
  count(*) AS n, CAST(sum(value_sats) AS BIGINT) AS value_sats FROM unspent GROUP BY 1""")
def unspent_by_prefix_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """Unspent value in 64 equal key ranges."""
    number = F.conv(scripts.key_prefix(F.col("txid")), 16, 10).cast("bigint")
    return _unspent(spark, sf).groupBy(F.floor(number / 1024).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum("value_sats").alias("value_sats"))


@query(f"WITH {t.BALANCES} SELECT * FROM balances")
def address_balance(spark: SparkSession, sf: str) -> DataFrame:
    return _balances(spark, sf)


@query(f"WITH {t.BALANCES} SELECT * FROM balances ORDER BY balance_sats DESC, address LIMIT 20")
def top_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return utxo.top_holders(_balances(spark, sf))


@query(f"""WITH {t.BALANCES} SELECT address, balance_sats, {r('balance_sats / 1e2', 2)} AS btc, last_seen_height,
  '2024-01-31' AS as_of FROM balances WHERE balance_sats >= {MIN_UNITS}""")
def balance_over_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Large holders, stored under two dates; the newest version is read back."""
    holders = utxo.large_holders(_balance_table(spark, sf), MIN_UNITS, 100.0)
    path = scratch_path(spark, "large-holders")
    tables.write_dated(holders.filter("btc > 60000"), path, "2024-01-24")
    tables.write_dated(holders, path, "2024-01-31")
    return present(tables.latest(spark, path).orderBy(F.desc("balance_sats"), "address"), 2)


@query(f"""WITH {t.BALANCES} SELECT count(*) AS n, count(*) FILTER (balance_sats >= {MIN_UNITS}) AS kept,
  {r(f'count(*) FILTER (balance_sats >= {MIN_UNITS}) * 100.0 / count(*)')} AS kept_pct FROM balances""")
def threshold_share(spark: SparkSession, sf: str) -> DataFrame:
    return present(cohorts.predicate_share(_balances(spark, sf), F.col("balance_sats") >= MIN_UNITS))


def _balance_table(spark: SparkSession, sf: str) -> DataFrame:
    """Balances as a stored table, for reports that read them more than once."""
    return materialized(_balances(spark, sf), "balances")


def _holders(spark: SparkSession, sf: str, stored: bool = False) -> DataFrame:
    """Balances with their cohorts; ``stored`` for reports that read them more than once."""
    height = F.col("last_seen_height") * t.HEIGHT_SCALE
    btc = F.col("balance_sats") / COHORT_UNITS
    balances = _balance_table(spark, sf) if stored else _balances(spark, sf)
    return balances.withColumns({
        "type": scripts.address_family(F.col("address")),
        "cohort": COIN_COHORTS.label(btc),
        "era": ERAS.label(height),
        "age_years": calendar.age_years_from_height(height, F.lit(t.TIP)),
    }).withColumn("is_satoshi", F.col("type") == scripts.OTHER_FAMILY)


def _ladder_sql(value: str, ladder, closed_left: bool = False) -> str:
    low, high = (">=", "<") if closed_left else (">", "<=")
    return "CASE " + " ".join(
        f"WHEN {value} {low} {ladder.edges[i]} AND {value} {high} {ladder.edges[i + 1]} THEN '{label}'"
        for i, label in enumerate(ladder.labels)) + " END"


def _labels_sql(ladder) -> str:
    return "(VALUES " + ", ".join(f"('{label}', {i})" for i, label in enumerate(ladder.labels)) + ")"


HOLDERS = t.BALANCES + f""",
holders AS (
  SELECT *, type = 'P2PK (Satoshi)' AS is_satoshi FROM (
    SELECT *, CASE WHEN address LIKE 'bc1%' THEN 'Bech32 (Native)' WHEN address LIKE '3%' THEN 'P2SH (SegWit)'
              WHEN address LIKE '1%' THEN 'P2PKH (Legacy)' ELSE 'P2PK (Satoshi)' END AS type,
           {_ladder_sql('(balance_sats / 1e5)', COIN_COHORTS)} AS cohort,
           {_ladder_sql('(last_seen_height * 400)', ERAS)} AS era,
           (1000000 - last_seen_height * 400) * 10 / 1440e0 / 365e0 AS age_years
    FROM balances)),
whole AS (SELECT count(*) AS n_all, CAST(sum(balance_sats) AS DOUBLE) AS total_all FROM holders)"""


@query(f"""WITH {HOLDERS}, labels AS (SELECT * FROM {_labels_sql(COIN_COHORTS)} l(cohort, ord)),
  a AS (SELECT cohort, count(*) AS n, CAST(sum(balance_sats) AS BIGINT) AS total, count(*) FILTER (is_satoshi) AS flagged_n,
        CAST(coalesce(sum(balance_sats) FILTER (is_satoshi), 0) AS BIGINT) AS flagged_total,
        quantile_cont(age_years, 0.5) AS median_age_years FROM holders GROUP BY 1)
  SELECT l.cohort, CAST(ord AS BIGINT) AS ord, coalesce(n, 0) AS n, coalesce(total, 0) AS total,
  coalesce(flagged_n, 0) AS flagged_n, coalesce(flagged_total, 0) AS flagged_total,
  {r('coalesce(n * 100.0 / n_all, 0)')} AS pct_n, {r('coalesce(total * 100.0 / total_all, 0)')} AS pct_total,
  coalesce(total - flagged_total, 0) AS rest_total, {r('coalesce(flagged_n * 100.0 / n, 0)')} AS flagged_pct,
  {r('median_age_years')} AS median_age_years
  FROM labels l LEFT JOIN a ON a.cohort = l.cohort, whole""")
def value_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    table = cohorts.share_table(_holders(spark, sf, stored=True), "cohort", "balance_sats", "is_satoshi", "age_years")
    kept = cohorts.kept_labels(COIN_COHORTS, table, "cohort", [
        "n", "total", "flagged_n", "flagged_total", "pct_n", "pct_total", "rest_total", "flagged_pct"])
    return present(kept.orderBy("ord"))


@query(f"""WITH {HOLDERS} SELECT type, count(*) AS n, CAST(sum(balance_sats) AS BIGINT) AS total,
  {r('count(*) * 100.0 / max(n_all)')} AS pct_n, {r('sum(balance_sats) * 100.0 / max(total_all)')} AS pct_total,
  {r('quantile_cont(age_years, 0.5)')} AS median_age_years FROM holders, whole GROUP BY 1""")
def type_stats(spark: SparkSession, sf: str) -> DataFrame:
    table = cohorts.share_table(_holders(spark, sf, stored=True), "type", "balance_sats", median_of="age_years")
    return present(table.orderBy(F.desc("total")))


@query(f"""WITH {HOLDERS}, labels AS (SELECT * FROM {_labels_sql(ERAS)} l(era, ord)),
  a AS (SELECT era, count(*) AS n, CAST(sum(balance_sats) AS BIGINT) AS total, count(*) FILTER (is_satoshi) AS flagged_n
        FROM holders GROUP BY 1)
  SELECT l.era, CAST(ord AS BIGINT) AS ord, coalesce(n, 0) AS n, coalesce(total, 0) AS total,
  {r('coalesce(total * 100.0 / total_all, 0)')} AS pct_total, coalesce(flagged_n, 0) AS flagged_n
  FROM labels l LEFT JOIN a ON a.era = l.era, whole""")
def era_stats(spark: SparkSession, sf: str) -> DataFrame:
    table = cohorts.share_table(_holders(spark, sf), "era", "balance_sats", "is_satoshi")
    kept = cohorts.kept_labels(ERAS, table, "era", ["n", "total", "pct_total", "flagged_n"])
    return present(kept.select("era", "ord", "n", "total", "pct_total", "flagged_n").orderBy("ord"))


@query(f"""WITH {HOLDERS}, labels AS (SELECT * FROM {_labels_sql(COIN_COHORTS)} l(cohort, ord)),
  a AS (SELECT cohort, count(*) AS n, CAST(sum(balance_sats) AS BIGINT) AS balance_sats_total FROM holders WHERE is_satoshi GROUP BY 1)
  SELECT l.cohort, CAST(ord AS BIGINT) AS ord, coalesce(n, 0) AS n, coalesce(balance_sats_total, 0) AS balance_sats_total
  FROM labels l LEFT JOIN a ON a.cohort = l.cohort""")
def filtered_cohort_subtotal(spark: SparkSession, sf: str) -> DataFrame:
    sums = cohorts.label_sums(_holders(spark, sf).filter("is_satoshi"), "cohort", "balance_sats")
    kept = cohorts.kept_labels(COIN_COHORTS, sums, "cohort", ["n", "balance_sats_total"])
    return present(kept.orderBy("ord"))


@query(f"""WITH {HOLDERS} SELECT count(*) AS n, CAST(sum(balance_sats) AS BIGINT) AS total,
  count(*) FILTER (is_satoshi) AS flagged_n, CAST(sum(balance_sats) FILTER (is_satoshi) AS BIGINT) AS flagged_total,
  {r('sum(balance_sats) FILTER (is_satoshi) * 100.0 / sum(balance_sats)')} AS flagged_pct,
  {r('sum(balance_sats) * 100.0 / 1e12')} AS supply_pct FROM holders""")
def flagged_supply(spark: SparkSession, sf: str) -> DataFrame:
    return present(cohorts.flagged_share(_holders(spark, sf), "balance_sats", F.col("is_satoshi"), 1e12))


@query(f"""WITH {HOLDERS}, c AS (SELECT type, cohort, count(*) AS n FROM holders WHERE cohort IS NOT NULL GROUP BY 1, 2),
  p AS (SELECT type, cohort, n * 100.0 / sum(n) OVER (PARTITION BY cohort) AS pct FROM c)
  SELECT type, {", ".join(f'''{r(f"coalesce(max(pct) FILTER (cohort = '{c}'), 0)")} AS "{c}"''' for c in COIN_COHORTS.labels)}
  FROM p GROUP BY 1""")
def type_cohort_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return present(cohorts.column_percentages(_holders(spark, sf), "type", "cohort", COIN_COHORTS.labels))


AS_OF = int(dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc).timestamp())


def _aged(spark: SparkSession, sf: str) -> DataFrame:
    """Created outputs with block time, age and age cohort. The last order of a day gives its block time."""
    blocks = t.orders(spark, sf).select(
        t.height_of(F.col("o_orderdate")).alias("height"),
        (F.unix_seconds(F.to_date("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400).alias("time"),
        "o_orderkey")
    times = blocks.groupBy("height").agg(F.max_by("time", "o_orderkey").alias("time"))
    outputs = t.utxo_events(spark, sf).filter("event_type = 'create'").filter(F.col("height").between(0, t.TIP))
    aged = outputs.join(materialized(times, "block-times"), "height", "left").withColumn(
        "age_days", calendar.age_days(F.col("time"), F.lit(AS_OF)))
    return aged.select("height", F.col("scriptPubKey_type").alias("script_type"), "value_sats", "age_days",
                       AGE_COHORTS.label(F.col("age_days")).alias("age_bucket"),
                       log10_positive(F.col("value_sats")).alias("log_value"))


def _aged_table(spark: SparkSession, sf: str) -> DataFrame:
    return materialized(_aged(spark, sf), "aged")


AGED = t.CREATES + f""",
times AS (
  SELECT CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS BIGINT) AS height,
         arg_max(CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT) + o_orderkey % 86400, o_orderkey) AS time
  FROM orders GROUP BY 1),
aged AS (
  SELECT *, {_ladder_sql('age_days', AGE_COHORTS, True)} AS age_bucket, log10(nullif(value_sats, 0)) AS log_value
  FROM (SELECT c.*, ({AS_OF} - time) / 86400e0 AS age_days FROM creates c LEFT JOIN times USING (height)
        WHERE height BETWEEN 0 AND 1000000))"""


@query(f"""WITH {AGED} SELECT age_bucket, count(value_sats) AS n, {r('avg(value_sats)', 5)} AS mean, {r('stddev_samp(value_sats)', 2)} AS std,
  min(value_sats) AS min, max(value_sats) AS max, {r('quantile_cont(value_sats, 0.25)', 2)} AS q25,
  {r('quantile_cont(value_sats, 0.5)', 2)} AS q50, {r('quantile_cont(value_sats, 0.75)', 2)} AS q75
  FROM aged WHERE age_bucket IS NOT NULL GROUP BY 1""")
def age_cohort_describe(spark: SparkSession, sf: str) -> DataFrame:
    aged = _aged_table(spark, sf).filter("age_bucket is not null")
    return present(stats.describe(aged, ["age_bucket"], "value_sats"), 2, mean=5)


@query(f"""WITH {AGED}, labels AS (SELECT * FROM {_labels_sql(AGE_COHORTS)} l(age_bucket, ord)),
  a AS (SELECT age_bucket, CAST(sum(value_sats) AS BIGINT) AS s, count(*) AS n FROM aged GROUP BY 1)
  SELECT l.age_bucket, CAST(ord AS BIGINT) AS ord, coalesce(s, 0) AS value_sats_total, coalesce(n, 0) AS n
  FROM labels l LEFT JOIN a ON a.age_bucket = l.age_bucket""")
def age_cohort_supply(spark: SparkSession, sf: str) -> DataFrame:
    sums = cohorts.label_sums(_aged(spark, sf), "age_bucket", "value_sats")
    return present(cohorts.kept_labels(AGE_COHORTS, sums, "age_bucket", ["value_sats_total", "n"]).orderBy("ord"))


@query(f"""WITH {AGED}, q AS (SELECT age_bucket, quantile_cont(log_value, 0.25) AS q25, quantile_cont(log_value, 0.5) AS q50,
    quantile_cont(log_value, 0.75) AS q75 FROM aged WHERE age_bucket IS NOT NULL GROUP BY 1),
  w AS (SELECT a.age_bucket, log_value, q25, q50, q75,
        log_value BETWEEN q25 - 1.5e0 * (q75 - q25) AND q75 + 1.5e0 * (q75 - q25) AS inside
        FROM aged a JOIN q ON a.age_bucket = q.age_bucket WHERE log_value IS NOT NULL)
  SELECT age_bucket, {r('max(q25)')} AS q25, {r('max(q50)')} AS q50, {r('max(q75)')} AS q75, count(*) AS n,
  {r('min(log_value)')} AS min, {r('max(log_value)')} AS max, {r('min(log_value) FILTER (inside)')} AS whisker_low,
  {r('max(log_value) FILTER (inside)')} AS whisker_high, count(*) FILTER (NOT inside) AS outliers FROM w GROUP BY 1""")
def boxplot_by_cohort(spark: SparkSession, sf: str) -> DataFrame:
    return present(stats.boxes(_aged_table(spark, sf).filter("age_bucket is not null"), ["age_bucket"], "log_value"))


CORRELATED = ("value_sats", "age_days", "height", "script_code")


@query(f"""WITH {AGED}, codes AS (SELECT script_type, dense_rank() OVER (ORDER BY script_type) - 1 AS script_code
    FROM (SELECT DISTINCT script_type FROM aged WHERE script_type IS NOT NULL)),
  x AS (SELECT value_sats, age_days, height, coalesce(script_code, -1) AS script_code FROM aged LEFT JOIN codes USING (script_type))
  """ + " UNION ALL ".join(f"SELECT '{a}' AS var_a, '{b}' AS var_b, {r(f'corr({a}, {b})')} AS corr FROM x"
                           for a in CORRELATED for b in CORRELATED))
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    coded = stats.alphabetical_codes(_aged(spark, sf), "script_type", "script_code")
    return present(stats.correlation_matrix(coded, CORRELATED))


@query(f"""WITH {AGED} SELECT script_type, {", ".join(
    f'''CAST(coalesce(sum(value_sats) FILTER (age_bucket = '{b}'), 0) AS BIGINT) AS "{b}"''' for b in AGE_COHORTS.labels)}
  FROM aged WHERE age_bucket IS NOT NULL GROUP BY 1""")
def script_age_pivot(spark: SparkSession, sf: str) -> DataFrame:
    aged = require_columns(_aged(spark, sf), ["value_sats", "script_type", "age_bucket"])
    return cohorts.pivot_sums(aged, "script_type", "age_bucket", AGE_COHORTS.labels, "value_sats")


@query(f"WITH {t.CREATES} SELECT script_type, count(*) AS n FROM creates GROUP BY 1")
def script_frequency(spark: SparkSession, sf: str) -> DataFrame:
    made = t.utxo_events(spark, sf).filter("event_type = 'create'")
    return cohorts.frequency(made.select(F.col("scriptPubKey_type").alias("script_type")), "script_type")


@query(f"""WITH {t.CREATES} SELECT value_sats, txid, vout, script_type, height FROM creates
  WHERE value_sats >= (SELECT quantile_cont(value_sats, 0.999) FROM creates)
  ORDER BY value_sats DESC, txid, vout, height, script_type LIMIT 20""")
def value_outliers(spark: SparkSession, sf: str) -> DataFrame:
    made = t.utxo_events(spark, sf).filter("event_type = 'create'").select(
        "value_sats", F.col("outpoint_txid").alias("txid"), F.col("outpoint_vout").alias("vout"),
        F.col("scriptPubKey_type").alias("script_type"), "height")
    order = [F.desc("value_sats"), "txid", "vout", "height", "script_type"]
    return stats.outliers(made, "value_sats", 0.999, order, 20)


@query(f"""WITH {t.CREATES}, e AS (SELECT min(CAST(value_sats AS DOUBLE)) AS lo, max(CAST(value_sats AS DOUBLE)) AS hi FROM creates),
  b AS (SELECT least(floor((value_sats - lo) / (hi - lo) * 100), 99) AS bin, count(*) AS n FROM creates, e GROUP BY 1)
  SELECT CAST(s.range AS BIGINT) AS bin, {r('lo + s.range * ((hi - lo) / 100)', 3)} AS bin_low,
  {r('lo + (s.range + 1) * ((hi - lo) / 100)', 3)} AS bin_high, coalesce(n, 0) AS n
  FROM range(100) s LEFT JOIN b ON b.bin = s.range, e""")
def value_histogram(spark: SparkSession, sf: str) -> DataFrame:
    made = t.utxo_events(spark, sf).filter("event_type = 'create'")
    return present(stats.histogram(made, "value_sats", 100).orderBy("bin"), 3)


@query(f"""WITH {AGED}, v AS (SELECT script_type, log_value AS x FROM aged WHERE log_value IS NOT NULL),
  s AS (SELECT script_type, count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw, min(x) AS lo, max(x) AS hi FROM v GROUP BY 1),
  f AS (SELECT v.script_type, s.n, s.bw, s.lo, s.hi, least(floor((x - lo) / ((hi - lo) / 512)), 511) AS cell, count(*) AS m
        FROM v JOIN s ON s.script_type = v.script_type GROUP BY 1, 2, 3, 4, 5, 6),
  g AS (SELECT f.*, p.range AS point, lo - 3 * bw + p.range * ((hi - lo + 6 * bw) / 63) AS x, lo + (cell + 0.5e0) * ((hi - lo) / 512) AS mid
        FROM f CROSS JOIN range(64) p)
  SELECT script_type, CAST(point AS BIGINT) AS point, {r('max(x)', 5)} AS x,
  {r('sum(m * exp(-0.5e0 * pow((x - mid) / bw, 2)) / (n * bw * sqrt(2 * pi())))', 5)} AS density FROM g GROUP BY 1, 2""")
def value_kde(spark: SparkSession, sf: str) -> DataFrame:
    return present(stats.density(_aged_table(spark, sf), "script_type", "log_value"), 5)


@query(f"""WITH {t.BALANCES}, o AS (SELECT balance_sats AS v, row_number() OVER (ORDER BY balance_sats) AS rn, count(*) OVER () AS n,
    sum(balance_sats) OVER () AS total, sum(balance_sats) OVER (ORDER BY balance_sats ROWS UNBOUNDED PRECEDING) AS held FROM balances),
  g AS (SELECT 2e0 * CAST(sum(CAST(rn AS HUGEINT) * v) AS DOUBLE) / (max(n) * CAST(max(total) AS DOUBLE)) - (max(n) + 1) / CAST(max(n) AS DOUBLE) AS gini FROM o)
  SELECT CAST(p.range AS BIGINT) AS point, p.range * n // 10 AS rows_below, {r('CAST(held AS DOUBLE) / CAST(total AS DOUBLE)')} AS share_below,
  {r('gini')} AS gini FROM range(1, 11) p JOIN o ON rn = p.range * n // 10, g""")
def lorenz_gini(spark: SparkSession, sf: str) -> DataFrame:
    return present(stats.concentration(_balance_table(spark, sf), "balance_sats").orderBy("point"))


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey FROM lineitem
  WHERE substr(md5(l_orderkey || ':' || l_linenumber), 1, 8) < '1999999a'""")
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Repeatable tenth of all outpoints: the key's hash decides, in any run and any layout."""
    lines = t.table(spark, sf, "lineitem")
    key = F.md5(F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return present(lines.filter(F.substring(key, 1, 8) < "1999999a").select("l_orderkey", "l_linenumber", "l_suppkey"))


@query(f"""WITH {t.CREATES} SELECT height // 250 AS batch_id, count(*) AS n_rows, CAST(sum(value_sats) AS BIGINT) AS total_sats,
  min(height) AS first_height, max(height) AS last_height
  FROM (SELECT height, value_sats FROM creates UNION ALL SELECT height, 0 FROM spends) GROUP BY 1""")
def control_totals(spark: SparkSession, sf: str) -> DataFrame:
    return utxo.control_totals(_narrow(spark, sf), tables.batch_id(F.col("height")))


@query(f"""WITH {t.CREATES} SELECT height, txid, vout, value_sats, substr(txid, 1, 4) AS prefix, height // 250 AS batch_id
  FROM creates WHERE height BETWEEN 300 AND 2200""")
def pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs stored in height batches, then a range read that opens only the batches it needs."""
    path = scratch_path(spark, "outputs")
    tables.write_batches(utxo.creates(_narrow(spark, sf)).select("height", "txid", "vout", "value_sats", "prefix"), path)
    return present(tables.read_heights(spark, path, 300, 2200))


PREFIX_RANGES = (("0000", "3fff"), ("4000", "7fff"), ("8000", "bfff"), ("c000", "ffff"))


@query(f"""WITH {t.CREATES}, {", ".join(f"part{i} AS (SELECT * FROM creates WHERE substr(txid, 1, 4) BETWEEN '{a}' AND '{b}')"
    for i, (a, b) in enumerate(PREFIX_RANGES))}
  {" UNION ALL ".join(f"SELECT 'creates_{i}' AS layer, count(*) AS n, CAST(sum(value_sats) AS BIGINT) AS total_sats, min(substr(txid, 1, 4)) AS first_prefix, max(substr(txid, 1, 4)) AS last_prefix, count(DISTINCT txid) AS n_txs FROM part{i} HAVING count(*) > 0"
    for i in range(len(PREFIX_RANGES)))}""")
def prefix_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs stored by key range with small row groups, one file set a range, and read back by a glob.

    The outputs are stored once, sorted by prefix, so a range opens only the files that hold it.
    """
    stored, layers = scratch_path(spark, "creates"), scratch_path(spark, "layers")
    tables.write_clustered(utxo.creates(_narrow(spark, sf)), stored, "prefix")
    for i, (low, high) in enumerate(PREFIX_RANGES):
        part = utxo.prefix_range(spark.read.parquet(stored), low, high)
        tables.write_query(part, f"{layers}/creates_{i}", block_bytes=8 * 1024 * 1024)
    tables.write_query(utxo.spends(_narrow(spark, sf)), f"{layers}/spends_0")
    found = catalog.read_matching(spark, f"{layers}/creates_*", "part-*.parquet")
    layer = F.regexp_extract(F.col("_metadata.file_path"), "/(creates_[0-9]+)/", 1)
    return found.groupBy(layer.alias("layer")).agg(
        F.count("*").alias("n"), F.sum("value_sats").alias("total_sats"), F.min("prefix").alias("first_prefix"),
        F.max("prefix").alias("last_prefix"), F.count_distinct("txid").alias("n_txs"))


@query(f"""WITH {t.CREATES}, cut AS (SELECT max(height) // 2 AS h FROM creates)
  SELECT 'first load' AS step, max(height) AS tip, count(*) AS n, CAST(sum(value_sats) AS BIGINT) AS total_sats FROM creates, cut WHERE height <= h
  UNION ALL SELECT 'after reset', CAST(NULL AS BIGINT), 0, CAST(NULL AS BIGINT)
  UNION ALL SELECT 'second load', max(height), count(*), CAST(sum(value_sats) AS BIGINT) FROM creates
  UNION ALL SELECT 'rollback', max(height), count(*), CAST(sum(value_sats) AS BIGINT) FROM creates, cut WHERE height <= h""")
def layer_reset(spark: SparkSession, sf: str) -> DataFrame:
    """Tip of a layer after its first load, after a reset, after a full load and after a rollback."""
    path = scratch_path(spark, "layer")
    outputs = materialized(utxo.creates(_narrow(spark, sf)).select("height", "txid", "vout", "value_sats"), "outputs")
    middle = outputs.agg(F.max("height")).first()[0] // 2
    steps = []

    def note(step: str) -> None:
        held = tables.read_or_empty(spark, path, outputs)
        tip = tables.tip_height(held).crossJoin(held.agg(F.count("*").alias("n"), F.sum("value_sats").alias("total_sats")))
        steps.append(materialized(tip.select(F.lit(step).alias("step"), "*"), "tip"))

    tables.write_batches(outputs.filter(F.col("height") <= middle), path)
    note("first load")
    tables.reset(spark, path)
    note("after reset")
    tables.write_batches(outputs, path)
    note("second load")
    tables.rollback(spark, path, middle)
    note("rollback")
    return functools.reduce(DataFrame.unionByName, steps)


@query(f"""WITH {t.CREATES} SELECT substr(txid, 1, 2) AS lead, count(*) AS n, min(substr(txid, 1, 4)) AS first_prefix,
  max(substr(txid, 1, 4)) AS last_prefix FROM creates GROUP BY 1""")
def clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    tables.write_clustered(utxo.creates(_narrow(spark, sf)), path, "prefix")
    return spark.read.parquet(path).groupBy(F.substring("prefix", 1, 2).alias("lead")).agg(
        F.count("*").alias("n"), F.min("prefix").alias("first_prefix"), F.max("prefix").alias("last_prefix"))


@query("""SELECT md5(CAST(l_orderkey AS VARCHAR)) AS txid, CAST(l_linenumber AS BIGINT) AS vout,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS value_sats, l_returnflag AS "scriptPubKey_type",
  CASE WHEN l_linestatus = 'F' THEN CAST(l_suppkey AS BIGINT) END AS height FROM lineitem""")
def normalize_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of two schema generations (old: value in coins, vout_index) in one layout."""
    lines = t.table(spark, sf, "lineitem").withColumn("txid", t.txid(F.col("l_orderkey")))
    units = money.cents(F.col("l_extendedprice"))
    new = lines.filter("l_linestatus = 'F'").select(
        "txid", F.col("l_linenumber").alias("vout"), units.alias("value_sats"),
        F.col("l_returnflag").alias("script_type"), F.col("l_suppkey").cast("string").alias("height"))
    old = lines.filter("l_linestatus <> 'F'").select(
        "txid", F.col("l_linenumber").alias("vout_index"),
        F.format_string("%.8f", units / 1e8).alias("value"), F.col("l_returnflag").alias("scriptPubKey_type"))
    both = utxo.normalize_outputs(new).unionByName(utxo.normalize_outputs(old))
    return present(both.select("txid", "vout", "value_sats", "scriptPubKey_type", "height"))


def _scripts(spark: SparkSession, sf: str) -> DataFrame:
    """Locking scripts of every class, and odd ones, made from the lines' keys."""
    lines = t.table(spark, sf, "lineitem")
    key = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    h20, h32, kind = F.sha1(key), F.sha2(key, 256), F.col("l_suppkey") % 7
    made = (
        F.when(kind == 0, F.concat(F.lit("76a914"), h20, F.lit("88ac")))
        .when(kind == 1, F.concat(F.lit("a914"), h20, F.lit("87")))
        .when(kind == 2, F.concat(F.lit("0014"), h20))
        .when(kind == 3, F.concat(F.lit("0020"), h32))
        .when(kind == 4, F.concat(F.lit("5120"), h32))
        .when(kind == 5, F.concat(F.lit("6a20"), h32))
    )
    return lines.select(made.alias("script_hex"))


SCRIPTS = """scripts AS (
  SELECT CASE l_suppkey % 7 WHEN 0 THEN '76a914' || sha1(k) || '88ac' WHEN 1 THEN 'a914' || sha1(k) || '87'
    WHEN 2 THEN '0014' || sha1(k) WHEN 3 THEN '0020' || sha256(k) WHEN 4 THEN '5120' || sha256(k)
    WHEN 5 THEN '6a20' || sha256(k) END AS script_hex
  FROM (SELECT l_suppkey, l_orderkey || ':' || l_linenumber AS k FROM lineitem))"""


@query(f"""WITH {SCRIPTS} SELECT script_hex, CASE WHEN script_hex LIKE '76a9%88ac' AND length(script_hex) = 50 THEN 'p2pkh'
  WHEN script_hex LIKE 'a9%87' AND length(script_hex) = 46 THEN 'p2sh' WHEN script_hex LIKE '0014%' AND length(script_hex) = 44 THEN 'p2wpkh'
  WHEN script_hex LIKE '0020%' AND length(script_hex) = 68 THEN 'p2wsh' WHEN script_hex LIKE '5120%' AND length(script_hex) = 68 THEN 'p2tr'
  END AS script_class FROM scripts""")
def script_classes(spark: SparkSession, sf: str) -> DataFrame:
    return _scripts(spark, sf).withColumn("script_class", scripts.script_class(F.col("script_hex")))


def _checksum_sql(values: str) -> str:
    """The five-bit checksum's state after a list of values."""
    terms = "0"
    for i, generator in enumerate(scripts.BECH32_GENERATOR):
        terms = f"xor({terms}, ((s >> {25 + i}) & 1) * {generator})"
    return f"list_reduce({values}, lambda s, x: xor(xor(((s & 33554431) << 5), x), {terms}), CAST(1 AS BIGINT))"


# Base 58 by repeated division of five 40-bit limbs, the last digit first; the five-bit form by a fold over its words.
ADDRESSES = SCRIPTS + f""",
kinds AS (
  SELECT DISTINCT script_hex, CASE
    WHEN script_hex LIKE '76a9%88ac' AND length(script_hex) = 50 THEN '00' || substr(script_hex, 7, 40)
    WHEN script_hex LIKE 'a9%87' AND length(script_hex) = 46 THEN '05' || substr(script_hex, 5, 40) END AS body,
    CASE WHEN (script_hex LIKE '0014%' AND length(script_hex) = 44) OR (script_hex LIKE '0020%' AND length(script_hex) = 68) THEN 0
    WHEN script_hex LIKE '5120%' AND length(script_hex) = 68 THEN 1 END AS version, substr(script_hex, 5) || '0' AS program
  FROM scripts WHERE script_hex IS NOT NULL),
raw AS (SELECT script_hex, body || substr(sha256(unhex(sha256(unhex(body)))), 1, 8) AS h FROM kinds WHERE body IS NOT NULL),
division(n, script_hex, a, b, c, d, e, digits) AS (
  SELECT 0, script_hex, {", ".join(f"CAST('0x' || substr(h, {at}, 10) AS BIGINT)" for at in range(1, 50, 10))}, '' FROM raw UNION ALL
  SELECT n + 1, script_hex, a // 58, b2 // 58, c2 // 58, d2 // 58, e2 // 58, substr('{scripts.BASE58}', CAST(e2 % 58 AS INTEGER) + 1, 1) || digits
  FROM (SELECT *, (d2 % 58) * 1099511627776 + e AS e2 FROM (SELECT *, (c2 % 58) * 1099511627776 + d AS d2 FROM (
    SELECT *, (b2 % 58) * 1099511627776 + c AS c2 FROM (SELECT *, (a % 58) * 1099511627776 + b AS b2 FROM division WHERE n < 35))))),
base58 AS (
  SELECT script_hex, repeat('1', length(regexp_extract(h, '^(00)*')) // 2) || ltrim(digits, '1') AS address
  FROM division JOIN raw USING (script_hex) WHERE n = 35),
words AS (
  SELECT script_hex, version, [CAST(version AS BIGINT)] || list_transform(range((length(program) * 4) // 5),
    lambda i: (CAST('0x' || substr(program, CAST(5 * i // 4 AS INTEGER) + 1, 2) AS BIGINT) >> (3 - (5 * i) % 4)) & 31) AS w
  FROM kinds WHERE version IS NOT NULL),
sums AS (
  SELECT *, xor({_checksum_sql("[" + ", ".join(f"CAST({v} AS BIGINT)" for v in (3, 3, 0, 2, 3)) + "] || w || [CAST(0 AS BIGINT), 0, 0, 0, 0, 0]")},
    CASE version WHEN 0 THEN {scripts.BECH32_FINAL} ELSE {scripts.BECH32M_FINAL} END) AS p FROM words),
bech32 AS (
  SELECT script_hex, 'bc1' || array_to_string(list_transform(w || [(p >> (5 * (5 - i))) & 31 FOR i IN range(6)],
    lambda v: substr('{scripts.BECH32}', CAST(v AS INTEGER) + 1, 1)), '') AS address FROM sums)"""


@query(f"""WITH RECURSIVE {ADDRESSES} SELECT s.script_hex, coalesce(b.address, w.address) AS address
  FROM scripts s LEFT JOIN base58 b USING (script_hex) LEFT JOIN bech32 w USING (script_hex)""")
def script_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """The address of every script; null for those without one."""
    return _scripts(spark, sf).withColumn("address", scripts.script_address(F.col("script_hex")))


WEEKLY = """snapshots AS (
  SELECT * FROM (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, CAST(user_id AS VARCHAR) AS address,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 1e2 AS btc FROM events GROUP BY 1, 2) WHERE btc >= 10)"""


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    weekly = t.table(spark, sf, "events").groupBy(
        F.to_date(F.date_trunc("week", "ts")).alias("week"), F.col("user_id").cast("string").alias("address"),
    ).agg((F.sum(money.cents(F.col("value"))) / 100).alias("btc"))
    return snapshots.snapshot(weekly, F.col("week"))


@query(f"WITH {WEEKLY} SELECT CAST(week AS VARCHAR) AS week, address, {r('btc', 2)} AS btc FROM snapshots")
def weekly_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Stored twice, present once."""
    path, weekly = scratch_path(spark, "snapshots"), _weekly(spark, sf)
    tables.append_weeks(weekly, path)
    tables.append_weeks(weekly, path)
    return present(spark.read.parquet(path).select("week", "address", "btc"), 2)


def _trend_sql() -> str:
    """The label ladder of ``snapshots``, strongest first, over signed counts of weekly moves."""
    strong, names = snapshots.STRONG_MOVE_COINS, snapshots.TREND_LABELS
    steps = [(sign * size, weeks, names[f"{prefix}{side}"]) for side, sign in (("up", 1), ("down", -1))
             for prefix, weeks, size in (("strong_", 3, strong), ("", 2, 0))]
    whens = [f"WHEN moves_{'up' if 'up' in side else 'down'} >= {weeks} AND drift {'>' if 'up' in side else '<'} {limit} THEN '{label}'"
             for (limit, weeks, label), side in zip(steps, ("up", "up", "down", "down"))]
    return f"CASE {' '.join(whens)} ELSE '{names['flat']}' END"


TRENDS = WEEKLY + f""",
span AS (SELECT *, row_number() OVER (PARTITION BY address ORDER BY week) AS nth FROM snapshots
  WHERE week >= DATE '2024-01-30' - {snapshots.TREND_DAYS}),
step AS (SELECT b.address, b.btc, b.btc - a.btc AS move FROM span b JOIN span a ON a.address = b.address AND a.nth + 1 = b.nth),
drifts AS (SELECT address, sum(move) AS drift, sum(CAST(move > 0 AS INTEGER)) AS moves_up, sum(CAST(move < 0 AS INTEGER)) AS moves_down,
  count(*) AS moves, avg(btc) AS level FROM step GROUP BY address),
trends AS (SELECT address, drift AS total_delta, CAST(moves_up AS BIGINT) AS up_weeks, CAST(moves_down AS BIGINT) AS down_weeks,
  moves AS weeks_present, level AS avg_btc, {_trend_sql()} AS trend FROM drifts WHERE moves >= {snapshots.MIN_DELTAS})"""


@query(f"""WITH {TRENDS} SELECT address, {r('total_delta', 2)} AS total_delta, up_weeks, down_weeks, weeks_present,
  {r('avg_btc', 5)} AS avg_btc, trend FROM trends""")
def address_trends(spark: SparkSession, sf: str) -> DataFrame:
    return present(snapshots.address_trends(_weekly(spark, sf), F.lit(dt.date(2024, 1, 30))), 2, avg_btc=5)


@query(f"WITH {TRENDS} SELECT trend, count(*) AS holders, {r('sum(total_delta)', 2)} AS total_btc FROM trends GROUP BY 1")
def snapshot_trend(spark: SparkSession, sf: str) -> DataFrame:
    trends = snapshots.address_trends(_weekly(spark, sf), F.lit(dt.date(2024, 1, 30)))
    return present(snapshots.trend_table(trends).orderBy(F.desc("total_btc")), 2)


@query(f"""WITH {WEEKLY}, c AS (SELECT address, max(btc) FILTER (week = DATE '2024-01-15') AS btc_before,
    max(btc) FILTER (week = DATE '2024-01-22') AS btc_now FROM snapshots GROUP BY 1)
  SELECT * FROM (SELECT address, {r('btc_before', 2)} AS btc_before, {r('btc_now', 2)} AS btc_now,
    CASE WHEN btc_before IS NULL THEN 'new' WHEN btc_now IS NULL THEN 'exited'
         WHEN abs(btc_now - btc_before) > 0.1e0 * btc_before AND btc_now > btc_before THEN 'up'
         WHEN abs(btc_now - btc_before) > 0.1e0 * btc_before THEN 'down' END AS change,
    {r('coalesce(btc_now, 0) - coalesce(btc_before, 0)', 2)} AS delta
    FROM c WHERE btc_before IS NOT NULL OR btc_now IS NOT NULL) WHERE change IS NOT NULL""")
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    weeks = F.lit(dt.date(2024, 1, 22)), F.lit(dt.date(2024, 1, 15))
    return present(snapshots.changes(_weekly(spark, sf), *weeks), 2)


@query(f"""WITH {t.BALANCES} SELECT {r('quantile_cont(balance_sats, 0.1)', 2)} AS p10, {r('quantile_cont(balance_sats, 0.5)', 2)} AS p50,
  {r('quantile_cont(balance_sats, 0.9)', 2)} AS p90, {r('quantile_cont(balance_sats, 0.999)', 2)} AS p999 FROM balances""")
def balance_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    wanted = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p999": 0.999}
    return present(exact_quantiles(_balance_table(spark, sf), [], "balance_sats", wanted), 2)
