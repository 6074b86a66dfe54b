"""Every query with an SQL twin gives the twin's rows; the others run."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from chainstrata.plans import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    return value


def test_every_query_is_checked_or_listed():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert set(QUERIES) - set(SQL) == {
        "fee_gbt_cv", "fee_residuals", "fee_importance", "walk_forward_gbt", "stream_score"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(result.columns)
    got = Counter(tuple(_cell(row[c]) for c in names) for row in result.collect())
    want = Counter(tuple(_cell(v) for v in row) for row in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()


def test_entry_runs(spark):
    assert contract.entry(spark).columns == [
        "date", "fees_btc", "fees_ma30", "fees_std30", "fees_zscore", "regime"]
