"""Named tables over Parquet and ad-hoc SQL on them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F


class QueryError(Exception):
    """An SQL text the engine could not analyse or run."""


def register(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Expose Parquet paths as views; nothing is copied."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def refresh(spark: SparkSession, names: Sequence[str]) -> None:
    """Forget cached file listings after tables were rewritten."""
    for name in names:
        spark.catalog.refreshTable(name)


def ask(spark: SparkSession, text: str) -> DataFrame:
    """Ad-hoc SQL over the registered views."""
    try:
        return spark.sql(text)
    except PySparkException as failure:
        raise QueryError(str(failure)) from failure


def rows(spark: SparkSession, text: str) -> Iterator[dict]:
    """Result rows as dictionaries, fetched partition by partition."""
    result = ask(spark, text)
    try:
        for row in result.toLocalIterator():
            yield row.asDict(recursive=True)
    except (PySparkException, Py4JError) as failure:
        raise QueryError(str(failure)) from failure


def preview(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    return df.select(*columns).limit(n)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
               for name, df in frames.items()]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out


def read_matching(spark: SparkSession, directory: str, glob: str) -> DataFrame:
    """All Parquet files of a folder whose name matches a glob."""
    return spark.read.option("pathGlobFilter", glob).parquet(directory)
