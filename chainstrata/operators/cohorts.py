"""Label tables: cohort, family and era summaries with shares of the total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.functions.bins import Ladder
from chainstrata.functions.ratios import percent
from chainstrata.operators.quantiles import exact_quantiles


def whole(name: str) -> Column:
    """Grand total of an aggregated column; the table it runs on has a handful of labels."""
    return F.sum(name).over(Window.partitionBy())


def kept_labels(ladder: Ladder, table: DataFrame, label: str, zero: Sequence[str]) -> DataFrame:
    """Every label of the ladder in order, absent ones with zeros in the ``zero`` columns."""
    return (
        ladder.frame(table.sparkSession, label).join(table, label, "left")
        .fillna(0, subset=list(zero))
    )


def label_sums(df: DataFrame, label: str, value: str) -> DataFrame:
    return df.groupBy(label).agg(F.sum(value).alias(f"{value}_total"), F.count("*").alias("n"))


def share_table(df: DataFrame, label: str, value: str, flag: str | None = None,
                median_of: str | None = None) -> DataFrame:
    """Count and sum per label with percentages of all rows, also of unlabelled ones.

    ``flag`` adds a conditional count and sum with the rest and its share,
    ``median_of`` an exact median.
    """
    totals = [F.count("*").alias("n"), F.sum(value).alias("total")]
    if flag:
        marked = F.col(flag)
        totals += [
            F.count_if(marked).alias("flagged_n"),
            F.coalesce(F.sum(F.when(marked, F.col(value))), F.lit(0).cast("bigint")).alias("flagged_total"),
        ]
    table = (
        df.groupBy(label).agg(*totals)
        .withColumn("pct_n", percent(F.col("n"), whole("n")))
        .withColumn("pct_total", percent(F.col("total"), whole("total")))
    )
    if flag:
        table = (
            table.withColumn("rest_total", F.col("total") - F.col("flagged_total"))
            .withColumn("flagged_pct", F.coalesce(percent(F.col("flagged_n"), F.col("n")), F.lit(0.0)))
        )
    table = table.filter(F.col(label).isNotNull())
    if median_of:
        middle = exact_quantiles(df.filter(F.col(label).isNotNull()), [label], median_of, {f"median_{median_of}": 0.5})
        table = table.join(middle, label, "left")
    return table


def flagged_share(df: DataFrame, value: str, flag: Column, supply: float) -> DataFrame:
    """One row: totals, the flagged part, and both against a known total supply."""
    part = F.coalesce(F.sum(F.when(flag, F.col(value))), F.lit(0).cast("bigint"))
    return df.agg(
        F.count("*").alias("n"),
        F.sum(value).alias("total"),
        F.count_if(flag).alias("flagged_n"),
        part.alias("flagged_total"),
    ).withColumns({
        "flagged_pct": percent(F.col("flagged_total"), F.col("total")),
        "supply_pct": percent(F.col("total"), F.lit(supply)),
    })


def column_percentages(df: DataFrame, row: str, column: str, columns: Sequence[str]) -> DataFrame:
    """Crosstab in percent of each column, one output column per label."""
    cells = df.filter(F.col(row).isNotNull() & F.col(column).isin(*columns)).groupBy(row, column).agg(F.count("*").alias("n"))
    shares = cells.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy(column))))
    return shares.groupBy(row).pivot(column, list(columns)).agg(F.max("pct")).fillna(0.0)


def pivot_sums(df: DataFrame, row: str, column: str, columns: Sequence[str], value: str) -> DataFrame:
    """Sum per row label and column label, absent cells 0."""
    return (
        df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
        .groupBy(row).pivot(column, list(columns)).agg(F.sum(value)).fillna(0)
    )


def frequency(df: DataFrame, label: str) -> DataFrame:
    """Rows per label, most frequent first; nulls are not counted."""
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def label_share(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), whole("n")))


def predicate_share(df: DataFrame, predicate: Column) -> DataFrame:
    """How many rows meet a predicate and their percentage of all."""
    return df.agg(F.count("*").alias("n"), F.count_if(predicate).alias("kept")).withColumn(
        "kept_pct", percent(F.col("kept"), F.col("n")))
