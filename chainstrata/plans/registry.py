"""Registration and presentation of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType, DateType, DoubleType, IntegerType, ShortType, TimestampNTZType, TimestampType,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def keep(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql:
            SQL[key] = sql
        return function
    return keep


def present(df: DataFrame, digits: int = 6, **own: int) -> DataFrame:
    """Portable output: dates and times as text, integers as bigint, doubles rounded."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(kind, (ByteType, ShortType, IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, DoubleType):
            column = F.round(column, own.get(field.name, digits))
        out.append(column.alias(field.name))
    return df.select(*out)


def r(expression: str, digits: int = 6) -> str:
    """SQL rounding that never yields a negative zero."""
    return f"round({expression}, {digits}) + 0.0"
