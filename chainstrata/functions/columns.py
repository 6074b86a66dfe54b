"""Schema helpers: required columns, drifted names, fixed layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def first_present(df: DataFrame, names: Sequence[str], type_name: str) -> Column:
    """Coalesce of the alternative columns this frame really has, null if it has none."""
    found = [F.col(n).try_cast(type_name) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast(type_name)


def conform(df: DataFrame, schema: StructType | str, aliases: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Exactly the columns of ``schema`` in order: renamed, cast, padded with nulls."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    aliases = aliases or {}
    return df.select(*[
        first_present(df, [f.name, *aliases.get(f.name, ())], f.dataType.simpleString()).alias(f.name)
        for f in schema.fields
    ])
