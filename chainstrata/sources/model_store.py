"""Fitted models and the results of fits, stored so that one fit serves many readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from chainstrata.session import scratch_path, shared_dir
from chainstrata.sources.tables import _hadoop, exists, reset

# Doubles are compared to this many digits: sums differ in the last ones from run to run.
DIGITS = 9


def fingerprint(df: DataFrame) -> str:
    """Digest of the rows of a frame, whatever their order; one aggregation.

    Repeated rows count, as digests are summed.
    """
    cells = [F.round(F.col(f"`{f.name}`"), DIGITS) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
             for f in df.schema.fields]
    # a hash skips nulls, so their places are hashed as well
    digest = F.xxhash64(*cells, *[c.isNull() for c in cells]).cast("decimal(38,0)")
    total = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(digest), F.lit(0)).alias("digest")).first()
    return f"{total.n}-{total.digest}".replace("--", "-m")


def stored_once(spark: SparkSession, name: str, key: str, build: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """The tables ``build`` gives, computed on the first call with a key and read afterwards.

    They are written beside the final folder and renamed, so no reader sees half of
    them; of two builds at once the first stays. The key must name the input and
    every parameter. The folder lives below ``spark.checkpoint.dir``.
    """
    final = f"{shared_dir(spark)}/{name}-{key}"
    if not exists(spark, final):
        staged = scratch_path(spark, f"{name}-staged")
        for table, frame in build().items():
            frame.write.parquet(f"{staged}/{table}")
        fs, target = _hadoop(spark, final)
        if fs.exists(target) or not fs.rename(_hadoop(spark, staged)[1], target):
            reset(spark, staged)
    fs, folder = _hadoop(spark, final)
    # a rename into a folder that came up meanwhile puts the copy inside it
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return {n: spark.read.parquet(f"{final}/{n}") for n in names if not n.startswith(f"{name}-staged")}


def save_model(model, folder: str, version: str) -> None:
    """Store a fitted model under a version; a version written again is replaced.

    Versions are compared as text, so use a sortable form such as a date.
    """
    model.write().overwrite().save(f"{folder}/version={version}")


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Completely written versions, oldest first; a save that was cut off has none of its last files."""
    fs, where = _hadoop(spark, folder)
    if not fs.exists(where):
        return []
    found = [s.getPath().getName().removeprefix("version=") for s in fs.listStatus(where) if s.getPath().getName().startswith("version=")]
    whole = [v for v in found if all(exists(spark, f"{folder}/version={v}/{part}/_SUCCESS") for part in ("metadata", "data", "treesMetadata"))]
    return sorted(whole)


def newest_model(spark: SparkSession, folder: str, kind):
    """The newest stored model of an ``pyspark.ml`` model class."""
    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"no model in {folder}")
    return kind.load(f"{folder}/version={found[-1]}")
