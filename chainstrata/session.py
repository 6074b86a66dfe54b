"""Session defaults and the shared folder that durable intermediate tables use."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Shuffle width is left to the cluster's own
# configuration; AQE coalesces small partitions and splits skewed ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "chainstrata", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a folder of its own; on
    a cluster a missing setting is an error, because a driver-local folder would
    be invisible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="chainstrata-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


# Options of a Parquet writer for wide tables of hashes and heights: without a dictionary, which hashes overflow, delta encodings
# keep their characters apart from their lengths. A quarter smaller than the usual files with zstd.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}


def materialized(df: DataFrame, name: str, folder: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder, or to one of the caller's, and read it back.

    For frames several branches reuse: the copy outlives lost executors, unlike
    a cache, and later branches prune columns and push filters into it.
    """
    path = f"{folder}/{name}" if folder else scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(calls: Iterable[Callable[[], None]]) -> None:
    """Run independent jobs from threads of their own, so that small ones share the cluster; errors are raised."""
    calls = list(calls)
    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        for running in [pool.submit(call) for call in calls]:
            running.result()
