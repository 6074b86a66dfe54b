"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chainstrata.session import materialized


def _smallest(links: DataFrame) -> DataFrame:
    """Directed links (u, v) with the smallest node ``m`` among u and its neighbours."""
    nearest = materialized(links.groupBy("u").agg(F.min("v").alias("m")), "nearest")
    return links.join(nearest, "u").withColumn("m", F.least("u", "m"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of a table of links (a, b): root is its component's smallest node.

    Large-star and small-star steps alternate until the links are stars around the
    roots. Every step is two shuffles of pairs of numbers whose minima combine
    before they are dealt; each round is a written table, so lineage stays short
    and lost executors cost one round at most. Only a count and a checksum reach
    the driver. Self-links and repeats are ignored.
    """
    a, b = F.col("a"), F.col("b")
    links = materialized(links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = _state(links)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialized(
            _smallest(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v")).distinct(), "large-star")
        small = _smallest(large)
        links = materialized(
            small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
