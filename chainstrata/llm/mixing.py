"""Mix sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies. Within its
source, documents are ordered by size; their expected copies are prefix-summed,
one random offset per source is added, and a document is taken once per integer
boundary its step crosses. Ordering by size spreads the copies evenly over all
sizes, which keeps the taken words near the target.

Positions come from range partitions of (source, size, id): row numbers inside a
partition plus prefix-summed partition counts, so a dominant source is spread
over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.llm.columns import shuffle_width, word_count
from chainstrata.session import materialized

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Target words of each source, from a frame of (source, source_size).

    Sources by code point, null last, take the weights in turn. The total is
    ``share`` of all words; no target exceeds ``most`` times its source, and what
    it would have got beyond that goes to the others by weight. With sources
    ordered by capacity per weight the capped ones are a prefix, and the words per
    weight left for the rest rise up to the end of that prefix and fall after it:
    their maximum is the level at which the others settle. One row per source, so
    the windows here see no documents.
    """
    capacity = (F.col("source_size") * most).cast("bigint")
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weighted = sizes.withColumns({
        "_weight": F.element_at(F.lit(list(weights)), (turn % len(weights) + 1).cast("int")).cast("bigint"),
        "_capacity": capacity})
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("_capacity") / F.col("_weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    room = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("_capacity").over(before), F.lit(0))
    weight_left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    level = F.max(F.col("_level")).over(everything)
    return weighted.withColumn("_level", room / weight_left).select(
        "source", "source_size", F.least(F.col("_capacity").cast("double"), level * F.col("_weight")).alias("target"))


def offset(source: Column, seed: int = SEED) -> Column:
    """The source's random offset in [0, 1): 16 bits of a hash, so sums with it stay exact."""
    name = F.concat(F.lit(f"{seed}"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 4), 16, 10).cast("double") / 65536


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", carry: bool = True,
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Copies of every document in the mix.

    Returns ``row`` (the input row as a struct; without ``carry`` only id and
    source), ``size``, ``source_size``, ``target``, ``copies`` (0 to ``most``) and
    ``taken`` = copies x size. Sizes count words; null and empty texts have none
    and take nothing. Null sources are one source. Rows equal in everything may
    differ in copies; a rerun gives the same rows.
    """
    spark = docs.sparkSession
    kept = F.struct("*") if carry else F.struct(F.col(doc_id), F.col(source))
    sized = docs.select(
        F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.col(doc_id).alias("_id"),
        F.xxhash64(text).alias("_text_hash"), kept.alias("row"))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("_id").asc_nulls_last(), F.col("_text_hash")]
    placed = materialized(
        sized.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()).drop("_id", "_text_hash"), "mix")
    placed = placed.withColumns({"_piece": F.shiftright("_at", 33), "_source": F.coalesce("source", F.lit("")),
                                 "_no_source": F.col("source").isNull()})
    pieces = materialized(placed.groupBy("_piece", "_no_source", "_source").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"), F.sum("size").alias("_words")), "mix-pieces")
    sizes = pieces.groupBy("_no_source", "_source").agg(F.sum("_words").alias("source_size")).select(
        F.when(~F.col("_no_source"), F.col("_source")).alias("source"), "source_size", "_no_source", "_source")
    targets = source_targets(sizes.select("source", "source_size"), weights, share, most).select(
        F.col("source").isNull().alias("_no_source"), F.coalesce("source", F.lit("")).alias("_source"), "source_size", "target")
    earlier = Window.partitionBy("_no_source", "_source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
        .join(targets, ["_no_source", "_source"])
        .select("_piece", "_no_source", "_source", "_before", "source_size", "target")
    )
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank, start = (F.col("_at") + F.col("_before")).cast("double"), offset(F.col("source"), seed)
    crossed = F.floor(step * (rank + 1) + start) - F.floor(step * rank + start)
    return (
        placed.join(starts, ["_piece", "_no_source", "_source"])
        .withColumn("copies", F.least(crossed, F.lit(most)).cast("bigint"))
        .select("row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
