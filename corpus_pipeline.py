"""A corpus pipeline over ``documents``: quality, lines, near-duplicates, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows, written
as Parquet and read again, are the next stage's docs. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from chainstrata.llm import bpe, line_dedup, mixing, quality, simhash
from chainstrata.llm.columns import table
from chainstrata.session import materialized


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the line field does not reject; null and empty texts are scored like any other."""
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.filter(F.col("score") >= quality.THRESHOLD).select("row.*")


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; ``n_chars`` is counted anew.

    Every row stays, null texts as null; rows of equal id share what they hold."""
    lines = line_dedup.dedup_lines(docs)
    kept = F.when(F.col("row.text").isNotNull(), F.col("kept_text"))
    own = {"text": kept, "n_chars": F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast("bigint")).otherwise(F.col("row.n_chars"))}
    return lines.select(*[own[c].alias(c) if c in own else F.col(f"row.`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row, the one of the smallest id; texts under one id are told apart."""
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; rows without words weigh nothing and may come at any number."""
    copies = mixing.mix(docs).filter(F.col("copies") > 0)
    return copies.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix, a null text as an empty one."""
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", good_documents), ("lines", first_lines), ("near_duplicates", one_of_each), ("mix", mixed), ("tokens", encoded)]

# Fitted classifiers, fingerprints and token merges have no SQL form; the tests
# compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
