"""Column expressions and helpers the operators of this package share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# ASCII white space, the only kind the contracts of this package know.
BLANK = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
TEXT_BATCH = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, whose texts now go to Python in batches of about 4 MB (or one text) at most.

    The default is 64 MB, of which writer and reader hold several copies per task.
    Spark has only a session setting for it; a smaller one given by the user stays.
    """
    conf = docs.sparkSession.conf
    given = conf.get(ARROW_BYTES).removesuffix("b")
    if not given.lstrip("-").isdigit() or not 0 < int(given) <= TEXT_BATCH:
        conf.set(ARROW_BYTES, str(TEXT_BATCH))
    return docs


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other letter alone.

    ``lower`` is much faster than ``translate`` and does the same on texts whose
    other letters are all lower case already.
    """
    alike = (F.octet_length(text) == F.char_length(text)) | text.rlike(r"^[\x00-\x7F\p{Ll}]*$")
    return F.when(alike, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """Rows no classifier may learn from: one in five by id, and rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Null-free key of a row: equal for rows of equal id and text only.

    Ids should be unique; where they are not, the text's hash tells rows apart,
    and rows equal in both get equal results.
    """
    return [doc_id.isNull().alias("_no_id"), F.coalesce(doc_id, F.lit(0)).cast("bigint").alias("_id"),
            F.xxhash64(text).alias("_text_hash")]


ROW_KEY = ["_no_id", "_id", "_text_hash"]
