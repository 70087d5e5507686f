"""Helpers shared by the operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingguard.sources.stage import materialize

SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a table that grows with a test set, never with the corpus, is broadcast.
MAX_BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is; null counts as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column, pattern: str = SPACE_WORD) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def row_key() -> list[Column]:
    """(did, rid): tells rows apart that share an id, or have none, but differ in their text. Equal rows get equal keys."""
    return [F.coalesce(F.col("doc_id"), F.lit(-1)).alias("did"), F.xxhash64("doc_id", "text").alias("rid")]


def unused(docs: DataFrame, *names: str) -> list[str]:
    """A column name for each of ``names`` that ``docs`` does not have yet."""
    there, out = {c.lower() for c in docs.columns}, []
    for name in names:
        free = f"_llm_{name}"
        while free in there:
            free += "_"
        out.append(free)
    return out


def checked_broadcast(df: DataFrame, name: str, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` as a written table, marked for broadcast only when its counted rows are within ``limit``."""
    table = materialize(df, name)
    return F.broadcast(table) if table.count() <= limit else table
