"""A training corpus from raw documents, in five stages.

Each stage works on all rows that its predecessor kept. ``run`` writes every stage as Parquet to the shared folder and reads
it back, so that a lost executor costs one stage's tasks at most. The columns are those of ``documents`` throughout; the last stage adds
``taken``, the number of words that the mix takes from a document, repeats counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingguard.llm import decontaminate, linespread, mixing, purisk, simhash
from listingguard.llm.common import read
from listingguard.sources.stage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return purisk.keep(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go, but for their first occurrence; a document that loses all its text goes with them."""
    cut = linespread.apply(docs)
    return (
        cut.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(docs.columns)
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by fingerprints that differ in two bits at most, the one with the smallest id stays."""
    return simhash.dedup(docs, shingle=simhash.SHINGLE, most=simhash.MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words from, with ``taken``."""
    return mixing.apply(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

#: The classifier and the fingerprints cannot be expressed in SQL; the operators' tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
