"""The registered queries of the operators, thin digests of their results, and the SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingguard.llm import decontaminate, importance, katz, lengths, linespread, mixing, pivots, purisk, simhash, toxicity, urlfilter, warcstore, whiten
from listingguard.llm.common import crc_mod, read
from listingguard.sources.stage import work_dir


def held_out(modulus: int):
    return (crc_mod(F.col("doc_id"), modulus) == 0).alias("held_out")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(toxicity.FOLDS), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("did", "rid")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linespread.apply(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = katz.held_out_score(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_embedding_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(read(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = purisk.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(purisk.FOLDS), "score", (F.col("score") >= purisk.THRESHOLD).cast("int").alias("predicted"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/warc-{uuid.uuid4().hex}"
    warcstore.write(read(spark, sf_dir, "pages"), path)
    return warcstore.summary(warcstore.read(spark, path))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.report(read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten.whiten(read(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urlfilter.judge(read(spark, sf_dir, "pages"), urlfilter.fit(urlfilter.labelled_urls(spark)))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


OP8_SQL = f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warcstore.MIN_REVISIT_BYTES} AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warcstore.MIN_REVISIT_BYTES} AND page_id <> largest THEN largest END AS refers_to
FROM w
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": pipeline,
        "op1_toxicity": op1_toxicity,
        "op2_decontamination": op2_decontamination,
        "op3_line_dedup": op3_line_dedup,
        "op4_katz": op4_katz,
        "op5_mixing": op5_mixing,
        "op6_embedding_pivots": op6_embedding_pivots,
        "op7_quality": op7_quality,
        "op8_warc": op8_warc,
        "op9_token_counts": op9_token_counts,
        "op10_simhash": op10_simhash,
        "op11_whitening": op11_whitening,
        "op12_url_filters": op12_url_filters,
        "op13_importance": op13_importance,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": decontaminate.SQL,
        "op3_line_dedup": linespread.SQL,
        "op5_mixing": mixing.SQL,
        "op8_warc": OP8_SQL,
        "op13_importance": importance.SQL,
    }
