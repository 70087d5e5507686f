"""Cross-site line deduplication by distinct-site spread.

Every line of ``min_words`` words or more gets a 128-bit digest of its trimmed text. Per digest a HyperLogLog sketch of the
sites it stands on is built and merged by aggregation. Lines whose estimate is clearly above the threshold are boilerplate,
lines clearly below are not, and lines within ``BAND`` of it get an exact distinct count. Of a boilerplate line the first
occurrence (smallest doc_id, then line number) stays and all others are removed, so no text leaves the corpus altogether.

Defined cases: a null or empty text has no lines that count and stays as it is; blank and short lines always stay; a null
site adds nothing to the spread; rows with a null doc_id come after all others; repeated rows are treated alike, so each
copy of the row that holds the first occurrence keeps it. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.llm.common import unused, words
from listingguard.sources.stage import materialize

MIN_SITES = 8
MIN_WORDS = 3
#: log2 of the sketch's registers: a relative standard error of 1.6 %.
SKETCH_LG = 12
#: Relative distance from the threshold, over six standard errors, within which counts are made exact.
BAND = 0.125


def row_keys():
    return [F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).alias("did"), F.xxhash64("doc_id", "text").alias("rid")]


def lines(docs: DataFrame, min_words: int = MIN_WORDS, site: str = "source") -> DataFrame:
    """did, rid, site, line_no and digest of every line that counts."""
    return (
        docs.select(*row_keys(), F.col(site).cast("string").alias("site"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .where(F.size(words(F.col("line"))) >= min_words)
        .select("did", "rid", "site", "line_no", F.unhex(F.md5(F.trim("line"))).alias("digest"))
    )


def boilerplate(found: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """digest and place of the first occurrence of each line on ``min_sites`` sites or more."""
    spread = materialize(
        found.groupBy("digest")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_LG)).alias("sites"),
            F.min(F.struct("did", "rid", "line_no")).alias("first"),
        )
        .where(F.col("sites") >= min_sites * (1 - BAND)),
        "line_spread",
    )
    clear = spread.where(F.col("sites") > min_sites * (1 + BAND))
    near = spread.where(F.col("sites") <= min_sites * (1 + BAND))
    exact = (
        found.join(near.select("digest"), "digest", "left_semi")
        .groupBy("digest", "site").agg(F.lit(1).alias("one"))
        .groupBy("digest").agg(F.count("site").alias("exact"))
        .where(F.col("exact") >= min_sites)
    )
    return materialize(clear.select("digest", "first").unionByName(near.join(exact, "digest", "left_semi").select("digest", "first")), "boilerplate")


def removals(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, site: str = "source") -> DataFrame:
    """did, rid and the sorted numbers of the lines to remove, for each row that loses some."""
    found = materialize(lines(docs, min_words, site), "lines")
    flagged = boilerplate(found, min_sites).select("digest", "first.*").toDF("digest", "f_did", "f_rid", "f_no")
    here = (F.col("did") == F.col("f_did")) & (F.col("rid") == F.col("f_rid")) & (F.col("line_no") == F.col("f_no"))
    return (
        found.join(flagged, "digest").where(~here)
        .groupBy("did", "rid").agg(F.array_sort(F.collect_set("line_no")).alias("gone"))
    )


def apply(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, site: str = "source") -> DataFrame:
    """``docs`` with the remaining lines as ``text``, plus n_lines and n_removed, which replace input columns of these names. Other columns are kept; texts are split whole, at any length."""
    c_did, c_rid, c_gone = unused(docs, "did", "rid", "gone")
    cut = removals(docs, min_sites, min_words, site).withColumnsRenamed({"did": c_did, "rid": c_rid, "gone": c_gone})
    did, rid = row_keys()
    parts = F.split("text", "\n")
    kept = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains(c_gone, i)), "\n")
    return (
        docs.join(cut, (did == F.col(c_did)) & (rid == F.col(c_rid)), "left")
        .withColumn("n_lines", F.coalesce(F.size(parts), F.lit(0)).cast("long"))
        .withColumn("n_removed", F.coalesce(F.size(c_gone), F.lit(0)).cast("long"))
        .withColumn("text", F.when(F.col(c_gone).isNull(), F.col("text")).otherwise(kept))
        .drop(c_did, c_rid, c_gone)
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents),
counted AS (
  SELECT doc_id, source, line_no, md5(trim(line)) AS digest FROM lines
  WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {MIN_WORDS}),
spread AS (
  SELECT digest, min(struct_pack(d := doc_id, n := line_no)) AS first FROM counted GROUP BY digest HAVING count(DISTINCT source) >= {MIN_SITES}),
gone AS (
  SELECT doc_id, line_no FROM counted JOIN spread USING (digest) WHERE struct_pack(d := doc_id, n := line_no) <> first)
SELECT l.doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(g.line_no) AS BIGINT) AS n_removed,
       md5(coalesce(string_agg(CASE WHEN g.line_no IS NULL THEN l.line END, chr(10) ORDER BY l.line_no), '')) AS text_md5
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line_no = g.line_no GROUP BY l.doc_id
"""
