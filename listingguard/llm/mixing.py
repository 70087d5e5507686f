"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key, -ln(u) / quality weight, with u from a digest of its id, so reruns agree. Sources
share ``share`` times all words by weight; a target stops at ``epochs`` times its source's words and the excess goes to the
others by weight. A source first gives its complete epochs; the rest of its target is filled in key order by prefix sums.
The one document at the edge of the budget gives the words that are still wanted.

No source is sorted in one task: keys map monotonically into (0, 1), a source is cut into buckets there by its number of
documents, bucket totals give each bucket its offset, and only the buckets are sorted. The table of sources (one row each)
is ordered in one task.

Defined cases: null or empty texts have size 0 and take 0; a null source is a source of its own, ordered last; a null
doc_id draws the key of the empty id; repeated rows share a key and each counts; ties go by doc_id, then size. An empty table
gives an empty mix. Extra columns are ignored by ``mix`` and kept by ``apply``,
whose ``taken`` replaces an input column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingguard.llm.common import SPACE_WORD, row_key, unused
from listingguard.sources.stage import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
BUCKET_ROWS = 2_000


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACE_WORD)).cast("long")


def quality_of(text: Column) -> Column:
    """A weight in [0.05, 1] that falls with the share of mark-up and filler signs."""
    signs = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[#$%&*|!]"))
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(5.0) * signs / F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1)))


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the id's MD5."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """A row per source: source, docs, source_size, target. Targets are min(cap, level x weight) for the one level whose sum fits.

    Sources in order of cap / weight fill up first; the level is the first at which the next one does not.
    """
    per = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (at % len(weights) + 1).cast("int"))
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    ranked = (
        per.withColumn("w", w)
        .withColumn("cap", F.col("source_size") * float(epochs))
        .withColumn("fill", F.col("cap") / F.col("w"))
        .withColumn("left", F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("w").over(after))
        .withColumn("open", F.col("fill") > F.col("level"))
    )
    level = F.max(F.when(F.col("open"), F.col("level"))).over(whole)
    return ranked.withColumn("target", F.least("cap", F.coalesce(level * F.col("w"), F.col("cap")))).select(
        "source", "docs", "source_size", "target"
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, quality: Column | None = None) -> DataFrame:
    """doc_id, did, rid, source, size, quality, source_size, target, taken: the words of each document that the mix takes."""
    text = F.col("text")
    sized = materialize(
        docs.select(
            F.col("doc_id"),
            *row_key(),
            F.col("source"),
            size_of(text).alias("size"),
            (quality_of(text) if quality is None else F.greatest(F.coalesce(quality, F.lit(0.0)), F.lit(1e-6))).alias("quality"),
        ),
        "mix_sizes",
    )
    targets = materialize(source_targets(sized, weights, share, epochs), "mix_targets")
    return taken(sized, targets)


def taken(sized: DataFrame, targets: DataFrame) -> DataFrame:
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    keyed = (
        sized.withColumnRenamed("source", "src")
        .join(targets, F.col("src").eqNullSafe(F.col("source")))
        .drop("src")
        .withColumn("whole", whole)
        .withColumn("wanted", budget - F.col("whole") * F.col("source_size"))
        .withColumn("key", -F.ln(uniform(F.col("doc_id"))) / F.col("quality"))
        .withColumn("n_buckets", F.ceil(F.col("docs") / BUCKET_ROWS))
        .withColumn("bucket", F.floor(F.col("n_buckets") * (1 - F.exp(-F.col("key")))))
    )
    sums = keyed.groupBy(F.col("source").alias("src"), F.col("bucket").alias("b")).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("src").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("wanted") - F.col("prefix")))
    return (
        keyed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("src").eqNullSafe(F.col("source")) & (F.col("b") == F.col("bucket")))
        .withColumn("prefix", F.col("before") + F.col("offset"))
        .select(
            "doc_id", "did", "rid", "source", "size", "quality", F.col("source_size"), F.col("target"),
            (F.col("whole") * F.col("size") + part).cast("long").alias("taken"),
        )
    )


def apply(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, quality: Column | None = None) -> DataFrame:
    """The documents of which the mix takes words, with ``taken``; equal rows are one row with their words together."""
    k_did, k_rid, k_taken = unused(docs, "did", "rid", "taken")
    words = (
        mix(docs, weights, share, epochs, quality)
        .groupBy(F.col("did").alias(k_did), F.col("rid").alias(k_rid)).agg(F.sum("taken").alias(k_taken))
        .where(F.col(k_taken) > 0)
    )
    did, rid = row_key()
    return (
        docs.withColumns({k_did: did, k_rid: rid})
        .join(words, [k_did, k_rid])
        .dropDuplicates([k_did, k_rid])
        .withColumn("taken", F.col(k_taken))
        .drop(k_did, k_rid, k_taken)
    )


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         greatest(0.05, 1.0 - 5.0 * len(regexp_extract_all(coalesce(text, ''), '[#$%&*|!]')) / greatest(length(coalesce(text, '')), 1)) AS quality
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         [{", ".join(f"{w}.0" for w in WEIGHTS)}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INT)] AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, {EPOCHS} * source_size AS cap,
         ({SHARE} * sum(source_size) OVER () - coalesce(sum({EPOCHS} * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per),
targets AS (
  SELECT source, source_size, least(cap, coalesce(max(level) FILTER (cap / w > level) OVER () * w, cap)) AS target FROM ranked),
keyed AS (
  SELECT s.*, t.source_size, t.target, floor(t.target + 0.5) AS budget,
         -ln((CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 13) AS BIGINT) + 0.5) / 4503599627370496.0) / quality AS key
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
summed AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(budget / source_size) ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prefix
  FROM keyed)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(whole * size + greatest(0, least(size, budget - whole * source_size - prefix)) AS BIGINT) AS taken
FROM summed
"""
