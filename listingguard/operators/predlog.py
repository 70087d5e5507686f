"""Prediction log and model registry: append rows, history queries, dashboard aggregates, registry upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingguard.config import SETTINGS
from listingguard.functions.exprs import flag, parse_date, ratio, report_round, risk_tier
from listingguard.operators.lookup import with_scalars
from listingguard.operators.ordered import exact_quantiles
from listingguard.operators.profile import histogram
from listingguard.sources.versioned import SnapshotTable


def key_hash(key: str | Column) -> Column:
    """First 16 hex characters of SHA-256."""
    return F.substring(F.sha2(F.col(key) if isinstance(key, str) else key, 256), 1, 16)


def tier(score: str | Column) -> Column:
    return risk_tier(score, SETTINGS.suspicious_score, SETTINGS.review_score)


def log_rows(scored: DataFrame, listings: DataFrame, score: str = "p_a", latency_score: str = "p_b") -> DataFrame:
    """Log rows of scored listings. The id is the listing id: a re-run writes the same ids again."""
    return scored_log_rows(listings.join(scored.select("listing_id", score, latency_score), "listing_id"), score, latency_score)


def scored_log_rows(joined: DataFrame, score: str = "p_a", latency_score: str = "p_b") -> DataFrame:
    """``log_rows`` of listings that carry their scores."""
    day = F.coalesce(parse_date("prev_sold_date"), F.lit(SETTINGS.reference_date).cast("date"))
    return joined.select(
        F.col("listing_id").alias("id"),
        day.cast("timestamp_ntz").alias("created_at"),
        *["price", "bed", "bath", "acre_lot", "house_size", "city", "state", "zip_code", "status"],
        F.col(score).alias("fraud_score"),
        (F.col(score) >= SETTINGS.suspicious_score).alias("is_suspicious"),
        tier(score).alias("risk_tier"),
        F.lit(SETTINGS.model_version).alias("model_version"),
        report_round(20 + 400 * F.col(latency_score), 2).alias("latency_ms"),
        key_hash(F.concat(F.lit("key-"), F.col("brokered_by").cast("int").cast("string"))).alias("api_key_hash"),
    )


def history(
    log: DataFrame,
    city: str | None = None,
    state: str | None = None,
    risk_tier: str | None = None,
    min_score: float | None = None,
) -> DataFrame:
    """Filtered history; an absent filter does nothing."""
    if city:
        log = log.where(F.col("city").ilike(f"%{city}%"))
    if state:
        log = log.where(F.col("state") == state)
    if risk_tier:
        log = log.where(F.col("risk_tier") == risk_tier)
    if min_score is not None:
        log = log.where(F.col("fraud_score") >= min_score)
    return log


def page(log: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    """Newest first, ties by id; 1 to 500 rows a page."""
    if not 1 <= limit <= 500 or offset < 0:
        raise ValueError("limit must be 1…500 and offset not negative")
    return log.orderBy(F.desc("created_at"), "id").offset(offset).limit(limit)


def clustered(log: DataFrame) -> DataFrame:
    """The log in the order of its pages, for writing: a file covers a range of times, so that a later page reads few of them."""
    return log.repartitionByRange(F.desc("created_at"), "id").sortWithinPartitions(F.desc("created_at"), "id")


def page_after(log: DataFrame, limit: int = 50, last: tuple | None = None) -> DataFrame:
    """The page after the row with (created_at, id) = ``last``; the first page without it.

    The cut is a filter that reaches the scan. Unlike an offset it does not sort the rows of the pages before.
    """
    if not 1 <= limit <= 500:
        raise ValueError("limit must be 1…500")
    if last is not None:
        when, id_ = F.lit(last[0]).cast(log.schema["created_at"].dataType), F.lit(last[1])
        at = F.col("created_at")
        log = log.where((at <= when) & ((at < when) | (F.col("id") > id_)))
    return log.orderBy(F.desc("created_at"), "id").limit(limit)


def by_id(log: DataFrame, id_: str) -> DataFrame:
    return log.where(F.col("id") == id_).limit(1)


def display(log: DataFrame) -> DataFrame:
    """Display strings of the history page."""
    return log.select(
        "id",
        "created_at",
        "city",
        "state",
        F.coalesce(F.concat(F.lit("$"), F.format_number("price", 0)), F.lit("N/A")).alias("price"),
        F.round("fraud_score", 4).alias("fraud_score"),
        "risk_tier",
        F.coalesce(F.concat(F.format_number("latency_ms", 0), F.lit("ms")), F.lit("N/A")).alias("latency"),
    )


def totals(log: DataFrame) -> DataFrame:
    n, bad = F.count(F.lit(1)), F.count(F.when(F.col("is_suspicious"), 1))
    return log.agg(
        n.alias("total_predictions"),
        bad.alias("suspicious_count"),
        F.coalesce(report_round(ratio(bad, n), 4), F.lit(0.0)).alias("fraud_rate"),
        F.coalesce(report_round(F.avg("fraud_score"), 4), F.lit(0.0)).alias("avg_fraud_score"),
    )


def tier_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))


def top_fraud_cities(log: DataFrame, top: int = 10) -> DataFrame:
    bad = log.where(F.col("is_suspicious") & F.col("city").isNotNull())
    return bad.groupBy("city").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "city").limit(top)


def high_rate_by_state(log: DataFrame, min_rows: int = 2, top: int = 20) -> DataFrame:
    per = log.where(F.col("state").isNotNull()).groupBy("state").agg(
        F.count("fraud_score").alias("total"), F.sum(flag(F.col("risk_tier") == "HIGH")).alias("suspicious")
    )
    per = per.where(F.col("total") >= min_rows).withColumn("_rate", ratio(F.col("suspicious") * 100, F.col("total")))
    return per.orderBy(F.desc("_rate"), "state").limit(top).select(
        "state", "total", "suspicious", report_round("_rate", 4).alias("fraud_rate")
    )


def latency(log: DataFrame) -> DataFrame:
    q = exact_quantiles(log, [], "latency_ms", {"p50": 0.5, "p95": 0.95, "p100": 1.0})
    return q.select(
        report_round("p50", 2).alias("p50_ms"),
        report_round("p95", 2).alias("p95_ms"),
        report_round("p100", 2).alias("max_ms"),
        (F.col("p95") <= SETTINGS.latency_target_ms).alias("within_target"),
    )


def score_histogram(log: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(log, "fraud_score", bins)


def register(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Registry after adding one row: a Production row archives the active ones of before and is active itself."""
    production = new.agg(F.max(flag(F.col("stage") == "Production")).alias("_new_production"))
    old = with_scalars(registry, production)
    replaced = (F.col("_new_production") == 1) & (F.col("stage") == "Production") & F.col("is_active")
    old = old.withColumns(
        {
            "stage": F.when(replaced, "Archived").otherwise(F.col("stage")),
            "is_active": F.when(replaced, F.lit(False)).otherwise(F.col("is_active")),
        }
    ).drop("_new_production")
    return old.unionByName(new.withColumn("is_active", F.col("stage") == "Production"))


def register_committed(table: SnapshotTable, new: DataFrame) -> int:
    """``register`` on the stored registry; the number of the version that holds the new row."""
    empty = new.limit(0).withColumn("is_active", F.lit(False))
    return table.change(lambda now: register(empty if now is None else now, new))


def active(registry: DataFrame) -> DataFrame:
    """The active model, the latest one if there are several."""
    return registry.where("is_active").orderBy(F.desc("registered_at"), F.desc("id")).limit(1)
