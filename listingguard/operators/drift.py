"""Price drift per place between a baseline period and a current one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingguard.config import SETTINGS
from listingguard.functions.exprs import ratio, report_round
from listingguard.operators.lookup import fits_broadcast
from listingguard.operators.ordered import group_quantiles, running_totals, value_counts
from listingguard.sources.stage import materialize


def price_stats(df: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Median, sample deviation and count of the price per group; groups without a price have count 0."""
    moments = [F.stddev_samp("price").alias("std"), F.count("price").alias("count")]
    return group_quantiles(df, by, {"median": ("price", 0.5)}, moments).select(*by, "median", "std", "count")


def training_stats(df: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Baseline to keep with a model: as :func:`price_stats`, an undefined deviation stored as 0."""
    stats = price_stats(df, by).where(F.col("count") > 0)
    return stats.withColumn("std", F.coalesce("std", F.lit(0.0)))


def detect(
    current: DataFrame,
    baseline: DataFrame,
    key: str = "city",
    threshold: float = SETTINGS.drift_threshold,
    min_count: int = SETTINGS.drift_min_count,
) -> DataFrame:
    """Groups of ``current`` statistics whose median moved more than ``threshold``; places new since then drop out."""
    base = baseline.select(key, F.col("median").alias("_base"))
    base = F.broadcast(base) if fits_broadcast(base) else base
    moved = current.join(base, key).where((F.col("count") >= min_count) & (F.col("_base") != 0))
    change = ratio(F.abs(F.col("median") - F.col("_base")), F.col("_base"))
    return (
        moved.withColumn("_change", change)
        .where(F.col("_change") > threshold)
        .select(
            *[c for c in current.columns if c not in ("median", "std", "count")],
            report_round("_base", 2).alias("baseline_median"),
            report_round("median", 2).alias("current_median"),
            report_round(F.col("_change") * 100, 1).alias("pct_change"),
            F.when(F.col("median") > F.col("_base"), "UP").otherwise("DOWN").alias("direction"),
            F.col("count").alias("current_count"),
        )
    )


def report(drifted: DataFrame, key: str = "city", retrain_above: int = SETTINGS.drift_retrain_above) -> DataFrame:
    """One summary row; the largest drift is the first by rounded change, then by name."""
    top = F.min(F.struct((-F.col("pct_change")).alias("c"), F.col(key).alias("k")))
    return drifted.agg(
        F.count(F.lit(1)).alias("drifted"),
        (F.count(F.lit(1)) > retrain_above).alias("retrain_recommended"),
        top["k"].alias("max_drift_place"),
        F.coalesce(F.max("pct_change"), F.lit(0.0)).alias("max_drift_pct"),
        F.count(F.when(F.col("direction") == "UP", 1)).alias("places_up"),
        F.count(F.when(F.col("direction") == "DOWN", 1)).alias("places_down"),
    )


def save_baseline(stats: DataFrame, path: str) -> None:
    """Keep the statistics of the training period, with the model or beside it."""
    stats.write.mode("errorifexists").parquet(path)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def price_counts(dated: DataFrame, place: str) -> DataFrame:
    """(month, place, price, n): the state of a month. Counts of several deliveries of a month add up, and all statistics follow from them."""
    return value_counts(dated.select("month", place, F.col("price").cast("double").alias("price")), ["month", place], "price")


def store_counts(counts: DataFrame, path: str, delivery: str) -> None:
    """Keep the counts of one delivery; the same delivery again replaces its own."""
    out = counts.withColumn("delivery", F.lit(delivery))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "delivery").parquet(path)


def stats_of_counts(counts: DataFrame, place: str) -> DataFrame:
    """(month, place, median, std, count) of stored counts, exact; groups of any size are split by value."""
    summed = counts.where(F.col("month").isNotNull() & F.col(place).isNotNull()).groupBy("month", place, "price").agg(F.sum("n").alias("n"))
    placed = running_totals(materialize(summed, "drift_counts"), ["month", place], "price", ["n"])
    middle = (F.col("total_n") - 1) * 0.5
    low, high = F.floor(middle), F.ceil(middle)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("before_n") <= rank) & (rank < F.col("before_n") + F.col("n")), F.col("price")))

    mixed = F.max(high - middle) * at(low) + F.max(middle - low) * at(high)
    mean = F.sum(F.col("price") * F.col("n")) / F.max("total_n")
    first = placed.groupBy("month", place).agg(
        F.when(at(low) == at(high), at(low)).otherwise(mixed).alias("median"), F.max("total_n").alias("count"), mean.alias("_mean")
    )
    spread = summed.join(first.select("month", place, "_mean"), ["month", place]).groupBy("month", place)
    squares = spread.agg(F.sum(F.col("n") * (F.col("price") - F.col("_mean")) ** 2).alias("_squares"))
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_squares") / (F.col("count") - 1)))
    return first.join(squares, ["month", place]).select("month", place, "median", std.alias("std"), "count")


def monthly(
    dated: DataFrame, baseline: DataFrame, key: str, retrain_above: int = SETTINGS.drift_retrain_above
) -> DataFrame:
    """The monthly job over every later month of a table at once: drifted places and the retrain flag per month."""
    months = dated.where(F.col("month").isNotNull()).select("month").distinct()
    return monthly_report(price_stats(dated, ["month", key]), months, baseline, key, retrain_above)


def monthly_report(
    stats: DataFrame, months: DataFrame, baseline: DataFrame, key: str, retrain_above: int = SETTINGS.drift_retrain_above
) -> DataFrame:
    """One row for each of ``months`` from the statistics per month and place."""
    found = detect(stats, baseline, key)
    counts = found.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("direction") == "UP", 1)).alias("up"),
        F.count(F.when(F.col("direction") == "DOWN", 1)).alias("down"),
        F.max("pct_change").alias("worst"),
    )
    zero = F.lit(0).cast("bigint")
    return months.join(counts, "month", "left").select(
        "month",
        F.coalesce("n", zero).alias("drifted"),
        F.coalesce("up", zero).alias("places_up"),
        F.coalesce("down", zero).alias("places_down"),
        F.coalesce("worst", F.lit(0.0)).alias("max_drift_pct"),
        (F.coalesce("n", zero) > retrain_above).alias("retrain_recommended"),
    )
