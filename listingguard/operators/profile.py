"""Data-quality profile: nulls, describe, cardinality, skew, histograms, box plots, gates, leakage report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingguard.config import (
    BASE_COLUMNS,
    CATEGORICAL,
    DROPPED,
    HIGH_CARDINALITY,
    LISTING_TYPES,
    NUMERIC,
    SETTINGS,
    TEMPORAL,
)
from listingguard.functions.exprs import cap, ratio, report_round, unbiased_skew
from listingguard.operators.lookup import with_scalars
from listingguard.operators.ordered import exact_quantiles


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep…, feature, value), all values double."""
    cast = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(list(keep), list(columns), "feature", "value")


def null_profile(df: DataFrame, columns: Sequence[str] = BASE_COLUMNS) -> DataFrame:
    """Null count and share per column with severity: one scan, no shuffle beyond one row."""
    one = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]
    )
    long = one.unpivot(["total"], list(columns), "column_name", "null_count")
    pct = ratio(F.col("null_count") * 100, F.col("total"))
    types = {c: t for c, t in df.dtypes}
    kind = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return long.select(
        "column_name",
        kind[F.col("column_name")].alias("dtype"),
        "null_count",
        report_round(pct, 2).alias("null_pct"),
        F.when(report_round(pct, 2) >= SETTINGS.null_critical_pct, "CRITICAL")
        .when(report_round(pct, 2) >= SETTINGS.null_warn_pct, "WARN")
        .otherwise("OK")
        .alias("severity"),
    ).orderBy(F.desc("null_pct"), "column_name")


def _moments(value: str = "value") -> list[Column]:
    return [
        report_round(F.avg(value), 4).alias("mean"),
        report_round(F.stddev_samp(value), 4).alias("std"),
        report_round(F.min(value), 4).alias("min"),
        report_round(F.max(value), 4).alias("max"),
    ]


def describe(df: DataFrame, columns: Sequence[str] = NUMERIC, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std, min, quartiles, max per column, and per ``by`` group when given."""
    long = melt(df, columns, by)
    keys = [*by, "feature"]
    quartiles = exact_quantiles(long, keys, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, few_groups=True)
    moments = long.groupBy(*keys).agg(F.count("value").alias("n_values"), *_moments())
    return moments.join(quartiles.drop("n"), keys, "left").select(
        *keys,
        "n_values",
        "mean",
        "std",
        "min",
        *[report_round(q, 4).alias(q) for q in ("p25", "p50", "p75")],
        "max",
    )


def cardinality(df: DataFrame, columns: Sequence[str] = CATEGORICAL + HIGH_CARDINALITY) -> DataFrame:
    """Exact distinct counts: distinct (column, value) pairs first, so no task holds a whole value set."""
    long = df.unpivot([], list(columns), "column_name", "value")
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    distinct = long.where(F.col("value").isNotNull()).distinct()
    counts = distinct.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"))
    return names.join(counts, "column_name", "left").select("column_name", F.coalesce("n_unique", F.lit(0)).alias("n_unique"))


def skewness_profile(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    long = melt(df, columns)
    skew = long.groupBy("feature").agg(report_round(unbiased_skew("value"), 3).alias("skewness"))
    return skew.withColumn("needs_log", F.coalesce(F.abs("skewness") > SETTINGS.skew_log_threshold, F.lit(False)))


PRICE_PROBS = {f"p{p}": p / 100 for p in (1, 5, 10, 25, 50, 75, 90, 95, 99)}


def price_profile(df: DataFrame) -> DataFrame:
    price = df.select("price").where(F.col("price").isNotNull())
    q = exact_quantiles(price, [], "price", PRICE_PROBS).drop("n")
    m = price.agg(
        F.count("price").alias("n_values"),
        report_round(F.avg("price"), 2).alias("mean"),
        report_round(F.stddev_samp("price"), 2).alias("std"),
        report_round(F.min("price"), 2).alias("min"),
        report_round(F.max("price"), 2).alias("max"),
        report_round(unbiased_skew("price"), 3).alias("skewness"),
    )
    out = with_scalars(m, q)
    return out.select(
        *m.columns,
        report_round("p50", 2).alias("median"),
        *[report_round(p, 2).alias(p) for p in PRICE_PROBS],
        (F.abs("skewness") > SETTINGS.skew_log_threshold).alias("log_recommended"),
    )


def leakage_report(df: DataFrame, columns: Sequence[str] = BASE_COLUMNS) -> DataFrame:
    """Leakage risk and action per column from its role, with distinct count and null share."""
    roles = {
        **{c: ("high: not used", "left out of the model") for c in DROPPED},
        **{c: ("MEDIUM", "use its year and month") for c in TEMPORAL},
        **{c: ("MEDIUM", "encode per training fold") for c in HIGH_CARDINALITY},
        **{c: ("LOW", "scale") for c in NUMERIC},
        **{c: ("LOW", "encode by order") for c in CATEGORICAL},
    }
    extra = [c for c in columns if c not in roles]
    rows = [(c, *roles[c]) for c in roles] + [(c, "UNKNOWN", "look at it") for c in extra]
    table = df.sparkSession.createDataFrame(rows, "column_name string, leakage_risk string, action string")
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    distinct = cardinality(as_text, columns).withColumnRenamed("n_unique", "n_distinct")
    nulls = null_profile(df, columns).select("column_name", "dtype", "null_pct")
    return (
        table.join(F.broadcast(distinct), "column_name", "left")
        .join(F.broadcast(nulls), "column_name", "left")
        .select("column_name", "dtype", "n_distinct", "null_pct", "leakage_risk", "action")
    )


def quality_gates(df: DataFrame) -> DataFrame:
    expected = len(LISTING_TYPES)
    one = df.agg(F.count(F.lit(1)).alias("rows_seen"))
    return one.select(
        "rows_seen",
        F.lit(SETTINGS.min_rows).cast("bigint").alias("rows_required"),
        F.lit(len(df.columns)).alias("columns_seen"),
        F.lit(expected).alias("columns_expected"),
        ((F.col("rows_seen") >= SETTINGS.min_rows) & F.lit(len(df.columns) == expected)).alias("passed"),
    )


def top_values(df: DataFrame, columns: Sequence[str] = CATEGORICAL + HIGH_CARDINALITY, top: int = 30) -> DataFrame:
    """The most frequent values of each column; ties by value. Each column ends in its own bounded top-k."""
    out = None
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("listings"))
        part = counts.orderBy(F.desc("listings"), "value").limit(top).select(F.lit(c).alias("column_name"), "value", "listings")
        out = part if out is None else out.unionByName(part)
    return out


def histogram(
    df: DataFrame, value: str, bins: int, by: Sequence[str] = (), bounds_by: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins with counts and densities; the last bin is closed. Empty bins are not listed.

    ``by`` splits the counts, ``bounds_by`` (a subset) says which groups have their own range.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    limits = rows.groupBy(*bounds_by).agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    # Ranges: one row per bounds group, of which callers have a fixed few.
    ranged = rows.join(F.broadcast(limits), list(bounds_by)) if bounds_by else with_scalars(rows, limits)
    width = (F.col("_max") - F.col("_min")) / bins
    binned = ranged.withColumn("_w", width).withColumn(
        "bin",
        F.coalesce(F.least(F.floor(F.try_divide(F.col("_v") - F.col("_min"), F.col("_w"))), F.lit(bins - 1)), F.lit(0)),
    )
    counts = binned.groupBy(*by, "bin", "_min", "_w").agg(F.count(F.lit(1)).alias("n"))
    totals = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"))
    joined = counts.join(F.broadcast(totals), list(by)) if by else with_scalars(counts, totals)
    return joined.select(
        *by,
        F.col("bin").cast("bigint").alias("bin"),
        report_round(F.col("_min") + F.col("bin") * F.col("_w"), 4).alias("bin_start"),
        "n",
        report_round(F.try_divide(F.col("n").cast("double"), F.col("_total") * F.col("_w")), 8).alias("density"),
    )


def clipped_column(df: DataFrame, column: str, q: float = 0.99) -> DataFrame:
    """The column clipped above at its quantile, missing values dropped."""
    present = df.where(F.col(column).isNotNull())
    cut = exact_quantiles(present, [], column, {"_cut": q}).select("_cut")
    return with_scalars(present, cut).withColumn(column, cap(column, F.col("_cut"))).drop("_cut")


def box_stats(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """Quartiles and whiskers (last datum within 1.5 IQR) of each column clipped at its p99."""
    long = melt(df, columns)
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75, "cut": 0.99}
    raw = exact_quantiles(long, ["feature"], "value", probs, few_groups=True)
    # Quartiles lie below the clip point, so clipping does not move them.
    fences = raw.select(
        "feature", "q1", "median", "q3", "cut", (F.col("q3") - F.col("q1")).alias("iqr")
    )
    joined = long.where(F.col("value").isNotNull()).join(F.broadcast(fences), "feature")  # one row per column
    joined = joined.withColumn("value", cap("value", F.col("cut")))
    low_ok = F.col("value") >= F.col("q1") - 1.5 * F.col("iqr")
    high_ok = F.col("value") <= F.col("q3") + 1.5 * F.col("iqr")
    return joined.groupBy("feature", "q1", "median", "q3").agg(
        F.min(F.when(low_ok, F.col("value"))).alias("whisker_low"),
        F.max(F.when(high_ok, F.col("value"))).alias("whisker_high"),
        F.count(F.when(~(low_ok & high_ok), 1)).alias("outliers"),
    ).select(
        "feature",
        *[report_round(c, 4).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
        "outliers",
    )


def feature_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = {c: t for c, t in df.dtypes}
    kind = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    long = melt(df, columns)
    return long.groupBy("feature").agg(
        report_round(ratio(F.count(F.when(F.col("value").isNull(), 1)) * 100, F.count(F.lit(1))), 2).alias("null_pct"),
        *_moments(),
    ).withColumn("dtype", kind[F.col("feature")])


def remaining_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long = melt(df, columns)
    bad = F.col("value").isNull() | F.isnan("value")
    return long.groupBy("feature").agg(F.count(F.when(bad, 1)).alias("missing"))
