"""Exploration by label and place: rates, comparisons, correlations, rank test, price per square foot, samples."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingguard.config import NUMERIC, SETTINGS
from listingguard.functions.exprs import cap, flag, parse_date, ratio, report_round, seeded_hash
from listingguard.operators.lookup import with_scalars
from listingguard.operators.ordered import exact_quantiles, running_totals
from listingguard.operators.profile import melt
from listingguard.operators.validate import quantile_band


def rate_by(df: DataFrame, key: str, min_listings: int = 0, label: str = "is_fraud") -> DataFrame:
    """Listings, fraud count and rate (%) per key; missing keys are left out."""
    groups = df.where(F.col(key).isNotNull()).groupBy(key)
    counts = groups.agg(F.count(label).alias("total"), F.sum(label).alias("fraud"))
    return counts.where(F.col("total") >= min_listings).withColumn(
        "fraud_rate", ratio(F.col("fraud") * 100, F.col("total"))
    )


def _national(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.agg((F.avg(F.col(label).cast("double")) * 100).alias("_national"))


def fraud_by_state(df: DataFrame, min_listings: int = 50, top: int = 30) -> DataFrame:
    rates = rate_by(df, "state", min_listings).orderBy(F.desc("fraud_rate"), "state").limit(top)
    n = F.col("_national")
    return with_scalars(rates, _national(df)).select(
        "state",
        "total",
        "fraud",
        report_round("fraud_rate", 4).alias("fraud_rate"),
        F.when(F.col("fraud_rate") > n * 1.5, "far_above").when(F.col("fraud_rate") > n, "above").otherwise("normal").alias("level"),
    )


def fraud_count_by_state(df: DataFrame, min_listings: int = 50, top: int = 15) -> DataFrame:
    rates = rate_by(df, "state", min_listings)
    return rates.orderBy(F.desc("fraud"), "state").limit(top).select(
        "state", "total", "fraud", report_round("fraud_rate", 4).alias("fraud_rate")
    )


def fraud_by_city(df: DataFrame, min_listings: int = 200, top: int = 20) -> DataFrame:
    rates = rate_by(df, "city", min_listings).orderBy(F.desc("fraud_rate"), "city").limit(top)
    return with_scalars(rates, _national(df)).select(
        "city",
        "total",
        "fraud",
        report_round("fraud_rate", 4).alias("fraud_rate"),
        F.when(F.col("fraud_rate") > F.col("_national") * 2, "far_above").otherwise("high").alias("level"),
    )


def fraud_by_status(df: DataFrame) -> DataFrame:
    return rate_by(df, "status").withColumn("fraud_rate", report_round("fraud_rate", 4)).orderBy(F.desc("fraud_rate"), "status")


def fraud_by_sold_year(df: DataFrame, min_listings: int = 100) -> DataFrame:
    dated = df.withColumn("sold_year", F.year(parse_date("prev_sold_date")))
    return rate_by(dated, "sold_year", min_listings).withColumn("fraud_rate", report_round("fraud_rate", 4)).orderBy("sold_year")


def bed_bath_distribution(df: DataFrame, ceiling: float = 20.0) -> DataFrame:
    """Unit-bin counts of bed and bath by label, values clipped at min(p99.5, ceiling)."""
    long = melt(df, ["bed", "bath"], ["is_fraud"]).where(F.col("value").isNotNull())
    cut = exact_quantiles(long, ["feature"], "value", {"q": 0.995}, few_groups=True)
    cut = cut.select("feature", F.least("q", F.lit(ceiling)).alias("_cut"))
    binned = long.join(F.broadcast(cut), "feature").withColumn("bin", F.floor(cap("value", F.col("_cut"))))
    return binned.groupBy("feature", "is_fraud", "bin").agg(F.count(F.lit(1)).alias("n"))


def fraud_vs_normal(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """Mean of each feature for both labels, their ratio and difference in percent."""
    long = melt(df, columns, ["is_fraud"])
    f = F.avg(F.when(F.col("is_fraud") == 1, F.col("value")))
    n = F.avg(F.when(F.col("is_fraud") == 0, F.col("value")))
    return long.groupBy("feature").agg(f.alias("f"), n.alias("n")).select(
        "feature",
        report_round("n", 2).alias("normal_mean"),
        report_round("f", 2).alias("fraud_mean"),
        report_round(ratio(F.col("f"), F.col("n")), 3).alias("ratio"),
        report_round(ratio((F.col("f") - F.col("n")) * 100, F.col("n")), 1).alias("diff_pct"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] = (*NUMERIC, "is_fraud")) -> DataFrame:
    """Pairwise-complete Pearson correlations of all columns in one aggregation; both triangles listed."""
    pairs = list(combinations(columns, 2))
    cast = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    one = cast.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "r")
    name = F.split("pair", r"\|")
    upper = long.select(name[0].alias("feature_a"), name[1].alias("feature_b"), report_round("r", 6).alias("r"))
    lower = upper.select(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "r")
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], upper.schema)
    return upper.unionByName(lower).unionByName(diagonal)


def label_correlation(df: DataFrame) -> DataFrame:
    m = correlation_matrix(df)
    return m.where((F.col("feature_b") == "is_fraud") & (F.col("feature_a") != "is_fraud")).select(
        F.col("feature_a").alias("feature"), "r", F.abs("r").alias("abs_r")
    ).orderBy(F.desc("abs_r"), "feature")


def collinear_pairs(df: DataFrame, above: float = 0.8) -> DataFrame:
    m = correlation_matrix(df)
    return m.where((F.col("feature_a") < F.col("feature_b")) & (F.abs("r") > above))


# Chebyshev fit of erfc (Numerical Recipes), relative error below 1.2e-7 for every positive argument.
ERFC = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277
)


def erfc(x: Column) -> Column:
    """The complementary error function of a non-negative column, to small relative error far out in the tail too."""
    t = 1.0 / (1.0 + 0.5 * x)
    poly = F.lit(0.0)
    for c in reversed(ERFC):
        poly = poly * t + c
    return t * F.exp(poly - x * x)


def mann_whitney(df: DataFrame, columns: Sequence[str] = NUMERIC, min_side: int = 5) -> DataFrame:
    """Two-sided rank test of fraud against normal values on all rows, with the tie-corrected normal p-value.

    Values are compacted to counts per side; ranks come from running totals, so nothing is sampled or gathered.
    """
    long = melt(df, columns, ["is_fraud"]).where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(
        F.sum("is_fraud").alias("n1"), F.sum(1 - F.col("is_fraud")).alias("n0")
    )
    ranked = running_totals(counts, ["feature"], "value", ["n1", "n0"])
    tied = (F.col("n1") + F.col("n0")).cast("double")
    sums = ranked.groupBy("feature").agg(
        F.max("total_n1").cast("double").alias("m1"),
        F.max("total_n0").cast("double").alias("m0"),
        F.sum(F.col("n1") * (F.col("before_n0") + F.col("n0") / 2.0)).alias("u"),
        F.sum(tied * tied * tied - tied).alias("ties"),
    )
    medians = exact_quantiles(long, ["feature", "is_fraud"], "value", {"mid": 0.5}, few_groups=True)
    wide = medians.groupBy("feature").agg(
        F.max(F.when(F.col("is_fraud") == 1, F.col("mid"))).alias("f"),
        F.max(F.when(F.col("is_fraud") == 0, F.col("mid"))).alias("m"),
    )
    total = F.col("m1") + F.col("m0")
    # One value throughout has no variance, and one row no ties to correct.
    var = F.col("m1") * F.col("m0") / 12.0 * ((total + 1) - F.coalesce(F.try_divide(F.col("ties"), total * (total - 1)), F.lit(0.0)))
    away = F.greatest(F.abs(F.col("u") - F.col("m1") * F.col("m0") / 2.0) - 0.5, F.lit(0.0))
    z = F.coalesce(F.try_divide(away, F.sqrt(F.greatest("var", F.lit(0.0)))), F.lit(0.0))
    return (
        sums.where((F.col("m1") >= min_side) & (F.col("m0") >= min_side))
        .withColumn("var", var)
        .withColumn("z", z)
        .withColumn("p_value", F.least(erfc(F.col("z") / F.sqrt(F.lit(2.0))), F.lit(1.0)))
        .join(wide, "feature")
        .select(
            "feature",
            report_round("f", 2).alias("fraud_median"),
            report_round("m", 2).alias("normal_median"),
            report_round(F.col("f") / F.greatest("m", F.lit(1e-9)), 3).alias("ratio"),
            F.col("u").alias("u_statistic"),
            "p_value",
            (F.col("p_value") < 0.05).alias("significant"),
        )
    )


def with_ppsf(df: DataFrame) -> DataFrame:
    return df.withColumn("ppsf", F.when(F.col("house_size") > 0, ratio(F.col("price"), F.col("house_size"))))


def ppsf_band(df: DataFrame) -> DataFrame:
    return quantile_band(with_ppsf(df), "ppsf")


def ppsf_top_cities(df: DataFrame, min_listings: int = 100, top: int = 20) -> DataFrame:
    banded = ppsf_band(df).where(F.col("city").isNotNull())
    mid = exact_quantiles(banded, ["city"], "ppsf", {"median": 0.5})
    return mid.where(F.col("n") >= min_listings).orderBy(F.desc("median"), "city").limit(top).select(
        "city", report_round("median", 4).alias("median_ppsf"), F.col("n").alias("listings")
    )


def scatter_sample(df: DataFrame, n: int = 8000, seed: int = SETTINGS.seed) -> DataFrame:
    """A repeatable sample of exactly ``n`` rows (all rows when fewer) with log1p coordinates."""
    picked = df.where(F.col("price").isNotNull() & F.col("house_size").isNotNull())
    picked = picked.withColumn("_h", seeded_hash("listing_id", seed)).orderBy("_h").limit(n)
    return picked.select(
        "listing_id",
        "is_fraud",
        report_round(F.log1p(F.greatest("price", F.lit(0.0))), 6).alias("log_price"),
        report_round(F.log1p(F.greatest("house_size", F.lit(0.0))), 6).alias("log_size"),
    )


def eda_summary(df: DataFrame) -> DataFrame:
    """The key numbers of a labelled table as (metric, value) rows."""
    from listingguard.operators.profile import null_profile, price_profile, skewness_profile

    totals = df.agg(
        F.count(F.lit(1)).cast("double").alias("total_rows"),
        F.sum("is_fraud").cast("double").alias("fraud_count"),
        report_round(F.avg(F.col("is_fraud").cast("double")) * 100, 2).alias("fraud_rate_pct"),
    ).unpivot([], ["total_rows", "fraud_count", "fraud_rate_pct"], "metric", "value")
    missing = null_profile(df).select(
        F.concat(F.lit("missing_pct_"), "column_name").alias("metric"), F.col("null_pct").alias("value")
    )
    stats = ["mean", "median", "std", "p1", "p5", "p95", "p99"]
    price = price_profile(df).unpivot([], stats, "metric", "value").select(
        F.concat(F.lit("price_"), "metric").alias("metric"), report_round("value", 0).alias("value")
    )
    skew = skewness_profile(df).select(
        F.concat(F.lit("skewness_"), "feature").alias("metric"), F.col("skewness").alias("value")
    )
    out = totals.unionByName(missing).unionByName(price).unionByName(skew)
    for key, least in (("state", 50), ("city", 200)):
        top = rate_by(df, key, least).orderBy(F.desc("fraud_rate"), key).limit(5)
        out = out.unionByName(
            top.select(
                F.concat(F.lit(f"top_{key}_"), key).alias("metric"), report_round("fraud_rate", 2).alias("value")
            )
        )
    test = mann_whitney(df).select(
        F.concat(F.lit("significant_"), "feature").alias("metric"), flag(F.col("significant")).cast("double").alias("value")
    )
    return out.unionByName(test)
