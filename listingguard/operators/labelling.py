"""Rule labelling: fitted price statistics, seven rules, score and label, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingguard.config import RULES, LabelRules
from listingguard.functions.exprs import cap, flag, ratio, report_round, zero_to_null
from listingguard.operators.lookup import fits_broadcast, left_lookup, may_hold
from listingguard.operators.ordered import exact_quantiles, group_quantiles
from listingguard.sources.stage import in_parallel, materialize


@dataclass(frozen=True)
class LabelStats:
    """Statistics of the training listings: three scalars and two tables."""

    price_clip: float
    size_clip: float
    national_median: float
    city: DataFrame  # city, city_median, city_std, city_ppsf_low
    state: DataFrame  # state, state_median
    size_median: float | None = None  # of the fitted rows; not saved, a new batch brings its own

    def scalars(self) -> DataFrame:
        row = (self.price_clip, self.size_clip, self.national_median)
        return self.city.sparkSession.createDataFrame(
            [row], "price_clip double, size_clip double, national_median double"
        )

    def save(self, path: str) -> None:
        self.scalars().write.mode("overwrite").parquet(f"{path}/scalars")
        self.city.write.mode("overwrite").parquet(f"{path}/city")
        self.state.write.mode("overwrite").parquet(f"{path}/state")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LabelStats:
        s = spark.read.parquet(f"{path}/scalars").first()
        return LabelStats(
            s["price_clip"],
            s["size_clip"],
            s["national_median"],
            spark.read.parquet(f"{path}/city"),
            spark.read.parquet(f"{path}/state"),
        )


def clip_points(df: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """One row: p99 of non-zero price and size, the national median of the clipped price, the raw size median."""
    long = df.select(
        zero_to_null("price").alias("price"),
        zero_to_null("house_size").alias("house_size"),
        F.col("house_size").alias("raw_size"),
    ).unpivot([], ["price", "house_size", "raw_size"], "feature", "value")
    q = exact_quantiles(long, ["feature"], "value", {"p50": 0.5, "p_clip": rules.clip_quantile}, few_groups=True)

    def pick(feature: str, name: str):
        return F.max(F.when(F.col("feature") == feature, F.col(name)))

    # The median of clipped values is the clipped median: the clip point lies above it.
    return q.agg(
        pick("price", "p_clip").alias("price_clip"),
        pick("house_size", "p_clip").alias("size_clip"),
        F.least(pick("price", "p50"), pick("price", "p_clip")).alias("national_median"),
        pick("raw_size", "p50").alias("size_median"),
    )


def _clipped(df: DataFrame, price_clip: float, size_clip: float) -> DataFrame:
    price = zero_to_null(cap("price", price_clip))
    size = cap("house_size", size_clip)
    return df.select("city", "state", price.alias("price"), F.when(size > 0, ratio(price, size)).alias("ppsf"))


def city_stats(df: DataFrame, price_clip: float, size_clip: float, rules: LabelRules = LabelRules()) -> DataFrame:
    """Median, sample std and low price-per-sqft quantile of cities with enough priced listings."""
    stats = group_quantiles(
        _clipped(df, price_clip, size_clip),
        ["city"],
        {"city_median": ("price", 0.5), "city_ppsf_low": ("ppsf", rules.price_per_sqft_quantile)},
        [F.count("price").alias("city_listings"), F.stddev_samp("price").alias("city_std")],
    )
    enough = stats.where(F.col("city_listings") >= rules.min_city_listings)
    return enough.select("city", "city_median", "city_std", "city_ppsf_low")


def state_stats(df: DataFrame, price_clip: float, size_clip: float, rules: LabelRules = LabelRules()) -> DataFrame:
    q = exact_quantiles(_clipped(df, price_clip, size_clip), ["state"], "price", {"state_median": 0.5})
    return q.where(F.col("n") >= rules.min_state_listings).select("state", "state_median")


def fit_labels(df: DataFrame, rules: LabelRules = LabelRules()) -> LabelStats:
    """Fit on the training listings only. The two tables are written as stages; three scalars reach the driver."""
    c = clip_points(df, rules).first()
    city, state = in_parallel(
        lambda: materialize(city_stats(df, c["price_clip"], c["size_clip"], rules), "label_city"),
        lambda: materialize(state_stats(df, c["price_clip"], c["size_clip"], rules), "label_state"),
    )
    return LabelStats(c["price_clip"], c["size_clip"], c["national_median"], city, state, c["size_median"])


#: The rules that read the statistics of a place.
CITY_RULES = ("rule_price_low", "rule_price_high", "rule_price_per_sqft")
STATE_RULES = ("rule_state_anomaly",)


def enrich(df: DataFrame, stats: LabelStats, batch_median_size: float | None, flags: Sequence[str] = RULES) -> DataFrame:
    """Listings with their city and state statistics, national values where the place is unknown; of a place that no rule of ``flags`` reads,
    the national values alone."""
    national = F.lit(stats.national_median).cast("double")
    # Without a priced training listing there is no national value and no price rule fires.
    size = max(batch_median_size if batch_median_size is not None else 1.0, 1.0)
    fallback_ppsf = None if stats.national_median is None else stats.national_median / size
    joined = df
    for table, place, readers in ((stats.city, "city", CITY_RULES), (stats.state, "state", STATE_RULES)):
        if set(flags) & set(readers):
            joined = left_lookup(joined, table, [place])
        else:
            joined = joined.withColumns({c: F.lit(None).cast("double") for c in table.columns if c != place})
    return (
        joined.withColumn("city_median", F.coalesce("city_median", national))
        .withColumn("city_std", F.coalesce("city_std", F.col("city_median") * 0.3))
        .withColumn("state_median", F.coalesce("state_median", national))
        .withColumn("city_ppsf_low", F.coalesce("city_ppsf_low", F.lit(fallback_ppsf).cast("double")))
    )


def batch_median_size(df: DataFrame) -> float | None:
    row = exact_quantiles(df, [], "house_size", {"mid": 0.5}).first()
    return row["mid"] if row else None


DUPLICATE_KEY = ("bed", "bath", "house_size", "zip_code")


def _keyed(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Listings with the size to 10, and the names of the duplicate key among their columns."""
    key = [c for c in DUPLICATE_KEY if c in df.columns]
    if "house_size" in key:
        df = df.withColumn("_size10", F.bround(F.col("house_size") / 10) * 10)
        key[key.index("house_size")] = "_size10"
    return df, key


def duplicate_keys(df: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """Keys (bed, bath, size to 10, zip; or three of them) carrying more than one price, in zips with enough listings.

    Only key-level aggregates are shuffled, after a map-side combine; no group of listings is ever gathered.
    """
    return repeated_keys(key_totals(df), zip_totals(df) if "zip_code" in df.columns else None, rules)


def key_totals(df: DataFrame) -> DataFrame:
    """Count, least and largest price per duplicate key. Totals of parts merge into those of the whole."""
    keyed, key = _keyed(df)
    per_key = keyed.dropna(subset=key).groupBy(*key)
    return per_key.agg(F.count(F.lit(1)).alias("_n"), F.min("price").alias("_lo"), F.max("price").alias("_hi"))


def zip_totals(df: DataFrame) -> DataFrame:
    """Listings per zip."""
    return df.where(F.col("zip_code").isNotNull()).groupBy("zip_code").agg(F.count(F.lit(1)).alias("_zip_n"))


def repeated_keys(per_key: DataFrame, per_zip: DataFrame | None, rules: LabelRules = LabelRules()) -> DataFrame:
    """The keys of ``key_totals`` that carry more than one price, in zips with enough listings."""
    key = [c for c in per_key.columns if c not in ("_n", "_lo", "_hi")]
    repeated = per_key.where(F.col("_lo") < F.col("_hi"))
    if per_zip is not None:
        busy = per_zip.where(F.col("_zip_n") >= rules.duplicate_min_zip_listings).select("zip_code")
        repeated = repeated.join(busy, "zip_code", "left_semi")
    return repeated.select(*key, "_n", F.lit(1).alias("rule_duplicate"))


def flag_duplicates(df: DataFrame, rules: LabelRules = LabelRules(), keys: DataFrame | None = None) -> DataFrame:
    """Rule 6. With fewer than three key columns present the rule never fires.

    Beside a large table of keys, only the rows that may have one of them go through its join.
    """
    keyed, key = _keyed(df)
    if len(key) < 3:
        return df.withColumn("rule_duplicate", F.lit(0))
    keys = keys if keys is not None else materialize(duplicate_keys(df, rules), "label_duplicates")
    if fits_broadcast(keys):
        joined = left_lookup(keyed, keys, key, freq="_n")
    else:
        may = may_hold(keys, key)
        others = keyed.where(~may).withColumn("rule_duplicate", F.lit(0))
        joined = left_lookup(keyed.where(may), keys, key, freq="_n").unionByName(others)
    return joined.withColumn("rule_duplicate", F.coalesce("rule_duplicate", F.lit(0))).drop("_size10")


def price_rules(df: DataFrame, stats: LabelStats, rules: LabelRules = LabelRules()) -> DataFrame:
    """Rules 1-5 and 7 on enriched listings: pure column expressions."""
    price = cap("price", stats.price_clip)
    size = cap("house_size", stats.size_clip)
    raw_price, raw_size = F.col("price"), F.col("house_size")
    return df.select(
        "*",
        flag(price < rules.price_low_multiplier * F.col("city_median")).alias("rule_price_low"),
        flag(price > rules.price_high_multiplier * F.col("city_median")).alias("rule_price_high"),
        flag(F.when(size > 0, ratio(price, size)) < F.col("city_ppsf_low")).alias("rule_price_per_sqft"),
        flag(
            (F.col("bed") > rules.impossible_bed)
            | (F.col("bath") > rules.impossible_bath)
            | (F.col("acre_lot") > rules.impossible_acre)
        ).alias("rule_impossible_dims"),
        flag((raw_size > rules.disconnect_sqft) & (raw_price < rules.disconnect_price)).alias("rule_size_disconnect"),
        flag(
            (price < rules.state_low_multiplier * F.col("state_median"))
            | (price > rules.state_high_multiplier * F.col("state_median"))
        ).alias("rule_state_anomaly"),
    )


def apply_labels(
    df: DataFrame,
    stats: LabelStats,
    rules: LabelRules = LabelRules(),
    duplicates: DataFrame | None = None,
    size_median: float | None = None,
    flags: Sequence[str] = RULES,
) -> DataFrame:
    """All rule flags, ``fraud_score`` and ``is_fraud`` on top of the input columns.

    With fewer ``flags`` these alone; a lookup that none of them reads moves no rows.
    """
    size_median = size_median if size_median is not None else batch_median_size(df)
    flagged = flag_duplicates(df, rules, duplicates) if "rule_duplicate" in flags else df
    ruled = price_rules(enrich(flagged, stats, size_median, flags), stats, rules)
    if set(flags) < set(RULES):
        return ruled.select(*df.columns, *flags)
    return with_totals(ruled, df.columns, rules)


def with_totals(ruled: DataFrame, columns: Sequence[str], rules: LabelRules = LabelRules()) -> DataFrame:
    """``columns``, the seven flags, and score and label from them."""
    total = sum((F.col(r) for r in RULES[1:]), F.col(RULES[0]))
    scored = ruled.withColumn("fraud_score", total)
    return scored.withColumn("is_fraud", flag(F.col("fraud_score") >= rules.min_fraud_score)).select(
        *columns, *RULES, "fraud_score", "is_fraud"
    )


def label_table(df: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """Fit and apply on the same listings."""
    duplicates, stats = in_parallel(
        lambda: materialize(duplicate_keys(df, rules), "label_duplicates"), lambda: fit_labels(df, rules)
    )
    return apply_labels(df, stats, rules, duplicates, stats.size_median)


def rate_check(labeled: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    rate = F.avg(F.col("is_fraud").cast("double"))
    return labeled.agg(rate.alias("rate")).select(
        report_round("rate", 6).alias("fraud_rate"),
        F.when(F.col("rate") < rules.target_rate_min, "BELOW")
        .when(F.col("rate") > rules.target_rate_max, "ABOVE")
        .otherwise("OK")
        .alias("verdict"),
    )


def rule_contribution(labeled: DataFrame) -> DataFrame:
    """Count and share of each rule, most frequent first."""
    one = labeled.agg(F.count(F.lit(1)).alias("total"), *[F.sum(r).alias(r) for r in RULES])
    long = one.unpivot(["total"], list(RULES), "rule", "fired")
    return long.select(
        F.regexp_replace("rule", "^rule_", "").alias("rule"),
        "fired",
        report_round(ratio(F.col("fired") * 100, F.col("total")), 3).alias("pct"),
    ).orderBy(F.desc("fired"), "rule")


def label_totals(labeled: DataFrame) -> DataFrame:
    return labeled.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum("is_fraud").alias("fraud_count"),
        report_round(F.avg(F.col("is_fraud").cast("double")), 6).alias("fraud_rate"),
    )


def score_distribution(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("fraud_score").agg(F.count(F.lit(1)).alias("listings")).orderBy("fraud_score")


def rule_cooccurrence(labeled: DataFrame) -> DataFrame:
    """How often each pair of rules fires together: one pass over the table, 49 sums."""
    pairs = [(a, b) for a in RULES for b in RULES]
    one = labeled.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "together")
    name = F.split("pair", r"\|")
    return long.select(name[0].alias("rule_a"), name[1].alias("rule_b"), "together")
