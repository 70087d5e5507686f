"""Feature engineering and preprocessing, fitted on training rows and applied to others.

Every fitted statistic may be kept ``by`` extra columns (the cross-validation fold), so that all folds are fitted in
one job instead of one job per fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingguard.config import CATEGORICAL, FOLD_DEPENDENT, NUMERIC, SETTINGS, STATELESS, LabelRules
from listingguard.functions.exprs import flag, parse_date, ratio
from listingguard.operators.lookup import left_lookup
from listingguard.operators.ordered import column_medians, exact_quantiles, group_quantiles, largest_group, running_totals
from listingguard.operators.profile import melt
from listingguard.sources.stage import in_parallel, materialize

Keys = Sequence[str]

#: Distinct values of one key up to which its medians come from Spark's exact ``percentile``.
SMALL_KEY = 10_000


def numeric_features(include_city_rate: bool = True) -> list[str]:
    """Ordered numeric model inputs."""
    fold = [c for c in FOLD_DEPENDENT if include_city_rate or c != "city_fraud_rate"]
    return [*NUMERIC, *STATELESS, *fold]


def feature_names(include_city_rate: bool = True) -> list[str]:
    """Ordered model inputs: the numeric block, then the categorical block."""
    return [*numeric_features(include_city_rate), *CATEGORICAL]


def join_scalars(df: DataFrame, table: DataFrame, by: Keys) -> DataFrame:
    """Attach fitted scalars: joined by ``by`` (one row per fold), or as literals when there is a single row."""
    if by:
        return df.join(F.broadcast(table), list(by))
    row = table.first()
    values = row.asDict() if row else {}
    kinds = dict(table.dtypes)
    return df.select("*", *[F.lit(values.get(c)).cast(kinds[c]).alias(c) for c in table.columns])


def temporal_features(df: DataFrame) -> DataFrame:
    """Days since the last sale, sale year and month; a missing or unreadable date gives the fixed fill."""
    sold = parse_date("prev_sold_date")
    days = F.datediff(F.lit(SETTINGS.reference_date).cast("date"), sold)
    return df.withColumns(
        {
            "days_since_last_sale": F.when(sold.isNotNull(), F.greatest(days, F.lit(0))).otherwise(SETTINGS.missing_days),
            "sold_year": F.coalesce(F.year(sold), F.lit(0)),
            "sold_month": F.coalesce(F.month(sold), F.lit(0)),
        }
    )


def stateless_features(df: DataFrame) -> DataFrame:
    """Row-wise features; missing numbers count as 0, negative price, size and lot as 0."""

    def number(c: str):
        return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))

    price, size, lot = (F.greatest(number(c), F.lit(0.0)) for c in ("price", "house_size", "acre_lot"))
    bed, bath = number("bed"), number("bath")
    out = df.withColumns(
        {
            "price_log": F.log1p(price),
            "house_size_log": F.log1p(size),
            "acre_lot_log": F.log1p(lot),
            "price_per_sqft": F.when(size > 0, ratio(price, size)),
            "bath_per_bed": F.when(bed > 0, ratio(bath, bed)).otherwise(0.0),
            "is_large_property": flag(size > SETTINGS.large_property_sqft),
        }
    )
    return temporal_features(out) if "prev_sold_date" in df.columns else out


def city_medians(df: DataFrame, rules: LabelRules = LabelRules(), by: Keys = ()) -> DataFrame:
    """Median raw price of cities with enough priced listings."""
    q = exact_quantiles(df, [*by, "city"], "price", {"city_median_price": 0.5})
    return q.where(F.col("n") >= rules.min_city_listings).select(*by, "city", "city_median_price")


def state_medians(df: DataFrame, rules: LabelRules = LabelRules(), by: Keys = ()) -> DataFrame:
    q = exact_quantiles(df, [*by, "state"], "price", {"state_median_price": 0.5})
    return q.where(F.col("n") >= rules.min_state_listings).select(*by, "state", "state_median_price")


def zip_frequency(df: DataFrame, by: Keys = ()) -> DataFrame:
    rows = df.where(F.col("zip_code").isNotNull())
    return rows.groupBy(*by, "zip_code").agg(F.count(F.lit(1)).alias("zip_listing_count"))


def city_rates(df: DataFrame, label: str, rules: LabelRules = LabelRules(), by: Keys = ()) -> DataFrame:
    """Target encoding: mean label of the cities that pass the listing cut."""
    rows = df.where(F.col("city").isNotNull()).groupBy(*by, "city")
    agg = rows.agg(F.count("price").alias("_n"), F.avg(F.col(label).cast("double")).alias("city_fraud_rate"))
    return agg.where(F.col("_n") >= rules.min_city_listings).select(*by, "city", "city_fraud_rate")


def _of_fold(table: DataFrame, k: int) -> DataFrame:
    return table.where(F.col("cv_fold") == k).drop("cv_fold")


def left_out_medians(rows: DataFrame, key: str, value: str, folds: int, name: str, least: int) -> DataFrame:
    """(cv_fold, key, name, n): the median of each key's values outside each fold, for keys with ``least`` of them.

    Values are counted once per key, with a count outside each fold beside each other; running totals of these counts hold every
    fold's median, so no row is copied.
    """
    present = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    outside = [f"_x{k}" for k in range(folds)]
    counts = present.groupBy(key, value).agg(*[F.count(F.when(F.col("fold") != k, 1)).alias(x) for k, x in enumerate(outside)])
    counts = materialize(counts, "left_out_counts")
    if largest_group(counts, [key]) <= SMALL_KEY:  # one aggregation instead of running totals
        mids = [F.percentile(value, F.lit(0.5), F.col(x)).alias(f"q{x}") for x in outside]
        table = counts.groupBy(key).agg(*mids, *[F.sum(x).alias(x) for x in outside])
        cells = [F.struct(F.lit(k).alias("cv_fold"), F.col(f"q{x}").alias(name), F.col(x).alias("n")) for k, x in enumerate(outside)]
        each = table.select(key, F.explode(F.array(*cells)).alias("c")).select("c.cv_fold", key, f"c.{name}", "c.n")
        return each.where(F.col("n") >= least)
    placed = running_totals(counts, [key], value, outside)
    cells = []
    for k, x in enumerate(outside):
        total, start = F.col(f"total_{x}"), F.col(f"before_{x}")
        middle = (total - 1) * 0.5
        low, high = F.floor(middle), F.ceil(middle)

        def at(rank):
            return F.max(F.when((start <= rank) & (rank < start + F.col(x)), F.col(value)))

        near, far = at(low), at(high)
        mixed = F.max(high - middle) * near + F.max(middle - low) * far
        cells.append(F.struct(F.lit(k).alias("cv_fold"), F.when(near == far, near).otherwise(mixed).alias(name), F.max(total).alias("n")))
    table = placed.groupBy(key).agg(*[c.alias(f"c{k}") for k, c in enumerate(cells)])
    each = table.select(key, F.explode(F.array(*[F.col(f"c{k}") for k in range(folds)])).alias("c")).select("c.cv_fold", key, f"c.{name}", "c.n")
    return each.where(F.col("n") >= least)


def left_out_totals(rows: DataFrame, key: str, folds: int, sums: dict[str, Column]) -> DataFrame:
    """(cv_fold, key, sums): totals of each key over the rows outside each fold: those of all rows less those of the fold."""
    per = rows.where(F.col(key).isNotNull()).groupBy(key, "fold").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    own = per.groupBy(key).agg(
        *[F.sum(n).alias(n) for n in sums],
        *[F.coalesce(F.sum(F.when(F.col("fold") == k, F.col(n))), F.lit(0)).alias(f"_{n}{k}") for k in range(folds) for n in sums],
    )
    cells = [F.struct(F.lit(k).alias("cv_fold"), *[(F.col(n) - F.col(f"_{n}{k}")).alias(n) for n in sums]) for k in range(folds)]
    return own.select(key, F.explode(F.array(*cells)).alias("c")).select("c.cv_fold", key, *[f"c.{n}" for n in sums])


def fit_left_out(rows: DataFrame, folds: int, label: str = "is_fraud", rules: LabelRules = LabelRules()) -> FeatureStats:
    """``fit_features`` by ``cv_fold`` for the training rows of every fold, from rows that carry their own ``fold`` once."""

    def city() -> DataFrame:
        medians = left_out_medians(rows, "city", "price", folds, "city_median_price", rules.min_city_listings).drop("n")
        sums = left_out_totals(rows, "city", folds, {"_rows": F.lit(1), "_label": F.col(label).cast("long")})
        rate = (F.col("_label").cast("double") / F.col("_rows")).alias("city_fraud_rate")
        joined = medians.join(sums, ["cv_fold", "city"]).select("cv_fold", "city", "city_median_price", rate)
        return materialize(joined, "feature_city")

    def state() -> DataFrame:
        table = left_out_medians(rows, "state", "price", folds, "state_median_price", rules.min_state_listings)
        return materialize(table.drop("n"), "feature_state")

    def zip_code() -> DataFrame:
        table = left_out_totals(rows, "zip_code", folds, {"zip_listing_count": F.lit(1)})
        return materialize(table.where(F.col("zip_listing_count") > 0), "feature_zip")

    city_t, state_t, zip_t = in_parallel(city, state, zip_code)
    return FeatureStats(("cv_fold",), city_t, state_t, zip_t, materialize(_fallback(city_t, state_t, ("cv_fold",), True), "feature_fallback"))


@dataclass(frozen=True)
class FeatureStats:
    """Fitted lookups; ``fallback`` has one row per ``by`` value."""

    by: tuple[str, ...]
    city: DataFrame
    state: DataFrame
    zip_code: DataFrame
    fallback: DataFrame

    def of(self, k: int) -> FeatureStats:
        """The statistics of one fold, as those of a single fit."""
        return FeatureStats((), *[_of_fold(t, k) for t in (self.city, self.state, self.zip_code, self.fallback)])


def fit_features(
    df: DataFrame, label: str | None = "is_fraud", rules: LabelRules = LabelRules(), by: Keys = (), labeled: DataFrame | None = None
) -> FeatureStats:
    """Fit on training rows only. Unknown places later get the median of the city (state) medians and the mean of
    the city rates. ``labeled`` has the same rows with city, price and label where ``df`` has no label."""

    def city() -> DataFrame:
        extra = [F.count("price").alias("_n")]
        if label:
            extra.append(F.avg(F.col(label).cast("double")).alias("city_fraud_rate"))
        table = group_quantiles(labeled if labeled is not None else df, [*by, "city"], {"city_median_price": ("price", 0.5)}, extra)
        return materialize(table.where(F.col("_n") >= rules.min_city_listings).drop("_n"), "feature_city")

    city_t, state_t, zip_t = in_parallel(
        city,
        lambda: materialize(state_medians(df, rules, by), "feature_state"),
        lambda: materialize(zip_frequency(df, by), "feature_zip"),
    )
    fallback = _fallback(city_t, state_t, by, bool(label))
    return FeatureStats(tuple(by), city_t, state_t, zip_t, materialize(fallback, "feature_fallback"))


def _fallback(city: DataFrame, state: DataFrame, by: Keys, rated: bool) -> DataFrame:
    """What unknown places get: the median of the city (state) medians and the mean of the city rates."""
    mid_city = exact_quantiles(city, by, "city_median_price", {"_city_mid": 0.5}, few_groups=True).drop("n")
    mid_state = exact_quantiles(state, by, "state_median_price", {"_state_mid": 0.5}, few_groups=True).drop("n")
    out = join_scalars(mid_city, mid_state, by)
    return join_scalars(out, city.groupBy(*by).agg(F.avg("city_fraud_rate").alias("_rate_mean")), by) if rated else out


def apply_features(df: DataFrame, stats: FeatureStats) -> DataFrame:
    by = list(stats.by)
    out = left_lookup(df, stats.city, [*by, "city"])
    out = left_lookup(out, stats.state, [*by, "state"])
    out = left_lookup(out, stats.zip_code, [*by, "zip_code"])
    out = join_scalars(out, stats.fallback, by)
    median = F.coalesce("city_median_price", "_city_mid")
    columns = {
        "price_vs_city_median": F.when(median > 0, ratio(F.col("price"), median)).otherwise(1.0),
        "city_median_price": median,
        "state_median_price": F.coalesce("state_median_price", "_state_mid"),
        "zip_listing_count": F.coalesce("zip_listing_count", F.lit(0)),
    }
    if "city_fraud_rate" in out.columns:
        columns["city_fraud_rate"] = F.coalesce("city_fraud_rate", "_rate_mean")
    return out.withColumns(columns).drop("_city_mid", "_state_mid", "_rate_mean")


@dataclass(frozen=True)
class Preprocessor:
    """Fitted imputation, scaling and encoding; ``numbers`` and ``modes`` have one row per ``by`` value."""

    by: tuple[str, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    numbers: DataFrame  # by…, med_<c>, mean_<c>, std_<c>
    modes: DataFrame  # by…, mode_<c>
    codes: dict[str, DataFrame]  # per categorical column: by…, <c>, code_<c>

    def of(self, k: int) -> Preprocessor:
        """The fit of one fold, as a single one."""
        codes = {c: _of_fold(t, k) for c, t in self.codes.items()}
        return Preprocessor((), self.numeric, self.categorical, _of_fold(self.numbers, k), _of_fold(self.modes, k), codes)


def fit_medians(df: DataFrame, columns: Keys, by: Keys = ()) -> DataFrame:
    q = exact_quantiles(melt(df, columns, by), [*by, "feature"], "value", {"mid": 0.5}, few_groups=True)
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("feature") == c, F.col("mid"))).alias(f"med_{c}") for c in columns])


def fit_modes(df: DataFrame, columns: Keys, by: Keys = ()) -> DataFrame:
    """Most frequent value per column, the smallest among ties."""
    long = df.select(*by, *columns).unpivot(list(by), list(columns), "feature", "value")
    n = long.where(F.col("value").isNotNull()).groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return _modes(n, columns, by)


def _modes(n: DataFrame, columns: Keys, by: Keys) -> DataFrame:
    """Modes from counts (by…, feature, value, n)."""

    def mode(c: str):
        mine = F.col("feature") == c
        best = F.min(F.when(mine, F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))))
        return best["v"].alias(f"mode_{c}")

    return n.groupBy(*by).agg(*[mode(c) for c in columns])


def fit_codes(df: DataFrame, column: str, by: Keys = ()) -> DataFrame:
    """Ordinal codes of a low-cardinality column: position in sorted order.

    The window runs over the distinct values, not over the rows.
    """
    return _codes(df.where(F.col(column).isNotNull()).select(*by, column).distinct(), column, by)


def _codes(distinct: DataFrame, column: str, by: Keys) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(column)
    return distinct.withColumn(f"code_{column}", F.row_number().over(order) - 1)


def fit_preprocessor(
    df: DataFrame, numeric: Keys | None = None, categorical: Keys = CATEGORICAL, by: Keys = ()
) -> Preprocessor:
    numeric = tuple(numeric if numeric is not None else numeric_features())
    medians, modes = in_parallel(
        lambda: materialize(fit_medians(df, numeric, by), "prep_medians"),
        lambda: materialize(fit_modes(df, categorical, by), "prep_modes"),
    )
    numbers = _numbers(df, medians, numeric, by)
    imputed = join_scalars(df.select(*by, *categorical), modes, by)
    imputed = imputed.withColumns({c: F.coalesce(c, f"mode_{c}") for c in categorical})
    jobs = [lambda: materialize(numbers, "prep_numbers")]
    jobs += [lambda c=c: materialize(fit_codes(imputed, c, by), f"prep_codes_{c}") for c in categorical]
    numbers_t, *codes = in_parallel(*jobs)
    return Preprocessor(tuple(by), numeric, tuple(categorical), numbers_t, modes, dict(zip(categorical, codes)))


def _numbers(df: DataFrame, medians: DataFrame, numeric: Keys, by: Keys) -> DataFrame:
    """Medians with mean and deviation of the columns filled by them."""
    filled = join_scalars(df, medians, by)
    moments = []
    for c in numeric:
        x = F.coalesce(F.col(c).cast("double"), F.col(f"med_{c}"))
        moments += [F.avg(x).alias(f"mean_{c}"), F.stddev_pop(x).alias(f"std_{c}")]
    return join_scalars(medians, filled.groupBy(*by).agg(*moments), by)


def fit_left_out_preprocessor(rows: DataFrame, seen: DataFrame, folds: int, categorical: Keys = CATEGORICAL) -> Preprocessor:
    """``fit_preprocessor`` by ``cv_fold`` for the training rows of every fold.

    ``rows`` have their own ``fold`` and the row-wise features once; ``seen`` has the training rows of every fold with all features. What does
    not depend on the fold's statistics is counted on ``rows``, with a count outside each fold beside each other.
    """
    numeric = tuple(numeric_features())
    by = ("cv_fold",)

    def medians() -> DataFrame:
        shared, own = in_parallel(
            lambda: column_medians(rows, [*NUMERIC, *STATELESS], {k: F.col("fold") != k for k in range(folds)}),
            lambda: column_medians(seen, FOLD_DEPENDENT, {k: F.col("cv_fold") == k for k in range(folds)}),
        )
        each = shared.unionByName(own).groupBy(F.col("measure").alias("cv_fold"))
        return materialize(each.agg(*[F.max(F.when(F.col("feature") == c, F.col("mid"))).alias(f"med_{c}") for c in numeric]), "prep_medians")

    def categories() -> DataFrame:
        """(cv_fold, feature, value, n): how many training rows of the fold have the value."""
        long = rows.select("fold", *categorical).unpivot(["fold"], list(categorical), "feature", "value").where(F.col("value").isNotNull())
        outside = [F.count(F.when(F.col("fold") != k, 1)) for k in range(folds)]
        counts = long.groupBy("feature", "value").agg(F.array(*outside).alias("_n"))
        each = counts.select("feature", "value", F.posexplode("_n").alias("cv_fold", "n"))
        return materialize(each.where(F.col("n") > 0), "prep_categories")

    medians_t, counts = in_parallel(medians, categories)
    jobs = [lambda: materialize(_numbers(seen, medians_t, numeric, by), "prep_numbers")]
    jobs += [lambda: materialize(_modes(counts, categorical, by), "prep_modes")]
    for c in categorical:
        values = counts.where(F.col("feature") == c).select("cv_fold", F.col("value").alias(c))
        jobs += [lambda c=c, values=values: materialize(_codes(values, c, by), f"prep_codes_{c}")]
    numbers_t, modes_t, *codes = in_parallel(*jobs)
    return Preprocessor(by, numeric, tuple(categorical), numbers_t, modes_t, dict(zip(categorical, codes)))


def impute_numeric(df: DataFrame, medians: DataFrame, columns: Keys, by: Keys = ()) -> DataFrame:
    joined = join_scalars(df, medians, by)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"med_{c}")) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def scale_numeric(df: DataFrame, numbers: DataFrame, columns: Keys, by: Keys = ()) -> DataFrame:
    """Standardise by population deviation; a constant column is only centred."""
    joined = join_scalars(df, numbers, by)
    scaled = {}
    for c in columns:
        std = F.when(F.col(f"std_{c}") > 0, F.col(f"std_{c}")).otherwise(1.0)
        scaled[c] = (F.coalesce(F.col(c).cast("double"), F.col(f"med_{c}")) - F.col(f"mean_{c}")) / std
    return joined.withColumns(scaled).select(*df.columns)


def encode_categorical(df: DataFrame, prep: Preprocessor, columns: Keys) -> DataFrame:
    """Impute the mode, then the ordinal code; a value not seen at fit time gives -1."""
    out = join_scalars(df, prep.modes, prep.by)
    out = out.withColumns({c: F.coalesce(c, f"mode_{c}") for c in columns}).select(*df.columns)
    for c in columns:
        out = left_lookup(out, prep.codes[c], [*prep.by, c])
    return out.withColumns({c: F.coalesce(f"code_{c}", F.lit(-1)).cast("double") for c in columns}).select(*df.columns)


def preprocess(df: DataFrame, prep: Preprocessor) -> DataFrame:
    return encode_categorical(scale_numeric(df, prep.numbers, prep.numeric, prep.by), prep, prep.categorical)


def engineered(df: DataFrame, stats: FeatureStats) -> DataFrame:
    """Fold-dependent features on raw prices, then the row-wise ones."""
    return stateless_features(apply_features(df, stats))
