"""Exact order statistics without gathering a group in one task.

Values fall into order-preserving buckets. Bucket totals combine on the map side, and a cumulative sum over them (some
ten thousand rows per group at most) gives each bucket its offset, so only rows *inside* one bucket are ever
sorted together. Quantiles of many groups whose checked size is at most ``GROUP_LIMIT`` rows use Spark's exact
``percentile`` instead: one aggregation, no second scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingguard.functions.exprs import col
from listingguard.operators.lookup import fits_broadcast
from listingguard.sources.stage import materialize

BUCKETS_PER_OCTAVE = 1024
LOWEST_EXPONENT = -1080
GROUP_LIMIT = 1_000_000
#: Distinct values of one bucket that are sorted together; a fuller bucket is cut again between its least and largest value.
BUCKET_LIMIT = 100_000


def value_bucket(value: str | Column) -> Column:
    """Monotone bucket of a finite double, about 0.07 % wide at any size of the value (the logarithm is semi-monotonic)."""
    v = col(value)
    up = F.floor((F.log2(F.abs(v)) - LOWEST_EXPONENT) * BUCKETS_PER_OCTAVE)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * up).cast("long")


def refined_buckets(counts: DataFrame, groups: Sequence[str], value: str, limit: int | None = None) -> DataFrame:
    """``counts`` with (_bucket, _sub): buckets of more than ``limit`` values are cut into equal ranges of the value."""
    limit = limit or BUCKET_LIMIT
    bucketed = counts.withColumn("_bucket", value_bucket(value))
    full = bucketed.groupBy(*groups, "_bucket").agg(
        F.count(F.lit(1)).alias("_rows"), F.min(value).alias("_least"), F.max(value).alias("_most")
    )
    full = full.where((F.col("_rows") > limit) & (F.col("_least") < F.col("_most")))
    share = (F.col(value) - F.col("_least")) / (F.col("_most") - F.col("_least"))
    sub = F.floor(share * F.ceil(4 * F.col("_rows") / limit)).cast("long")
    return (
        bucketed.join(full, [*groups, "_bucket"], "left")
        .withColumn("_sub", F.coalesce(sub, F.lit(0)))
        .drop("_rows", "_least", "_most")
    )


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, value, n) over rows whose groups and value are all present."""
    present = F.lit(True)
    for c in [*groups, value]:
        present = present & F.col(c).isNotNull()
    return df.where(present).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))


def _bucket_offsets(bucketed: DataFrame, groups: Sequence[str], measures: Sequence[str], keys: Sequence[str] = ("_bucket",)) -> DataFrame:
    per_bucket = bucketed.groupBy(*groups, *keys).agg(*[F.sum(m).alias(m) for m in measures])
    whole = Window.partitionBy(*groups)
    prior = whole.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        *groups,
        *keys,
        *[F.coalesce(F.sum(m).over(prior), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"total_{m}") for m in measures],
        *[F.col(m).alias(f"_in_{m}") for m in measures],
    )


def running_totals(counts: DataFrame, groups: Sequence[str], value: str, measures: Sequence[str]) -> DataFrame:
    """Add ``before_<m>`` (sum over smaller values of the group) and ``total_<m>`` to one-row-per-value counts."""
    keys = ["_bucket", "_sub"]
    bucketed = refined_buckets(counts, groups, value)
    offsets = _bucket_offsets(bucketed, groups, measures, keys)
    inside = Window.partitionBy(*groups, *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return bucketed.join(offsets, [*groups, *keys]).select(
        *counts.columns,
        *[
            (F.col(f"_off_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"before_{m}")
            for m in measures
        ],
        *[F.col(f"total_{m}") for m in measures],
    )


def largest_group(df: DataFrame, groups: Sequence[str]) -> int:
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n").alias("n")).first()["n"] or 0


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: dict[str, float],
    few_groups: bool = False,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Linear-interpolated quantiles per group: one row per group, the count ``n`` and one column per name.

    ``few_groups`` says that the group columns take a fixed small set of values (a feature name, a 0/1 label), so that
    groups are few and huge. Otherwise groups are taken to be many; their largest size is checked first.
    """
    if few_groups or not groups or largest_group(df, groups) > group_limit:
        return split_quantiles(df, groups, value, probs, few_groups or not groups)
    present = df.dropna(subset=[*groups, value])
    q = F.percentile(value, F.array(*[F.lit(float(p)) for p in probs.values()]))
    one = present.groupBy(*groups).agg(F.count(value).alias("n"), q.alias("_q"))
    return one.where(F.col("n") > 0).select(
        *groups, "n", *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)]
    )


def group_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    wanted: dict[str, tuple[str, float]],
    extra: Sequence[Column] = (),
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per group: the ``extra`` aggregates and, per name, the quantile of a column (null without values).

    Everything comes from one aggregation as long as the largest group, checked first, is not too large.
    """
    named = df.dropna(subset=list(groups))
    if largest_group(named, groups) <= group_limit:
        cuts = [F.percentile(c, F.lit(float(q))).alias(name) for name, (c, q) in wanted.items()]
        return named.groupBy(*groups).agg(*extra, *cuts)
    out = named.groupBy(*groups).agg(*extra) if extra else named.select(*groups).distinct()
    for column in dict.fromkeys(c for c, _ in wanted.values()):
        probs = {name: q for name, (c, q) in wanted.items() if c == column}
        out = out.join(split_quantiles(named, groups, column, probs).drop("n"), list(groups), "left")
    return out


def split_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float], few_groups: bool = False
) -> DataFrame:
    """Bucketed selection for groups of any size, in two scans.

    The first scan only counts buckets (combined on the map side). The second keeps the rows of the buckets that hold
    a wanted rank, a few thousandths of the data, and ranks those.
    """
    keys = list(groups) or ["_all"]
    rows = (df if groups else df.withColumn("_all", F.lit(1))).select(*keys, value).dropna()
    rows = rows.withColumn("_bucket", value_bucket(value))
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("n"))
    points = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(q)).alias("q")) for k, q in probs.items()])
    wanted = (
        _bucket_offsets(counts, keys, ["n"])
        .withColumn("_point", F.explode(points))
        .withColumn("_pos", F.col("_point.q") * (F.col("total_n") - 1))
        .withColumn("_lo", F.floor("_pos"))
        .withColumn("_hi", F.ceil("_pos"))
        .where((F.col("_hi") >= F.col("_off_n")) & (F.col("_lo") < F.col("_off_n") + F.col("_in_n")))
        .select(*keys, "_bucket", "_off_n", "total_n", "_point.name", "_pos", "_lo", "_hi")
    )
    if few_groups:
        wanted = F.broadcast(wanted)  # at most two buckets per group and quantile
    else:
        wanted = materialize(wanted, "quantile_buckets")
        wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    hits = rows.join(wanted, [*keys, "_bucket"])
    rank_cols = ["_bucket", "name", "_off_n", "total_n", "_pos", "_lo", "_hi"]
    per_value = hits.groupBy(*keys, *rank_cols, value).agg(F.count(F.lit(1)).alias("n"))
    inside = (
        Window.partitionBy(*keys, "_bucket", "name").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = per_value.withColumn(
        "_from", F.col("_off_n") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    ).withColumn("_to", F.col("_from") + F.col("n"))

    def at(rank: str, name: str) -> Column:
        hit = (F.col("name") == name) & (F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_to"))
        return F.max(F.when(hit, F.col(value)))

    def weight(of: Column, name: str) -> Column:
        return F.max(F.when(F.col("name") == name, of))

    def between(name: str) -> Column:
        """The weighted sum that Spark's ``percentile`` forms, so that both ways agree to the last bit."""
        low, high = at("_lo", name), at("_hi", name)
        mixed = weight(F.col("_hi") - F.col("_pos"), name) * low + weight(F.col("_pos") - F.col("_lo"), name) * high
        return F.when(low == high, low).otherwise(mixed)

    return (
        placed.where((F.col("_from") <= F.col("_hi")) & (F.col("_lo") < F.col("_to")))
        .groupBy(*keys)
        .agg(
            F.max("total_n").alias("n"),
            *[between(k).alias(k) for k in probs],
        )
        .drop("_all")
    )


def column_medians(df: DataFrame, columns: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """(measure, feature, mid): exact medians of numeric ``columns`` over the rows for which each of ``measures`` (a condition) holds.

    The first scan counts the buckets of all columns with one count per measure beside each other. The cells that hold a middle rank, two per
    column and measure at most, have a least and a greatest value; the second scan compares with these, so it shuffles the values of
    open cells only.
    """
    names = [f"_m{i}" for i in range(len(measures))]
    flags = [F.when(on, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias(m) for m, on in zip(names, measures.values())]
    wide = df.select(*flags, *[F.col(c).cast("double").alias(c) for c in columns])
    sums = [F.sum(m).alias(m) for m in names]
    rows = wide.unpivot(names, list(columns), "feature", "value").dropna(subset=["value"])
    counts = rows.withColumn("_bucket", value_bucket("value")).groupBy("feature", "_bucket")
    cells = counts.agg(*sums, F.min("value").alias("_least"), F.max("value").alias("_most"))
    whole = Window.partitionBy("feature")
    prior = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "*",
        *[F.coalesce(F.sum(m).over(prior), F.lit(0)).alias(f"_off{m}") for m in names],
        *[F.sum(m).over(whole).alias(f"_total{m}") for m in names],
    )

    def middle(m: str) -> Column:
        return (F.col(f"_total{m}") - 1) * 0.5

    held = F.lit(False)
    for m in names:
        off, n = F.col(f"_off{m}"), F.col(m)
        held = held | ((n > 0) & (off <= F.ceil(middle(m))) & (F.floor(middle(m)) < off + n))
    cells = materialize(cells.where(held), "median_cells")
    ends = cells.where(F.col("_least") < F.col("_most")).groupBy("feature").agg(F.min("_least").alias("a"), F.max("_most").alias("b"))
    ranges = {r["feature"]: (r["a"], r["b"]) for r in ends.collect()}
    found = cells.where(F.col("_least") == F.col("_most")).select("feature", "_bucket", F.col("_least").alias("value"), *names)
    if ranges:
        inside = {c: (F.col(c) >= F.lit(a)) & (F.col(c) <= F.lit(b)) for c, (a, b) in ranges.items()}
        some = F.lit(False)
        for on in inside.values():
            some = some | on
        near = [F.when(on, F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"))) for c, on in inside.items()]
        hits = wide.where(some).select(*names, F.explode(F.array(*near)).alias("_hit")).where(F.col("_hit").isNotNull())
        hits = hits.select("_hit.feature", "_hit.value", *names).groupBy("feature", "value").agg(*sums)
        hits = hits.withColumn("_bucket", value_bucket("value")).select("feature", "_bucket", "value", *names)
        found = hits.join(F.broadcast(cells.where(F.col("_least") < F.col("_most")).select("feature", "_bucket")), ["feature", "_bucket"]).unionByName(found)
    at = cells.select("feature", "_bucket", *[f"{x}{m}" for m in names for x in ("_off", "_total")])
    before = Window.partitionBy("feature", "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.join(F.broadcast(at), ["feature", "_bucket"]).select(
        "*", *[(F.col(f"_off{m}") + F.coalesce(F.sum(m).over(before), F.lit(0))).alias(f"_from{m}") for m in names]
    )

    def mid(m: str) -> Column:
        start, pos = F.col(f"_from{m}"), middle(m)

        def value_at(rank: Column) -> Column:
            return F.max(F.when((start <= rank) & (rank < start + F.col(m)), F.col("value")))

        low, high = value_at(F.floor(pos)), value_at(F.ceil(pos))
        mixed = F.max(F.ceil(pos) - pos) * low + F.max(pos - F.floor(pos)) * high
        return F.when(low == high, low).otherwise(mixed)

    table = placed.groupBy("feature").agg(*[mid(m).alias(m) for m in names])
    each = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(m).alias("mid")) for k, m in zip(measures, names)])
    return table.select("feature", F.explode(each).alias("_e")).select("_e.measure", "feature", "_e.mid")


def smallest_by_hash(df: DataFrame, group: str, hash_col: str, take: Column) -> DataFrame:
    """Flag ``_taken``: the ``take`` smallest hashes of each group, exactly.

    ``take`` may use ``total_n``, the row count of the group. The cut hash is found by narrowing on 4-digit
    prefixes (65 536 cells each), so no group is ever sorted whole; the result is one cut per group.
    """
    cells = df.groupBy(group, F.substring(hash_col, 1, 4).alias("_p1")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(group)
    prior = whole.orderBy("_p1").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        cells.withColumn("total_n", F.sum("n").over(whole))
        .withColumn("_off", F.coalesce(F.sum("n").over(prior), F.lit(0)))
        .withColumn("_k", take)
        .where((F.col("_off") < F.col("_k")) & (F.col("_k") <= F.col("_off") + F.col("n")))
        .select(F.col(group).alias("_g"), F.col("_p1").alias("_c1"), (F.col("_k") - F.col("_off")).alias("_rest"))
    )
    # One row per group: the cell holding the cut. Only that cell's rows are split further.
    in_cell = df.select(group, hash_col).join(
        F.broadcast(first), (F.col(group) == F.col("_g")) & (F.substring(hash_col, 1, 4) == F.col("_c1"))
    )
    cells2 = in_cell.groupBy(group, "_rest", F.substring(hash_col, 5, 4).alias("_p2")).agg(
        F.count(F.lit(1)).alias("n")
    )
    prior2 = whole.orderBy("_p2").rowsBetween(Window.unboundedPreceding, -1)
    second = (
        cells2.withColumn("_off", F.coalesce(F.sum("n").over(prior2), F.lit(0)))
        .where((F.col("_off") < F.col("_rest")) & (F.col("_rest") <= F.col("_off") + F.col("n")))
        .select(F.col(group).alias("_g2"), F.col("_p2").alias("_c2"), (F.col("_rest") - F.col("_off")).alias("_rest2"))
    )
    cut = (
        in_cell.join(
            F.broadcast(second), (F.col(group) == F.col("_g2")) & (F.substring(hash_col, 5, 4) == F.col("_c2"))
        )
        .withColumn("_rn", F.row_number().over(whole.orderBy(hash_col)))
        .where(F.col("_rn") == F.col("_rest2"))
        .select(F.col(group).alias("_cut_group"), F.col(hash_col).alias("_cut"))
    )
    return (
        df.join(F.broadcast(cut), F.col(group) == F.col("_cut_group"), "left")
        .withColumn("_taken", F.coalesce(F.col(hash_col) <= F.col("_cut"), F.lit(False)))
        .drop("_cut_group", "_cut")
    )
