"""Sampling, splits and grouped folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.config import SETTINGS
from listingguard.functions.exprs import seeded_hash
from listingguard.operators.lookup import left_lookup
from listingguard.operators.ordered import smallest_by_hash
from listingguard.sources.stage import materialize


def stratified_sample(
    df: DataFrame, fraction: float, label: str = "is_fraud", seed: int = SETTINGS.seed, row_id: str = "listing_id"
) -> DataFrame:
    """Exactly round(fraction · n) rows of each class, chosen by a seeded hash."""
    hashed = df.withColumn("_h", seeded_hash(row_id, seed))
    take = F.bround(F.col("total_n") * F.lit(float(fraction))).cast("bigint")
    return smallest_by_hash(hashed, label, "_h", take).where("_taken").drop("_taken", "_h")


def stratified_split(
    df: DataFrame,
    test_share: float = SETTINGS.test_share,
    label: str = "is_fraud",
    seed: int = SETTINGS.seed,
    row_id: str = "listing_id",
) -> DataFrame:
    """Column ``split``: ``test`` for exactly round(share · n) rows of each class, otherwise ``train``."""
    hashed = df.withColumn("_h", seeded_hash(row_id, seed + 1))
    take = F.bround(F.col("total_n") * F.lit(float(test_share))).cast("bigint")
    flagged = smallest_by_hash(hashed, label, "_h", take)
    return flagged.withColumn("split", F.when(F.col("_taken"), "test").otherwise("train")).drop("_taken", "_h")


UNKNOWN_GROUP = "__unknown__"


def _spread(loads: list[int], size: int, many: int) -> list[int]:
    """How many of ``many`` groups of one size each fold gets when every group goes to the lightest fold."""
    given = [0] * len(loads)
    while many:
        k = min(range(len(loads)), key=lambda i: (loads[i], i))
        if max(loads) - loads[k] < size and many >= len(loads):
            step, targets = many // len(loads), range(len(loads))  # level: whole rounds
        else:
            second = min(loads[i] for i in range(len(loads)) if i != k) if len(loads) > 1 else loads[k]
            step, targets = min(many, max(1, (second - loads[k]) // size)), [k]
        for t in targets:
            loads[t] += step * size
            given[t] += step
            many -= step
    return given


def group_folds(df: DataFrame, group: str = "city", folds: int = SETTINGS.cv_folds) -> DataFrame:
    """One row per group with its fold: largest groups first, each into the lightest fold.

    Groups of equal size are interchangeable, so the driver works on the histogram of group sizes (distinct sizes
    only), not on the groups; the groups of a size are dealt out by hash order on the cluster.
    """
    named = df.select(F.coalesce(group, F.lit(UNKNOWN_GROUP)).alias(group))
    sizes = materialize(named.groupBy(group).agg(F.count(F.lit(1)).alias("group_size")), "group_sizes")
    histogram = sizes.groupBy("group_size").agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("group_size"))
    loads, bounds = [0] * folds, []
    for row in histogram.toLocalIterator():
        start = 0
        for fold, n in enumerate(_spread(loads, row["group_size"], row["many"])):
            if n:
                bounds.append((row["group_size"], start, start + n, fold))
                start += n
    spark = df.sparkSession
    table = spark.createDataFrame(bounds, "group_size bigint, _from bigint, _to bigint, fold int")
    # Rank of a group within its size: cell offsets by hash, then the rank inside the cell.
    hashed = sizes.withColumn("_h", F.md5(group)).withColumn("_cell", F.substring("_h", 1, 3))
    cells = hashed.groupBy("group_size", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    from pyspark.sql import Window

    before = Window.partitionBy("group_size").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("group_size", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("group_size", "_cell").orderBy("_h", group)
    ranked = hashed.withColumn("_rn", F.row_number().over(inside)).join(offsets, ["group_size", "_cell"])
    ranked = ranked.withColumn("_rank", F.col("_off") + F.col("_rn") - 1)
    placed = ranked.join(table, "group_size").where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return placed.select(group, "group_size", "fold")


def with_group_folds(df: DataFrame, group: str = "city", folds: int = SETTINGS.cv_folds) -> DataFrame:
    """Rows with the fold of their group; rows without a group form one group of their own."""
    table = materialize(group_folds(df, group, folds).select(group, "fold", F.col("group_size").alias("_n")), "folds")
    named = df.withColumn("_group", F.coalesce(group, F.lit(UNKNOWN_GROUP)))
    table = table.withColumnRenamed(group, "_group")
    return left_lookup(named, table, ["_group"], freq="_n").drop("_group")
