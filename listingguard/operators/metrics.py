"""Exact classification metrics from running totals over distinct scores; per model, in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.config import SETTINGS
from listingguard.functions.exprs import flag, ratio, report_round
from listingguard.operators.lookup import with_scalars
from listingguard.operators.ordered import running_totals
from listingguard.sources.stage import materialize

# Thresholds of the sweep and cost of a missed fraud in false alarms.
THRESHOLDS = (0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90)
MISS_COST = 3


def long_scores(df: DataFrame, scores: Sequence[str], label: str = "y_true") -> DataFrame:
    """(model, y, p) rows."""
    return df.select(F.col(label).alias("y"), *scores).unpivot(["y"], list(scores), "model", "p")


def curve(long: DataFrame) -> DataFrame:
    """One row per model and distinct score: positives and rows at the score, below it, and in total."""
    return _curve(long.groupBy("model", "p").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")))


def _curve(counts: DataFrame) -> DataFrame:
    return running_totals(counts, ["model"], "p", ["pos", "n"]).withColumns(
        {
            "tp": F.col("total_pos") - F.col("before_pos"),
            "predicted": F.col("total_n") - F.col("before_n"),
        }
    )


def pr_curve(long: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score, plus the closing point (1, 0) without a threshold."""
    c = curve(long)
    points = c.select(
        "model",
        F.col("p").alias("threshold"),
        report_round(ratio(F.col("tp"), F.col("predicted")), 6).alias("precision"),
        report_round(ratio(F.col("tp"), F.col("total_pos")), 6).alias("recall"),
    )
    end = long.select("model").distinct().select(
        "model", F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def _curve_metrics(c: DataFrame) -> DataFrame:
    """Average precision, ROC area and recall at 95 / 90 % precision from one curve."""
    precision = ratio(F.col("tp"), F.col("predicted"))
    recall = ratio(F.col("tp"), F.col("total_pos"))
    neg, before_neg = F.col("n") - F.col("pos"), F.col("before_n") - F.col("before_pos")
    total_neg = F.max(F.col("total_n") - F.col("total_pos"))
    return c.groupBy("model").agg(
        F.sum(ratio(F.col("pos"), F.col("total_pos")) * precision).alias("pr_auc"),
        ratio(F.sum(F.col("pos") * (before_neg + neg / 2.0)), F.max("total_pos") * total_neg).alias("roc_auc"),
        F.coalesce(F.max(F.when(precision >= 0.95, recall)), F.lit(0.0)).alias("recall_at_95p"),
        F.coalesce(F.max(F.when(precision >= 0.90, recall)), F.lit(0.0)).alias("recall_at_90p"),
    )


def pr_auc(long: DataFrame) -> DataFrame:
    return _curve_metrics(curve(long)).select("model", report_round("pr_auc", 6).alias("pr_auc"))


def roc_auc(long: DataFrame) -> DataFrame:
    return _curve_metrics(curve(long)).select("model", report_round("roc_auc", 6).alias("roc_auc"))


def recall_at_precision(long: DataFrame) -> DataFrame:
    return _curve_metrics(curve(long)).select(
        "model", *[report_round(c, 6).alias(c) for c in ("recall_at_95p", "recall_at_90p")]
    )


def _confusion(long: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Counts per model and threshold: conditional sums in one aggregation, no row is copied per threshold."""
    hit = []
    for i, t in enumerate(thresholds):
        hit.append(F.count(F.when((F.col("p") >= t) & (F.col("y") == 1), 1)).alias(f"tp_{i}"))
        hit.append(F.count(F.when((F.col("p") >= t) & (F.col("y") == 0), 1)).alias(f"fp_{i}"))
    return _confusion_rows(long.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"), *hit), thresholds)


def _confusion_rows(one: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("threshold"), F.col(f"tp_{i}").alias("tp"), F.col(f"fp_{i}").alias("fp"))
            for i, t in enumerate(thresholds)
        ]
    )
    long_rows = one.select("model", "n", "positives", F.explode(rows).alias("r")).select("model", "n", "positives", "r.*")
    return long_rows.withColumn("fn", F.col("positives") - F.col("tp")).withColumn(
        "tn", F.col("n") - F.col("positives") - F.col("fp")
    )


def _prf() -> list:
    precision = F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(ratio(F.col("tp"), F.col("positives")), F.lit(0.0))
    f1 = F.coalesce(ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")), F.lit(0.0))
    return [precision.alias("precision"), recall.alias("recall"), f1.alias("f1")]


def metrics_at_threshold(long: DataFrame, threshold: float = SETTINGS.suspicious_score) -> DataFrame:
    c = _confusion(long, [threshold]).select("model", "threshold", *_prf())
    return c.select("model", "threshold", *[report_round(m, 6).alias(m) for m in ("precision", "recall", "f1")])


def threshold_sweep(long: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    c = _confusion(long, thresholds).select("model", "threshold", "n", "fp", "fn", *_prf())
    return c.select(
        "model",
        "threshold",
        *[report_round(m, 4).alias(m) for m in ("precision", "recall", "f1")],
        F.floor(ratio(F.col("fp"), F.col("n")) * 1000).alias("fp_per_1000"),
        F.floor(ratio(F.col("fn"), F.col("n")) * 1000).alias("fn_per_1000"),
    )


def threshold_cost(long: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Cost 3·FN + FP per 1000 rows at each threshold, with the cheapest marked (lowest threshold among ties)."""
    sweep = threshold_sweep(long, thresholds).select("model", "threshold", "fp_per_1000", "fn_per_1000")
    cost = sweep.withColumn("cost", F.col("fn_per_1000") * MISS_COST + F.col("fp_per_1000"))
    best = cost.groupBy("model").agg(F.min(F.struct("cost", "threshold"))["threshold"].alias("_best"))
    joined = cost.join(F.broadcast(best), "model")  # one row per model
    return joined.withColumn("cheapest", F.col("threshold") == F.col("_best")).drop("_best")


def tier_outcomes(long: DataFrame) -> DataFrame:
    """Size of each risk tier and its frauds per model."""
    from listingguard.functions.exprs import risk_tier

    tier = risk_tier("p", SETTINGS.suspicious_score, SETTINGS.review_score)
    return long.groupBy("model", tier.alias("risk_tier")).agg(
        F.count(F.lit(1)).alias("listings"), F.sum("y").alias("fraud")
    )


def confusion_matrix(long: DataFrame, threshold: float = SETTINGS.suspicious_score) -> DataFrame:
    """Full 2x2 grid per model."""
    c = _confusion(long, [threshold])
    cells = F.array(
        *[
            F.struct(F.lit(y).alias("y_true"), F.lit(p).alias("y_pred"), F.col(m).alias("n"))
            for y, p, m in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return c.select("model", F.explode(cells).alias("c")).select("model", "c.*")


def _bins(long: DataFrame, bins: int) -> DataFrame:
    b = F.least(F.greatest(F.ceil(F.col("p") * bins) - 1, F.lit(0)), F.lit(bins - 1))
    return long.groupBy("model", b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_score"), F.avg(F.col("y").cast("double")).alias("fraction")
    )


def calibration_curve(long: DataFrame, bins: int = 10) -> DataFrame:
    return _bins(long, bins).select(
        "model", "bin", "n", *[report_round(c, 6).alias(c) for c in ("mean_score", "fraction")]
    )


def calibration_error(long: DataFrame, bins: int = 10) -> DataFrame:
    """Unweighted mean over non-empty bins of |fraction − mean score|."""
    gap = F.abs(F.col("fraction") - F.col("mean_score"))
    return _bins(long, bins).groupBy("model").agg(report_round(F.avg(gap), 6).alias("mace"))


def evaluate(long: DataFrame, threshold: float = SETTINGS.suspicious_score) -> DataFrame:
    """All metrics per model, and whether the fixed quality targets are met."""
    # One pass over the rows: every figure follows from the counts of the distinct scores.
    sides = [F.count(F.when(F.col("y") == y, 1)).alias(name) for name, y in (("_hits", 1), ("_misses", 0))]
    counts = long.groupBy("model", "p").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"), *sides)
    counts = materialize(counts, "score_counts")
    areas = _curve_metrics(_curve(counts.drop("_hits", "_misses")))
    over = [F.coalesce(F.sum(F.when(F.col("p") >= threshold, F.col(c))), F.lit(0)).alias(n) for c, n in (("_hits", "tp_0"), ("_misses", "fp_0"))]
    one = counts.groupBy("model").agg(F.sum("n").alias("n"), F.sum("pos").alias("positives"), *over)
    at = _confusion_rows(one, [threshold]).select("model", "threshold", *_prf())
    both = areas.join(at, "model")
    names = ("pr_auc", "roc_auc", "recall_at_95p", "recall_at_90p", "precision", "recall", "f1")
    return both.select(
        "model",
        "threshold",
        *[report_round(m, 6).alias(m) for m in names],
        (F.col("pr_auc") > 0.80).alias("pr_auc_ok"),
        (F.col("recall_at_95p") > 0.40).alias("recall_ok"),
    )


def fold_comparison(df: DataFrame, scores: Sequence[str], label: str = "y_true", fold: str = "fold") -> DataFrame:
    """Models by mean fold PR-AUC, with the population deviation over folds, its flag, and the out-of-fold value."""
    per_fold = df.select(F.col(label).alias("y"), fold, *scores).unpivot(["y", fold], list(scores), "name", "p")
    keyed = per_fold.select("y", "p", F.concat_ws("#", "name", F.col(fold).cast("string")).alias("model"))
    folds = _curve_metrics(curve(keyed)).withColumn("name", F.split("model", "#")[0])
    mean = folds.groupBy("name").agg(
        F.avg("pr_auc").alias("mean_pr_auc"),
        F.stddev_pop("pr_auc").alias("std_pr_auc"),
        F.avg("recall_at_95p").alias("mean_recall_at_95p"),
    )
    oof = _curve_metrics(curve(long_scores(df, scores, label))).select(F.col("model").alias("name"), F.col("pr_auc").alias("oof_pr_auc"))
    joined = mean.join(oof, "name")
    return joined.select(
        F.col("name").alias("model"),
        *[report_round(c, 6).alias(c) for c in ("mean_pr_auc", "std_pr_auc", "mean_recall_at_95p", "oof_pr_auc")],
        (F.col("std_pr_auc") > 0.05).alias("unstable"),
    ).orderBy(F.desc("mean_pr_auc"), "model")


def with_gain(comparison: DataFrame, singles: Sequence[str]) -> DataFrame:
    """A comparison with each model's out-of-fold gain over the best of the single models."""
    best = comparison.where(F.col("model").isin(*singles)).agg(F.max("oof_pr_auc").alias("_best"))
    gained = with_scalars(comparison, best).withColumn("gain", report_round(F.col("oof_pr_auc") - F.col("_best"), 6))
    return gained.drop("_best").orderBy(F.desc("oof_pr_auc"), "model")


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Positive weight of the tree model and the balanced weights of the logistic model."""
    n, p = F.count(F.lit(1)).cast("double"), F.sum(flag(F.col(label) == 1)).cast("double")
    one = df.agg(n.alias("n"), p.alias("p"))
    return one.select(
        report_round(ratio(F.col("n") - F.col("p"), F.col("p")), 2).alias("scale_pos_weight"),
        report_round(ratio(F.col("n"), F.col("p") * 2), 6).alias("weight_positive"),
        report_round(ratio(F.col("n"), (F.col("n") - F.col("p")) * 2), 6).alias("weight_negative"),
    )
