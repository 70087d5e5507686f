"""Runnable jobs: ``python -m listingguard.plans.jobs JOB SOURCE TARGET [MODEL]``.

``ingest`` reads CSV or parquet, checks schema and row count, drops duplicates and rows outside the limits, and writes
``TARGET/listings.parquet``, ``TARGET/rejected`` and ``TARGET/dedup_report.json``. ``label`` reads ingested listings, fits the statistics, writes
``TARGET/labels``, ``TARGET/stats`` and the report tables as CSV. ``train`` reads such labels, cross-validates both models, fits the stack and
the final models, and writes ``TARGET/model``, ``TARGET/baseline`` (prices for drift), ``TARGET/oof`` and ``TARGET/folds.csv``; fitted folds are
kept in ``TARGET/ledger``, so the same call after an interruption goes on where it stopped. ``score`` reads listings and a trained MODEL and writes the
log rows to ``TARGET/log``, the scores of one source as one batch. ``drift`` reads one delivery of listings and compares each of its months with
``TARGET/baseline``; it keeps the months' counts in ``TARGET/counts`` and writes ``TARGET/report``. Targets of ``ingest`` and ``label`` must not exist;
``score`` and ``drift`` can be repeated and replace what the same source wrote before.
"""

from __future__ import annotations

import hashlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingguard.functions.exprs import parse_date
from listingguard.operators import drift as dr
from listingguard.operators import explain as ex
from listingguard.operators import labelling as lab
from listingguard.operators import models as mo
from listingguard.operators import scoring as sg
from listingguard.operators import validate as va
from listingguard.operators.ledger import FitLedger
from listingguard.operators.splits import with_group_folds
from listingguard.sources import tables as tb
from listingguard.sources.stage import in_parallel, materialize
from listingguard.sources.versioned import append_batch


def with_ids(df: DataFrame) -> DataFrame:
    """Listings without an id get a digest of their columns."""
    if "listing_id" in df.columns:
        return df
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)]
    return df.withColumn("listing_id", F.md5(F.concat_ws("|", *columns)))


def ingest(spark: SparkSession, source: str, target: str, min_rows: int | None = None) -> int:
    """Returns the number of listings written."""
    raw = materialize(with_ids(va.check_schema(tb.read_any(spark, source))), "ingest")
    va.require_rows(raw, *(() if min_rows is None else (min_rows,)))
    tb.write_report_json(va.dedup_report(raw), f"{target}/dedup_report.json")
    unique = materialize(va.deduplicate(raw), "ingest_unique")
    tb.write_table(va.rejected_listings(unique), f"{target}/rejected")
    tb.write_table(va.normalize_places(va.valid_listings(unique)), f"{target}/listings.parquet")
    return spark.read.parquet(f"{target}/listings.parquet").count()


def label(spark: SparkSession, source: str, target: str) -> int:
    """Returns the number of labelled listings."""
    rows = tb.read_any(spark, source)
    stats = lab.fit_labels(rows)
    stats.save(f"{target}/stats")
    labelled = lab.apply_labels(rows, stats, size_median=stats.size_median)
    tb.write_table(labelled, f"{target}/labels")
    written = spark.read.parquet(f"{target}/labels")
    for name, report in (("rules", lab.rule_contribution), ("totals", lab.label_totals), ("rate", lab.rate_check)):
        tb.write_report_csv(report(written), f"{target}/{name}.csv")
    return written.count()


def train(spark: SparkSession, source: str, target: str, params: mo.TreeParams = mo.TreeParams()) -> int:
    """Returns the number of training listings."""
    rows = spark.read.parquet(source)
    ledger = FitLedger(spark, f"{target}/ledger")
    matrix = mo.fold_matrix(materialize(with_group_folds(rows), "cv_rows"))
    lr, gbt, final = in_parallel(
        lambda: mo.cv_logistic(matrix, ledger=ledger),
        lambda: mo.cv_trees(matrix, params, ledger=ledger),
        lambda: mo.fit_final(rows, params, ledger=ledger),
    )
    mo.oof_table([lr, gbt]).write.mode("overwrite").parquet(f"{target}/oof")
    oof = spark.read.parquet(f"{target}/oof")
    stack = mo.fit_stack(oof, ["lr", "gbt"])
    folds = [mo.fold_metrics(oof, name).withColumn("model", F.lit(name)) for name in ("lr", "gbt")]
    tb.write_report_csv(folds[0].unionByName(folds[1]), f"{target}/folds.csv")
    dr.training_stats(rows).write.mode("overwrite").parquet(f"{target}/baseline")
    mo.Scorer(*final, stack).write().overwrite().save(f"{target}/model")
    return oof.count()


def score(spark: SparkSession, source: str, target: str, model: str) -> int:
    """Returns the number of listings scored."""
    scorer = mo.Scorer.load(model)
    rows = sg.scored_rows(scorer, ex.read_leaves(spark, scorer.gbt), with_ids(tb.read_any(spark, source)))
    batch = hashlib.sha256(source.encode()).hexdigest()[:16]
    append_batch(rows, f"{target}/log", batch)
    return spark.read.parquet(f"{target}/log").where(F.col("batch_id") == batch).count()


def drift(spark: SparkSession, source: str, target: str) -> int:
    """Returns the number of months compared."""
    dated = tb.read_any(spark, source).withColumn("month", F.date_format(parse_date("prev_sold_date"), "yyyy-MM"))
    return drift_months(spark, dated, target, hashlib.sha256(source.encode()).hexdigest()[:16])


def drift_months(spark: SparkSession, dated: DataFrame, target: str, delivery: str, place: str = "city") -> int:
    """Compare the months of ``dated`` (with ``month``), together with earlier deliveries of them, with the stored baseline."""
    named = materialize(dated.where(F.col("month").isNotNull()).select("month").distinct(), "drift_months")
    months = [r["month"] for r in named.collect()]  # months of one delivery
    dr.store_counts(dr.price_counts(dated, place), f"{target}/counts", delivery)
    kept = spark.read.parquet(f"{target}/counts").where(F.col("month").isin(months))
    stats = dr.stats_of_counts(kept.withColumn("month", F.col("month").cast("string")), place)
    found = dr.monthly_report(stats, named, dr.load_baseline(spark, f"{target}/baseline"), place)
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{target}/report")
    return len(months)


def main(args: list[str]) -> None:
    job, *paths = args
    spark = SparkSession.builder.appName(f"listingguard-{job}").getOrCreate()
    print({"ingest": ingest, "label": label, "train": train, "score": score, "drift": drift}[job](spark, *paths))


if __name__ == "__main__":
    main(sys.argv[1:])
