"""The ingest and labelling jobs, and scoring by batch and by stream."""

from pyspark.sql import functions as F

from listingguard.operators import explain as ex
from listingguard.operators import scoring as sg
from listingguard.operators import drift as dr
from listingguard.operators import labelling as lab
from listingguard.plans import catalog, jobs
from listingguard.streaming import score as st
from tests.small import PARAMS, small_run


def test_ingest_then_label(spark, sf_dir, tmp_path):
    rows = catalog.listings(spark, sf_dir)
    rows.unionByName(rows.limit(20)).write.option("header", True).csv(str(tmp_path / "in.csv"))
    n = jobs.ingest(spark, str(tmp_path / "in.csv"), str(tmp_path / "ready"), min_rows=100)
    assert 0 < n <= rows.count()
    assert jobs.label(spark, f"{tmp_path}/ready/listings.parquet", str(tmp_path / "done")) == n
    labels = spark.read.parquet(f"{tmp_path}/done/labels")
    assert {"fraud_score", "is_fraud", "rule_duplicate"} <= set(labels.columns)
    assert spark.read.option("header", True).csv(f"{tmp_path}/done/rules.csv").count() == 7


def test_train_score_and_drift_jobs(spark, sf_dir, tmp_path):
    rows = catalog.labeled(spark, sf_dir)
    rows.write.parquet(str(tmp_path / "labels"))
    target = str(tmp_path / "trained")
    assert jobs.train(spark, f"{tmp_path}/labels", target, PARAMS) == rows.count()
    assert spark.read.option("header", True).csv(f"{target}/folds.csv").count() == 10
    listings = catalog.listings(spark, sf_dir)
    listings.write.parquet(f"{tmp_path}/new.parquet")
    n = jobs.score(spark, f"{tmp_path}/new.parquet", target, f"{target}/model")
    assert n == jobs.score(spark, f"{tmp_path}/new.parquet", target, f"{target}/model") == spark.read.parquet(f"{target}/log").count() > 0
    months = jobs.drift(spark, f"{tmp_path}/new.parquet", target)
    assert months == spark.read.parquet(f"{target}/report").count() > 12
    # a model trained on all listings has not drifted from them over all months together
    baseline = dr.load_baseline(spark, f"{target}/baseline")
    assert dr.detect(dr.price_stats(listings), baseline).count() == 0


def test_deliveries_of_a_month_add_up(spark, sf_dir, tmp_path):
    dated = catalog._after(spark, sf_dir).withColumn("month", F.date_format("sold", "yyyy-MM"))
    dr.save_baseline(dr.training_stats(catalog._before(spark, sf_dir)), f"{tmp_path}/baseline")
    half = F.col("brokered_by").cast("bigint") % 2 == 0
    jobs.drift_months(spark, dated.where(half), str(tmp_path), "first")
    jobs.drift_months(spark, dated.where(~half | F.col("brokered_by").isNull()), str(tmp_path), "second")
    jobs.drift_months(spark, dated.where(half), str(tmp_path), "first")
    want = catalog.drift_by_month(spark, sf_dir)
    got = spark.read.parquet(f"{tmp_path}/report").withColumn("month", F.col("month").cast("string")).select(want.columns)
    assert got.count() == want.count() and want.exceptAll(got).count() == 0
    stats = dr.price_stats(dated, ["month", "city"]).where("count > 0")
    again = dr.stats_of_counts(dr.price_counts(dated, "city"), "city")
    joined = stats.join(again.select("month", "city", F.col("median").alias("m"), F.col("std").alias("s"), F.col("count").alias("c")), ["month", "city"])
    assert joined.count() == stats.where("month IS NOT NULL AND city IS NOT NULL").count() == again.count()
    assert joined.where("median <> m OR count <> c OR (std IS NULL) <> (s IS NULL) OR abs(std - s) > 1e-9 * (1 + std)").count() == 0


def test_duplicates_across_stream_batches(spark, sf_dir, tmp_path):
    """However the rows are dealt to batches, the flags at the end are those of one table."""
    rows = catalog.listings(spark, sf_dir)
    stats = lab.fit_labels(rows)
    columns = ["listing_id", "rule_duplicate", "fraud_score", "is_fraud"]
    want = lab.apply_labels(rows, stats, size_median=stats.size_median).select(columns)
    assert want.agg(F.sum("rule_duplicate")).first()[0] > 0
    for name, files in (("one", 1), ("many", 7)):
        rows.repartition(files, "listing_id").write.parquet(f"{tmp_path}/{name}/in")
        stream = st.read_listing_stream(spark, f"{tmp_path}/{name}/in", rows.schema, files_per_batch=1)
        for q in st.label_stream(stream, stats, f"{tmp_path}/{name}/out", f"{tmp_path}/{name}/state"):
            q.awaitTermination()
        got = st.stream_labels(spark, f"{tmp_path}/{name}/out").select(columns)
        assert got.count() == want.count() and want.exceptAll(got).count() == 0


def test_stream_goes_on_after_a_stop(spark, sf_dir, tmp_path):
    rows = catalog.listings(spark, sf_dir)
    stats = lab.fit_labels(rows)
    for part, keep in (("a", "< 3"), ("b", ">= 3")):
        rows.where(f"pmod(xxhash64(listing_id), 5) {keep}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = st.read_listing_stream(spark, f"{tmp_path}/in", rows.schema)
        for q in st.label_stream(stream, stats, f"{tmp_path}/out", f"{tmp_path}/state"):
            q.awaitTermination()
    want = lab.apply_labels(rows, stats, size_median=stats.size_median).select("listing_id", "rule_duplicate")
    got = st.stream_labels(spark, f"{tmp_path}/out").select("listing_id", "rule_duplicate")
    assert got.count() == want.count() and want.exceptAll(got).count() == 0


def test_stream_scores_equal_batch_scores(spark, sf_dir):
    scorer = small_run(spark, sf_dir).scorer
    batch, stream = catalog.scored_log_by(spark, sf_dir, scorer), catalog.stream_scored_log_by(spark, sf_dir, scorer)
    assert batch.count() == stream.count() > 0
    assert batch.exceptAll(stream.select(batch.columns)).count() == 0
    tops = batch.select(F.size(ex.from_json("shap_top3")).alias("n")).agg(F.min("n"), F.max("n")).first()
    assert tuple(tops) == (3, 3)


def test_edge_rows_are_scored_or_rejected(spark, sf_dir):
    base = catalog.listings(spark, sf_dir).limit(5).withColumn("listing_id", F.monotonically_increasing_id().cast("string"))
    n = F.col("listing_id").cast("int") % 5
    edge = base.withColumns({
        "price": F.when(n == 0, F.lit(-1.0)).when(n == 1, F.lit(1.0)).otherwise(F.col("price")),
        "bed": F.when(n == 2, F.lit(None)).otherwise(F.col("bed")),
        "city": F.when(n == 3, F.lit("nowhere at all")).otherwise(F.col("city")),
        "house_size": F.when(n == 4, F.lit(0.0)).otherwise(F.col("house_size")),
    }).drop("acre_lot")
    scorer = small_run(spark, sf_dir).scorer
    got = sg.scored_rows(scorer, ex.read_leaves(spark, scorer.gbt), edge).collect()
    assert len(got) == 4 and all(0 <= r.fraud_score <= 1 and r.shap_top3 for r in got)
