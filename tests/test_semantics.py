"""Null, NaN, rounding, edge-case and leakage behaviour on small hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from listingguard.config import SETTINGS
from listingguard.functions.exprs import cap, flag, nan_to_null, title_case, unbiased_skew
from listingguard.operators import features as fe
from listingguard.operators import labelling as lab
from listingguard.operators import metrics as me
from listingguard.operators import predlog as pl
from listingguard.operators import validate as va
from listingguard.plans import catalog
from listingguard.sources import tables


def one(spark, expr, value, kind="double"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr.alias("x")).first()["x"]


def test_missing_values(spark):
    assert one(spark, nan_to_null("v"), float("nan")) is None
    assert one(spark, flag(F.col("v") > 1), None) == 0
    assert one(spark, cap("v", 3.0), None) is None
    assert one(spark, cap("v", 3.0), 9.0) == 3.0


@pytest.mark.parametrize("raw,want", [("winston-salem", "Winston-Salem"), ("O'NEIL city", "O'Neil City"), ("", ""), ("austin2b", "Austin2B")])
def test_title_case(spark, raw, want):
    assert one(spark, title_case("v"), raw, "string") == want


def test_skew_is_bias_corrected(spark):
    import pandas as pd

    values = [1.0, 2.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(unbiased_skew("v")).first()[0] == pytest.approx(pd.Series(values).skew())


def test_dates(spark):
    rows = [("2023-12-31",), ("2030-01-01",), ("not-a-date",), (None,)]
    out = fe.temporal_features(spark.createDataFrame(rows, "prev_sold_date string")).collect()
    assert [r["days_since_last_sale"] for r in out] == [1, 0, 9999, 9999]
    assert [r["sold_year"] for r in out] == [2023, 2030, 0, 0]


def test_bad_cells_become_null(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("listing_id,price,bed,zip_code,street\na,100,3,01234,9\nb,oops,,77,1\n")
    got = tables.read_any(spark, str(path)).orderBy("listing_id").collect()
    assert [(r["price"], r["bed"], r["zip_code"]) for r in got] == [(100.0, 3.0, "01234"), (None, None, "77")]
    assert "street" not in tables.read_csv(spark, str(path)).columns


# Edge cases of the scoring path (price, bed, bath, size, lot, city, state).
EDGE = [
    ("normal", 450000.0, 4.0, 3.0, 2200.0, 0.25, "City_1", "NATION_1"),
    ("price only", 300000.0, None, None, None, None, None, None),
    ("unknown city", 250000.0, 3.0, 2.0, 1800.0, None, "FakeCityXYZ123", "NATION_1"),
    ("studio", 300000.0, 0.0, 1.0, 500.0, None, "City_2", "NATION_1"),
    ("near zero", 0.01, 3.0, 2.0, 1500.0, None, "City_2", "NATION_1"),
    ("beds", 500000.0, 25.0, 3.0, 2000.0, None, "City_2", "NATION_1"),
    ("negative lot", 300000.0, 3.0, 2.0, 1500.0, -5.0, "City_2", "NATION_1"),
    ("too dear", 200000000.0, None, None, None, None, None, None),
    ("nothing", None, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(
        EDGE, "listing_id string, price double, bed double, bath double, house_size double, acre_lot double, city string, state string"
    )
    return va.add_missing_columns(df)


def test_edge_rows_are_labelled(spark, sf_dir, edge):
    out = {r["listing_id"]: r for r in lab.apply_labels(edge, lab.fit_labels(catalog.listings(spark, sf_dir))).collect()}
    assert len(out) == len(EDGE)
    assert out["beds"]["rule_impossible_dims"] == 1 and out["normal"]["rule_impossible_dims"] == 0
    assert out["near zero"]["rule_price_low"] == 1
    assert out["nothing"]["fraud_score"] == 0


def test_edge_rows_validated(edge):
    bad = {r["listing_id"]: r["reasons"] for r in va.rejected_listings(edge).collect()}
    assert bad == {"negative lot": "acre_lot_negative", "too dear": "price_too_high", "nothing": "price_missing"}


def test_schema_gate(edge):
    assert va.check_schema(edge) is edge
    with pytest.raises(ValueError):
        va.check_schema(edge.drop("price"))
    with pytest.raises(ValueError):
        va.require_rows(edge)
    assert "rule_duplicate" in lab.flag_duplicates(edge.drop("bed", "bath")).columns


def test_unknown_places_take_medians_of_medians(spark):
    rows = [(str(i), c, p, y) for c, base in (("a", 100.0), ("b", 300.0), ("c", 800.0)) for i, (p, y) in enumerate([(base, 0), (base, 1)] * 20)]
    df = spark.createDataFrame(rows, "listing_id string, city string, price double, is_fraud int")
    df = df.withColumns({"state": F.lit("s"), "zip_code": F.lit("z")})
    new = df.limit(1).withColumns({"city": F.lit("new"), "zip_code": F.lit(None).cast("string")})
    got = fe.apply_features(new, fe.fit_features(df)).first()
    assert (got["city_median_price"], got["city_fraud_rate"], got["zip_listing_count"]) == (300.0, 0.5, 0)


def test_fit_ignores_test_rows(spark, sf_dir):
    """Changing held-out rows leaves every fitted statistic as it was."""
    rows = catalog.listings(spark, sf_dir)
    changed = rows.withColumn("price", F.when(catalog.is_test(), F.col("price") * 7 + 1).otherwise(F.col("price")))
    a, b = (lab.fit_labels(r.where(~catalog.is_test())) for r in (rows, changed))
    assert (a.price_clip, a.size_clip, a.national_median) == (b.price_clip, b.size_clip, b.national_median)
    assert a.city.exceptAll(b.city).count() == 0 and a.state.exceptAll(b.state).count() == 0


def test_metrics_on_a_worked_example(spark):
    rows = [("m", 1, 0.9), ("m", 0, 0.8), ("m", 1, 0.8), ("m", 0, 0.2)]
    long = spark.createDataFrame(rows, "model string, y int, p double")
    assert me.pr_auc(long).first()["pr_auc"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3, abs=1e-6)
    assert me.roc_auc(long).first()["roc_auc"] == pytest.approx(0.875)
    assert me.recall_at_precision(long).first()["recall_at_95p"] == 0.5
    none = spark.createDataFrame([("m", 0, 0.9), ("m", 1, 0.1)], "model string, y int, p double")
    assert me.recall_at_precision(none).first()["recall_at_95p"] == 0.0
    assert me.metrics_at_threshold(none, 0.95).first()["precision"] == 0.0


def test_history_filters(spark, sf_dir):
    log = catalog.prediction_log(spark, sf_dir)
    assert pl.history(log).count() == log.count()
    assert pl.history(log, risk_tier="HIGH").agg(F.min("fraud_score")).first()[0] >= SETTINGS.suspicious_score
    with pytest.raises(ValueError):
        pl.page(log, limit=501)


def test_sinks(spark, sf_dir, tmp_path):
    df = lab.rule_contribution(catalog.labeled(spark, sf_dir))
    tables.write_report_csv(df, f"{tmp_path}/csv")
    tables.write_report_json(df, f"{tmp_path}/json")
    tables.append_table(df, f"{tmp_path}/log")
    tables.append_table(df, f"{tmp_path}/log")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 7
    assert spark.read.json(f"{tmp_path}/json").count() == 7
    assert spark.read.parquet(f"{tmp_path}/log").count() == 14
    tables.write_table(catalog.labeled(spark, sf_dir), f"{tmp_path}/labeled", "state")
    assert spark.read.parquet(f"{tmp_path}/labeled").where("state = 'NATION_1'").count() > 0


def test_corpus_skips_missing_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("one\ntwo")
    got = tables.read_corpus(spark, [str(tmp_path / "a.md"), str(tmp_path / "none.md")]).collect()
    assert [r["content"] for r in got] == ["one\ntwo"]
    importance = spark.createDataFrame([(i, f"f{i}", 1.0 / i) for i in range(1, 13)], "rank int, feature string, mean_impact double")
    text = tables.importance_document(importance, "imp").first()["content"]
    assert text.startswith("Feature importance (top 10):\n1  f1") and "f11" not in text
