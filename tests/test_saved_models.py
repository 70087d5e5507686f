"""Saved scorers and pipelines, resumed fits, statistics outside each fold."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from listingguard.config import LabelRules
from listingguard.operators import estimators as es
from listingguard.operators import features as fe
from listingguard.operators import labelling as lab
from listingguard.operators import models as mo
from listingguard.operators import splits as sp
from listingguard.operators.ledger import FitLedger, content_key
from listingguard.plans import catalog
from listingguard.sources.stage import materialize
from tests.small import small_run

SMALL = mo.TreeParams(trees=4, learning_rate=0.2, depth=3)


@pytest.fixture(scope="module")
def scorer(spark, sf_dir):
    return small_run(spark, sf_dir).scorer


def test_saved_scorer_scores_alike_in_another_process(spark, sf_dir, scorer, tmp_path):
    path = str(tmp_path / "model")
    scorer.write().save(path)
    catalog.listings(spark, sf_dir).write.parquet(str(tmp_path / "in"))
    code = f"""
        from listingguard.operators.models import Scorer
        from listingguard.session import local_session
        spark = local_session(4, memory="4g")
        rows = spark.read.parquet({str(tmp_path / "in")!r})
        Scorer.load({path!r}).score(rows).write.parquet({str(tmp_path / "out")!r})
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=root, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    want, got = scorer.score(catalog.listings(spark, sf_dir)), spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == want.count() and want.exceptAll(got.select(want.columns)).count() == 0


def test_other_order_of_inputs_is_refused(scorer, tmp_path, monkeypatch):
    scorer.write().save(str(tmp_path / "model"))
    names = fe.feature_names()
    monkeypatch.setattr(fe, "feature_names", lambda *a: [names[1], names[0], *names[2:]])
    with pytest.raises(ValueError, match="this code makes"):
        mo.Scorer.load(str(tmp_path / "model"))


def test_model_of_other_width_is_refused(spark, scorer, tmp_path):
    rows = spark.createDataFrame([(0.0, [1.0, 2.0]), (1.0, [3.0, 1.0])] * 40, "label double, x array<double>")
    narrow = mo.fit_logistic(mo.with_vector(rows))
    mo.Scorer(scorer.stats, scorer.prep, narrow, scorer.gbt, scorer.stack).write().save(str(tmp_path / "model"))
    with pytest.raises(ValueError, match="takes 2 inputs"):
        mo.Scorer.load(str(tmp_path / "model"))


def test_whole_pipeline_is_saved(spark, sf_dir, tmp_path):
    rows = catalog.listings(spark, sf_dir)
    rules = {"min_fraud_score": 1}
    stages = [es.RuleLabeller(rules=rules), es.PlaceFeatures(), es.RowFeatures(), es.ListingVector()]
    Pipeline(stages=stages).write().save(str(tmp_path / "unfitted"))
    pipeline = Pipeline.load(str(tmp_path / "unfitted"))
    train, test = rows.where(~catalog.is_test()), rows.where(catalog.is_test())
    fitted = pipeline.fit(train)
    fitted.write().save(str(tmp_path / "fitted"))
    again = PipelineModel.load(str(tmp_path / "fitted"))
    columns = ["listing_id", "is_fraud", "fraud_score", "price_log", "city_fraud_rate", "features"]
    a, b = (m.transform(test).select(columns).orderBy("listing_id").collect() for m in (fitted, again))
    assert a == b and len(a[0].features) == len(fe.feature_names())
    loose = lab.apply_labels(test, lab.fit_labels(train), LabelRules(min_fraud_score=1)).agg(F.sum("is_fraud")).first()[0]
    assert sum(r.is_fraud for r in a) == loose
    assert es.changed_rules(LabelRules(min_fraud_score=1)) == rules


def test_interrupted_folds_are_not_fitted_again(spark, sf_dir, tmp_path):
    matrix = small_run(spark, sf_dir).matrix
    ledger = FitLedger(spark, str(tmp_path / "ledger"))
    fitted = []

    def fit(train, stop_at=None):
        if stop_at is not None and len(fitted) == stop_at:
            raise RuntimeError("lost")
        fitted.append(1)
        return mo.fit_trees(train, SMALL, 3.0)

    with pytest.raises(RuntimeError, match="lost"):
        mo.cross_validate(matrix, lambda t: fit(t, 2), "gbt", threads=1, ledger=ledger, settings=SMALL)
    assert len(fitted) == 2
    got = mo.cross_validate(matrix, fit, "gbt", threads=1, ledger=ledger, settings=SMALL)
    assert len(fitted) == 5
    again = mo.cross_validate(matrix, fit, "gbt", threads=1, ledger=ledger, settings=SMALL)
    assert len(fitted) == 5 and got.exceptAll(again).count() == 0
    plain = mo.cross_validate(matrix, lambda t: mo.fit_trees(t, SMALL, 3.0), "gbt", threads=1)
    assert plain.exceptAll(got).count() == 0
    mo.cross_validate(matrix, fit, "gbt", threads=1, ledger=ledger, settings="others")
    assert len(fitted) == 10


def test_model_cut_off_while_written_is_fitted_again(spark, tmp_path):
    rows = spark.createDataFrame([(0.0, [1.0]), (1.0, [3.0])] * 40, "label double, x array<double>")
    ledger = FitLedger(spark, str(tmp_path / "ledger"))
    key = content_key(rows, "s")
    assert key == content_key(rows.orderBy("label").repartition(3), "s") != content_key(rows, "t")
    mo.fit_logistic(mo.with_vector(rows)).write().save(f"{tmp_path}/ledger/{key}/model")  # no marker
    runs = []

    def fit():
        runs.append(1)
        return mo.fit_logistic(mo.with_vector(rows))

    ledger.model(key, fit)
    ledger.model(key, fit)
    assert runs == [1] and ledger.has(key)


def test_statistics_outside_each_fold_equal_separate_fits(spark, sf_dir):
    rows = materialize(sp.with_group_folds(catalog.labeled(spark, sf_dir), folds=3), "rows")
    # zips and states span folds; so does a city without a name
    extra = rows.limit(400).withColumn("fold", F.pmod(F.xxhash64("listing_id"), F.lit(3)).cast("int")).withColumn("city", F.lit("Everywhere"))
    rows = materialize(rows.unionByName(extra), "rows")
    all_folds = fe.fit_left_out(rows, 3)
    for k in range(3):
        want, got = fe.fit_features(rows.where(F.col("fold") != k)), all_folds.of(k)
        for name in ("city", "state", "zip_code"):
            a, b = getattr(want, name), getattr(got, name)
            assert a.count() == b.count() > 0, name
            assert a.exceptAll(b.select(a.columns)).count() == 0, name
        a, b = want.fallback.first().asDict(), got.fallback.first().asDict()
        assert a == pytest.approx(b, rel=1e-12)  # a mean of rates depends on their order in its last bit


def test_fold_matrix_writes_each_row_once(spark, sf_dir):
    run = small_run(spark, sf_dir)
    assert run.matrix.where("NOT is_train").count() == run.rows.count()
    assert run.matrix.count() == 5 * run.rows.count()
    one = run.matrix.where("cv_fold = 2")
    assert one._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0  # the filter leaves one branch
    stored = mo.fold_matrix(run.rows, written=True)
    assert stored.exceptAll(run.matrix.select(stored.columns)).count() == 0
