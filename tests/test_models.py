"""Invariants of the model part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from listingguard.operators import explain as ex
from listingguard.operators import features as fe
from listingguard.operators import models as mo
from listingguard.operators import text as tx
from listingguard.plans import catalog
from tests.small import small_run


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    return small_run(spark, sf_dir)


@pytest.fixture(scope="module")
def scorer(spark, sf_dir):
    return small_run(spark, sf_dir).scorer


def test_each_city_is_in_one_fold(run):
    per = run.rows.where("city is not null").groupBy("city").agg(F.count_distinct("fold").alias("n"))
    assert per.agg(F.max("n")).first()[0] == 1
    assert run.rows.where("fold is null").count() == 0


def test_every_listing_is_scored_once(run):
    assert run.oof.count() == run.rows.count() == run.oof.select("listing_id").distinct().count()


def test_scores_lie_in_range_and_trees_win(run):
    low, high = run.oof.agg(F.least(F.min("lr"), F.min("gbt")), F.greatest(F.max("lr"), F.max("gbt"))).first()
    assert 0 <= low and high <= 1
    quality = {r["model"]: r["pr_auc"] for r in mo.compare(run.oof, ["lr", "gbt"]).collect()}
    assert quality["gbt"] > quality["lr"]


def test_calibration_is_monotone(run):
    pdf = run.stack.score(run.oof).toPandas().sort_values("p_stacked")
    assert (np.diff(pdf["p_calibrated"]) >= -1e-12).all()


def test_contributions_add_up_to_the_margin(spark, sf_dir, scorer):
    rows = scorer.matrix(catalog.listings(spark, sf_dir))
    leaves = ex.read_leaves(spark, scorer.gbt)
    explained = ex.tree_contributions(rows, leaves, fe.feature_names())
    total = explained.select("listing_id", F.aggregate("explanation", F.lit(0.0), lambda a, e: a + e["impact"]).alias("s"))
    p = mo.probability(scorer.gbt, mo.with_vector(rows), "p").select("listing_id", "p")
    pdf = total.join(p, "listing_id").toPandas()
    margin = np.log(pdf["p"] / (1 - pdf["p"])) / 2
    assert np.allclose(pdf["s"] + ex.tree_base_value(leaves), margin, atol=1e-8)


def test_pattern_table_matches_brute_force():
    from itertools import combinations
    from math import factorial

    leaf = ex.Leaf(2.0, (0, 3, 5), (-np.inf,) * 3, (1.0,) * 3, (0.3, 0.6, 0.9))
    table = ex.pattern_values(leaf, np.arange(8))

    def game(pattern, members):
        return leaf.value * np.prod([pattern[j] if j in members else leaf.shares[j] for j in range(3)])

    for code in range(8):
        pattern = [(code >> j) & 1 for j in range(3)]
        for i in range(3):
            rest = [j for j in range(3) if j != i]
            want = sum(
                factorial(k) * factorial(2 - k) / 6 * (game(pattern, {*s, i}) - game(pattern, set(s)))
                for k in range(3)
                for s in combinations(rest, k)
            )
            assert table[code, i] == pytest.approx(want)


def test_batch_scores(spark, sf_dir, scorer):
    rows = catalog.listings(spark, sf_dir)
    out = scorer.score(rows)
    r = out.agg(F.count("*"), F.min("fraud_score"), F.max("fraud_score")).first()
    assert r[0] == rows.count() and 0 <= r[1] and r[2] <= 1
    assert set(x["risk_tier"] for x in out.select("risk_tier").distinct().collect()) <= {"HIGH", "MEDIUM", "LOW"}


def test_svd_matches_numpy(spark, sf_dir):
    docs = catalog.documents(spark, sf_dir)
    model = tx.fit_vocabulary(docs, "doc_id", "text", max_features=60)
    weights = tx.tfidf(docs, "doc_id", "text", model).cache()
    fitted = tx.fit_svd(weights, "doc_id", model, components=5, iterations=30)
    pdf = weights.toPandas()
    dense = np.zeros((pdf["doc_id"].max() + 1, 60))
    dense[pdf["doc_id"], pdf["idx"]] = pdf["weight"]
    assert np.allclose(fitted.singular_values, np.linalg.svd(dense, compute_uv=False)[:5], rtol=1e-3)
    features = tx.svd_features(docs, "doc_id", "text", fitted)
    assert features.count() == docs.count()


def test_search_resumes(spark, sf_dir, tmp_path):
    path = str(tmp_path / "search")
    row = [(k, 0.1, 0.2 + k, 3, 0.1, 3, 10, 0.8, 0.8) for k in (0, 1)]
    spark.createDataFrame(row, mo.SEARCH_SCHEMA).write.parquet(path)
    out = mo.nested_search(catalog.labeled(spark, sf_dir), trials=1, outer=2, inner=2, checkpoint=path)
    assert out.count() == 2 and mo.best_of_search(out).trees == 3
