"""Queries of the operators against their SQL, and held-out accuracy of the classifiers."""

import pytest

from listingguard.llm import queries as q
from tests import check


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_against_sql(spark, con, sf_dir, name):
    assert check.compare(q.queries()[name](spark, sf_dir), con, q.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name, label, least, most", [("op1_toxicity", "toxic", 0.8, 0.03), ("op7_quality", "quality", 0.95, 0.2)])
def test_held_out_accuracy(spark, name, label, least, most):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = q.queries()[name](spark, d).join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    good = [r.predicted for r in rows if r[label] == 1]
    bad = [r.predicted for r in rows if r[label] == 0]
    assert sum(good) / len(good) >= least and sum(bad) / len(bad) <= most


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in q.queries()} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
