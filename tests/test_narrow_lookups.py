"""Rows that no lookup needs are not moved for it, and nothing else changes."""

import pytest
from pyspark.sql import functions as F

from listingguard.config import RULES
from listingguard.operators import labelling as lab
from listingguard.operators import lookup
from listingguard.operators import retrieval as re_
from listingguard.plans import catalog
from listingguard.sources.stage import materialize


def _same(a, b) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filter_holds_every_key_and_few_others(spark):
    rows = [(float(i), f"z{i}") for i in range(500)] + [(-0.0, "zero"), (float("nan"), "nan")]
    table = materialize(spark.createDataFrame(rows, "a double, b string"), "keys")
    may = lookup.may_hold(table, ["a", "b"])
    assert table.where(may).count() == len(rows)
    assert spark.createDataFrame([(0.0, "zero"), (float("nan"), "nan")], "a double, b string").where(may).count() == 2
    others = spark.range(5000).select((F.col("id") + 0.5).alias("a"), F.lit("z1").alias("b"))
    assert others.where(may).count() < 1000
    null = spark.createDataFrame([(None, "z1"), (1.0, None)], "a double, b string")
    assert null.where(may).count() == 0 and null.where(~may).count() == 2


def test_duplicates_beside_a_large_table(spark, sf_dir, monkeypatch):  # F20, F26, F29
    rows = catalog.listings(spark, sf_dir)
    extra = rows.limit(3).withColumn("zip_code", F.lit(None).cast("string"))
    rows = materialize(rows.unionByName(extra), "some_rows")
    keys = materialize(lab.duplicate_keys(rows), "label_duplicates")
    want = materialize(lab.flag_duplicates(rows, keys=keys), "small_way")
    monkeypatch.setattr(lab, "fits_broadcast", lambda table: False)
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a: False)
    got = lab.flag_duplicates(rows, keys=keys)
    assert want.where("rule_duplicate = 1").count() > 0 and _same(want, got)


@pytest.mark.parametrize("rule", RULES)
def test_one_rule_alone_is_that_of_the_whole_table(spark, sf_dir, rule):  # F23
    assert _same(catalog.queries()[rule](spark, sf_dir), catalog.labeled(spark, sf_dir).select("listing_id", rule))


def test_rules_of_one_listing_join_nothing(spark, sf_dir):  # F23
    assert "Join" not in _plan(catalog.queries()["rule_impossible_dims"](spark, sf_dir))


def test_projection_is_not_stored_before(spark, sf_dir):  # F29
    got = catalog.queries()["model_projection"](spark, sf_dir)
    assert "labeled-" not in got._jdf.queryExecution().executedPlan().toString()
    assert _same(got, catalog.labeled(spark, sf_dir).select(*got.columns))


def test_explained_rows_meet_no_score_table(spark, sf_dir, monkeypatch):  # F18
    built = []
    monkeypatch.setattr(re_, "build_index", lambda *a: built.append(a))
    got = catalog.queries()["explain_context"](spark, sf_dir)
    assert got.count() == catalog.listings(spark, sf_dir).count() and not built
    joins = [line for line in _plan(got).splitlines() if "Join Inner" in line]
    assert not any("listing_id" in line for line in joins)


def test_few_terms_by_one_pass(spark):  # F18
    texts = [(i, f"alpha{i % 3} beta gamma{i % 5} Delta") for i in range(300)]
    texts += [(290, "extra omega"), (299, "omega"), (None, "omega beta"), (400, None), (401, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    asked = [("a", "alpha1 omega"), ("b", "gamma2 delta zeta"), ("c", "nothing9"), ("d", ""), (None, "beta omega"), ("e", "beta"), ("e", "omega")]
    queries = spark.createDataFrame(asked, "k string, text string")
    one_pass = re_.best_scores(docs, queries, ["k"], 4, head=16)
    indexed = re_.best_scores(docs, queries, ["k"], 4, head=16, index=re_.build_index(docs))
    assert indexed.count() > 8 and _same(one_pass, indexed)
