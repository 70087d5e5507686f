"""Edge cases: constant columns, missing prices, three-column keys, tail probabilities, deep tree paths."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from listingguard.operators import explain as ex
from listingguard.operators import explore as eda
from listingguard.operators import labelling as lab
from listingguard.operators import models as mo
from listingguard.plans import catalog


def test_constant_column_in_rank_test(spark, sf_dir):
    rows = catalog.labeled(spark, sf_dir).withColumn("bed", F.lit(3.0))
    got = {r.feature: r for r in eda.mann_whitney(rows).collect()}
    assert got["bed"].p_value == 1.0 and not got["bed"].significant
    assert eda.eda_summary(rows).count() > 0


def test_erfc_far_out(spark):
    xs = [0.0, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 26.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", eda.erfc(F.col("x")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(math.erfc(r.x), rel=2e-7)


def test_three_column_duplicate_rule(spark):
    rows = [(i, 3.0, 2.0, 1500.0 + i % 2, 100.0 + i) for i in range(6)] + [(9, 4.0, 2.0, 900.0, 5.0), (10, None, 2.0, 900.0, 6.0)]
    df = spark.createDataFrame(rows, "listing_id int, bed double, bath double, house_size double, price double")
    got = {r.listing_id: r.rule_duplicate for r in lab.flag_duplicates(df).collect()}
    assert got == {**{i: 1 for i in range(6)}, 9: 0, 10: 0}
    assert {r.rule_duplicate for r in lab.flag_duplicates(df.drop("bed")).collect()} == {0}


def test_batch_without_prices(spark, sf_dir):
    rows = catalog.listings(spark, sf_dir).limit(50).withColumn("price", F.lit(None).cast("double"))
    got = lab.label_table(rows).agg(F.max("rule_price_low"), F.max("rule_price_high"), F.count("*")).first()
    assert tuple(got) == (0, 0, 50)


def test_one_label_is_a_clear_error():
    with pytest.raises(ValueError, match="both labels"):
        mo.scale_pos_weight(10, 0)


def plain_shapley(leaf, code):
    d = len(leaf.features)
    on = [(code >> j) & 1 for j in range(d)]

    def value(subset):
        return leaf.value * math.prod(on[j] if j in subset else leaf.shares[j] for j in range(d))

    out = []
    for i in range(d):
        rest = [j for j in range(d) if j != i]
        total = 0.0
        for n in range(d):
            weight = math.factorial(n) * math.factorial(d - 1 - n) / math.factorial(d)
            total += sum(weight * (value({*s, i}) - value(set(s))) for s in combinations(rest, n))
        out.append(total)
    return out


@pytest.mark.parametrize("d", [1, 2, 5, 7])
def test_leaf_values_against_all_coalitions(d):
    rng = np.random.default_rng(d)
    leaf = ex.Leaf(1.7, tuple(range(d)), (0.0,) * d, (1.0,) * d, tuple(rng.uniform(0.1, 0.9, d)))
    codes = np.arange(2**d)
    got = ex.pattern_values(leaf, codes)
    for c in codes[:: max(1, len(codes) // 16)]:
        assert got[c] == pytest.approx(plain_shapley(leaf, int(c)))


def test_deep_paths_add_up():
    """Depth 30, where a table of all patterns could not exist: contributions add up to the leaf's value less its base."""
    d = 30
    leaf = ex.Leaf(2.0, tuple(range(d)), (0.0,) * d, (1.0,) * d, tuple(np.linspace(0.3, 0.95, d)))
    codes = np.array([0, 2**d - 1, 12345678])
    got = ex.pattern_values(leaf, codes).sum(1)
    inside = np.array([all((c >> j) & 1 for j in range(d)) for c in codes.tolist()])
    assert got == pytest.approx(2.0 * inside - 2.0 * np.prod(leaf.shares))
