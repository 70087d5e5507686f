"""Statistics of all folds from rows that are counted once equal those of a fit per fold."""

from functools import reduce

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.operators import features as fe
from listingguard.operators import models as mo
from listingguard.operators.ordered import column_medians

SCHEMA = (
    "listing_id string, fold int, price double, bed double, bath double, acre_lot double, house_size double, status string, state string, "
    "city string, zip_code string, prev_sold_date string, is_fraud int"
)


@pytest.fixture(scope="module")
def rows(spark):
    """Two copies of every row, keys and numbers that are null, a fold whose state nobody else has, a column without values."""
    rng = np.random.default_rng(11)
    out = []
    for i in range(400):
        c = int(rng.integers(0, 9))
        price = None if i % 13 == 0 else float(np.round(np.exp(rng.normal(8, 2)), 2))
        size = None if i % 7 == 0 else float(rng.integers(0, 40) * 100)
        place = (None if c == 8 else f"c{c}", None if i % 17 == 0 else f"z{c % 4}", [None, "not-a-date", f"199{i % 9}-0{1 + i % 9}-11"][i % 3])
        state = None if i % 19 == 0 else "only0" if c % 3 == 0 and i % 2 else f"s{i % 4}"
        out += 2 * [(f"l{i}", c % 3, price, float(i % 5), None if i % 11 == 0 else float(i % 3), None, size, f"t{i % 2}", state, *place, int(i % 10 == 0))]
    return spark.createDataFrame(out, SCHEMA)


def same(got, want, keys):
    a, b = (df.orderBy(*keys).collect() for df in (got.select(*want.columns), want))
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        for name, u, v in zip(want.columns, x, y):
            assert u == v or u == pytest.approx(v, rel=1e-9, abs=1e-12), (name, u, v)


def test_preprocessors_of_all_folds(rows):
    stats = fe.fit_left_out(rows, 3)
    once = fe.stateless_features(rows)
    seen = reduce(DataFrame.unionByName, [fe.apply_features(mo._in_fold(once, k), stats.of(k)) for k in range(3)]).where("is_train")
    got, want = fe.fit_left_out_preprocessor(once, seen, 3), fe.fit_preprocessor(seen, by=["cv_fold"])
    same(got.numbers, want.numbers, ["cv_fold"])
    same(got.modes, want.modes, ["cv_fold"])
    for c in want.categorical:
        same(got.codes[c], want.codes[c], ["cv_fold", c])
    assert got.numeric == want.numeric and got.by == want.by


def test_medians_of_small_and_large_keys_agree(rows, monkeypatch):
    tables = []
    for limit in (10_000, 0):
        monkeypatch.setattr(fe, "SMALL_KEY", limit)
        tables.append([fe.left_out_medians(rows, key, "price", 3, "m", 2) for key in ("city", "state")])
    for (small, large), key in zip(zip(*tables), ("city", "state")):
        same(small, large, ["cv_fold", key])


def test_column_medians_equal_numpy(spark):
    rng = np.random.default_rng(5)
    odd = [0.0, -0.0, float("nan"), None, -3.5, 1e300, 1e-300, 7.0, 7.0]
    data = [(i, odd[i] if i < len(odd) else float(1000 + rng.integers(0, 3000) / 1000), float(i % 2), None) for i in range(301)]
    df = spark.createDataFrame(data, "i int, a double, b double, empty double")
    measures = {"all": F.lit(True), "third": F.col("i") % 3 == 0, "low": F.col("i") < 9, "none": F.lit(False)}
    got = {(r["measure"], r["feature"]): r["mid"] for r in column_medians(df, ["a", "b", "empty"], measures).collect()}
    for name, on in {"all": lambda i: True, "third": lambda i: i % 3 == 0, "low": lambda i: i < 9}.items():
        a = [x[1] for x in data if on(x[0]) and x[1] is not None and x[1] == x[1]]
        assert got[name, "a"] == np.median(a) and got[name, "b"] == np.median([x[2] for x in data if on(x[0])])
    assert got["none", "a"] is None and got["none", "b"] is None and ("all", "empty") not in got


def test_fits_read_vectors_that_are_held(spark):
    """The fits read their input several times; none of these passes makes the vectors again."""
    matrix = spark.createDataFrame([(0, i % 2 == 0, f"l{i}", float(i % 4 // 2), [float(i), 1.0]) for i in range(40)], "cv_fold int, is_train boolean, listing_id string, label double, x array<double>")
    plans = []

    def fit(train):
        plans.append(train._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0])
        return mo.fit_logistic(train)

    assert mo.cross_validate(matrix, fit, "p", folds=1).count() == 20
    assert "InMemoryTableScan" in plans[0] and "UDF" not in plans[0]
