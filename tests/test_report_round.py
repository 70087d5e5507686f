"""Reported rounding: the quick way gives what the decimal way gives, bit for bit."""

import pytest
from pyspark.sql import functions as F

from listingguard.functions.exprs import report_round


@pytest.mark.parametrize("digits", [0, 2, 3, 4, 6, 8])
def test_same_as_by_decimal(spark, digits):
    edge = [0.0, -0.0, 0.5, -0.5, 2.5, 1.005, 0.125, -0.125, 1e-9, -1e-9, 0.0000005, 0.00000049999, 0.4999999999, 123456789.987654, 5e8, -7e12, None]
    edge += [k + t for k in (0.0, 3.0, -8.0) for t in (0.5 * 10**-digits, 0.5 * 10**-digits - 4e-9, 0.5 * 10**-digits + 4e-9)]
    rows = spark.createDataFrame([(v,) for v in edge], "x double")
    some = spark.range(200_000).select((F.randn(7) * F.pow(F.lit(10.0), F.rand(8) * 14 - 6)).alias("x"))
    ties = spark.range(20_000).select(((F.col("id") - 10_000 + 0.5) / 10**digits).alias("x"))
    both = rows.unionByName(some).unionByName(ties)
    slow = F.round(F.col("x").cast("decimal(38,8)"), digits).cast("double")
    got = both.select("x", report_round("x", digits).alias("a"), slow.alias("b"))
    bad = got.where(~F.col("a").cast("string").eqNullSafe(F.col("b").cast("string")))
    assert bad.take(3) == []


def test_most_numbers_take_the_quick_way(spark):
    plan = spark.range(1).select(report_round(F.col("id") / 3, 4))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan
