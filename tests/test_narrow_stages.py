"""Stages carry no more than their readers need, and scores reach their listings without joining all listings with themselves."""

from pyspark.sql import functions as F

from listingguard.operators import predlog as pl
from listingguard.plans import catalog
from listingguard.sources import tables as tb


def _copies(spark, sf_dir, tmp_path, repeat):
    """A folder of the listing tables; ``repeat`` doubles the lines of some orders."""
    for name in ("lineitem", "orders", "customer", "nation", "part"):
        rows = tb.table(spark, sf_dir, name)
        if repeat and name == "lineitem":
            rows = rows.unionByName(rows.where("l_orderkey % 5 = 0"))
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _joined(spark, d):
    return pl.log_rows(tb.scored(spark, d), tb.listings(spark, d))


def test_repeated_listings_meet_each_others_scores(spark, sf_dir, tmp_path):
    d = _copies(spark, sf_dir, tmp_path, True)
    got, want = catalog.prediction_log(spark, d), _joined(spark, d)
    assert got.count() == want.count() > tb.listings(spark, d).count()
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_unique_listings_are_not_joined(spark, sf_dir, tmp_path):
    d = _copies(spark, sf_dir, tmp_path, False)
    got = tb.with_scores(spark, d, tb.listings(spark, d), ["p_a", "p_b"])
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert pl.scored_log_rows(got).exceptAll(_joined(spark, d)).count() == 0


def test_narrow_labels_are_those_of_the_whole_table(spark, sf_dir):
    whole, facts, keyed = (f(spark, sf_dir) for f in (catalog.labeled, catalog.labeled_facts, catalog.labeled_keyed))
    assert set(whole.columns) - set(facts.columns) == {"listing_id", *catalog.LONG}
    for part in (facts, keyed):
        assert part.exceptAll(whole.select(*part.columns)).count() == 0 == whole.select(*part.columns).exceptAll(part).count()


def test_lines_are_dealt_out_for_orders_once(spark, sf_dir):
    sets = {n: F.broadcast(tb.table(spark, sf_dir, n)) if n == "nation" else tb.table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "part")}
    plain = spark.sql(tb.LISTINGS_SQL, **sets)
    built = tb.build_listings(spark, sf_dir)
    assert built.columns == plain.columns
    assert built.exceptAll(plain).count() == plain.exceptAll(built).count() == 0
