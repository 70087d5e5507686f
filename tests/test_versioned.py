"""Registry commits, repeated appends and pages by key."""

import threading

import pytest
from pyspark.sql import functions as F

from listingguard.operators import predlog as pl
from listingguard.plans import catalog
from listingguard.sources import versioned as vs


def test_two_registrations_at_once_leave_one_active_row(spark, sf_dir, tmp_path):
    store = vs.SnapshotTable(spark, str(tmp_path / "registry"))
    store.change(lambda now: catalog.registry(spark, sf_dir))
    both_read = threading.Barrier(2, timeout=60)
    base = catalog.new_model(spark, sf_dir)
    versions = []

    def register(n):
        new = base.withColumn("id", F.lit(100 + n).cast("bigint")).withColumn("version", F.lit(f"9.{n}"))
        tries = []

        def make(now):
            tries.append(1)
            if len(tries) == 1:
                both_read.wait()  # both start from the same version
            return pl.register(now, new)

        versions.append(store.change(make))

    threads = [threading.Thread(target=register, args=(n,)) for n in (1, 2)]
    [t.start() for t in threads]
    [t.join(120) for t in threads]
    assert sorted(versions) == [2, 3] and store.version() == 3
    rows = store.read()
    assert rows.count() == catalog.registry(spark, sf_dir).count() + 2
    assert rows.where("is_active").count() == 1
    assert store.read(1).count() == catalog.registry(spark, sf_dir).count()


def test_first_registration_and_conflicts(spark, sf_dir, tmp_path):
    store = vs.SnapshotTable(spark, str(tmp_path / "registry"))
    assert store.read() is None and store.version() == 0
    assert pl.register_committed(store, catalog.new_model(spark, sf_dir)) == 1
    assert pl.active(store.read()).count() == 1
    # someone else is always faster
    with pytest.raises(vs.CommitConflict):
        store.change(lambda now: (store._commit(store.version() + 1, "x"), now)[1] if store.version() == 1 else now, attempts=1)


def test_repeated_append_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "id long, text string")
    vs.append_batch(rows.where("id < 5"), path, "a/b=1")
    vs.append_batch(rows.where("id >= 5"), path, "2")
    vs.append_batch(rows.where("id >= 5"), path, "2")
    assert sorted(r.id for r in vs.read_batches(spark, path).collect()) == list(range(10))
    vs.append_batch(rows.where("id = 7"), path, "2")  # a corrected batch replaces its rows
    assert sorted(r.id for r in vs.read_batches(spark, path).collect()) == [0, 1, 2, 3, 4, 7]


def test_pages_by_key_are_the_sorted_log(spark, sf_dir):
    log = catalog.clustered_log(spark, sf_dir)
    want = [(r["created_at"], r["id"]) for r in log.orderBy(F.desc("created_at"), "id").select("created_at", "id").collect()]
    last, got = None, []
    for _ in range(13):
        rows = pl.page_after(log, 500, last).select("created_at", "id").collect()
        got += [(r["created_at"], r["id"]) for r in rows]
        last = got[-1]
    assert got == want[: len(got)] and len(got) == min(6500, len(want))
    assert pl.page_after(log, 500, want[-1]).collect() == []
    plan = pl.page_after(log, 50, want[len(want) // 2])._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "LessThanOrEqual(created_at" in plan
    with pytest.raises(ValueError):
        pl.page_after(log, 501)
