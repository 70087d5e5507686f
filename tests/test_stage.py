"""The stage layer without a checkpoint folder, under concurrency, and when the data under a path changes."""

import os
import subprocess
import sys
import textwrap
import threading

from listingguard.sources import stage as st


def test_unset_checkpoint_folder_ends(tmp_path):
    code = """
        import __spark_entry__ as e
        from listingguard.session import local_session
        spark = local_session(4, memory="4g")
        assert not spark.conf.get("spark.checkpoint.dir", None)
        print("ROWS", e.queries()["score_distribution"](spark, "/root/testdata/sf0.001").count())
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], cwd=root, capture_output=True, text=True, timeout=240,
        env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)},  # plain Spark: no site settings
    )
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_two_stages_build_side_by_side(spark):
    """Each build waits until the other has begun; a lock held across builds would time out."""
    begun = [threading.Event(), threading.Event()]

    def build(own, other):
        begun[own].set()
        assert begun[other].wait(30)
        return spark.range(3)

    out = st.in_parallel(
        lambda: st.stage(spark, "/nowhere", "side_a", lambda: build(0, 1)),
        lambda: st.stage(spark, "/nowhere", "side_b", lambda: build(1, 0)),
    )
    assert [x.count() for x in out] == [3, 3]


def test_changed_files_are_read_again(spark, tmp_path):
    path = str(tmp_path / "in")

    def rows():
        return st.stage(spark, path, "changing", lambda: spark.read.parquet(path)).count()

    spark.range(2).write.parquet(path)
    assert rows() == 2
    spark.range(3).write.mode("append").parquet(path)
    assert rows() == 5


def test_failed_build_is_tried_again(spark):
    def fail():
        raise RuntimeError("first")

    try:
        st.stage(spark, "/nowhere", "failing", fail)
    except RuntimeError:
        pass
    assert st.stage(spark, "/nowhere", "failing", lambda: spark.range(1)).count() == 1
