"""Stage tables: results written once to the shared working folder and read back.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, a local master gets a private
temporary folder and any other master an error, since executors there do not share a local disk. A written stage cuts
lineage and survives the loss of executors, and its size is known to the planner from the files. The stages of an
application are deleted when its driver ends.
"""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

_dirs: dict[str, str] = {}
_memo: dict[tuple[str, str, str, str], Future] = {}
_lock = threading.Lock()  # guards the two tables above; no job runs under it


def work_dir(spark: SparkSession) -> str:
    """The folder of this application's stages."""
    app = spark.sparkContext.applicationId
    with _lock:
        if app not in _dirs:
            base = spark.conf.get("spark.checkpoint.dir", None)
            if not base:
                master = spark.sparkContext.master
                if not (master == "local" or master.startswith("local[")):
                    raise ValueError(f"set spark.checkpoint.dir to a shared folder; master {master} shares no local disk")
                base = tempfile.mkdtemp(prefix="listingguard-")
            _dirs[app] = f"{base.rstrip('/')}/listingguard/{app}"
            atexit.register(_clean, spark, _dirs[app])
        return _dirs[app]


def _clean(spark: SparkSession, path: str) -> None:
    """Delete an application's stages; a session that has ended already leaves them to the owner of the folder."""
    if spark.sparkContext._jsc is not None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def contents(spark: SparkSession, source: str) -> str:
    """Names, lengths and change times of the files under a folder; changed data gives another text."""
    root = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return ""
    found, todo = [], [root]
    while todo:
        for s in files.listStatus(todo.pop()):
            if s.isDirectory():
                todo.append(s.getPath())
            else:
                found.append(f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}")
    return "|".join(sorted(found))


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a parquet stage and return a scan of it.

    ``group_rows`` bounds the rows of a row group, for rows of megabytes: the writer looks at the size of a group every 100 rows only, and
    reads take a group at once.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").option("compression", "zstd")  # ids are random text, which snappy leaves as long as it is
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, source: str, name: str, build: Callable[[], T]) -> T:
    """The result ``name`` of one source folder, built at its first use and again when the folder's files have changed.

    Callers of the same result wait for the one that builds it; no lock is held meanwhile.
    """
    key = (spark.sparkContext.applicationId, source, name, contents(spark, source))
    with _lock:
        mine = key not in _memo
        ready = _memo.setdefault(key, Future())
    if mine:
        try:
            ready.set_result(build())
        except BaseException as err:
            with _lock:
                del _memo[key]  # the next caller tries again
            ready.set_exception(err)
            raise
    return ready.result()


def stage(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``once`` for a table, which is written."""
    return once(spark, source, name, lambda: materialize(build(), name))


def in_parallel(*jobs: Callable[[], object], threads: int = 8) -> list:
    """Submit independent Spark jobs at the same time, so that short stages fill the cluster together."""
    with ThreadPoolExecutor(max_workers=min(threads, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]
