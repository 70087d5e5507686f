"""Tables that several writers change: snapshots with an optimistic commit, and appends that can be repeated.

A snapshot table is a folder of immutable data folders and one marker file per version, made only if it is absent; whoever makes the
marker has committed that version, and whoever finds it made starts again from the new state. Readers follow the highest marker.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CommitConflict(RuntimeError):
    """Other writers were faster in every attempt."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _file(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def version(self) -> int:
        """The latest committed version; 0 before the first."""
        files, folder = self._file("commits")
        if not files.exists(folder):
            return 0
        return max((int(s.getPath().getName()) for s in files.listStatus(folder) if s.getPath().getName().isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, the latest by default; None before the first commit."""
        v = self.version() if version is None else version
        if v == 0:
            return None
        folder = self.spark.read.text(f"{self.path}/commits/{v:010d}").first()["value"]
        return self.spark.read.parquet(f"{self.path}/data/{folder}")

    def _commit(self, version: int, folder: str) -> bool:
        files, marker = self._file(f"commits/{version:010d}")
        try:
            out = files.create(marker, False)  # fails where the file is there already
        except Py4JJavaError as err:
            if files.exists(marker):
                return False
            raise err
        out.write(bytearray(folder.encode()))
        out.close()
        return True

    def change(self, make: Callable[[DataFrame | None], DataFrame], attempts: int = 10) -> int:
        """Commit ``make(latest rows)`` as the next version and return its number; repeated from the new state if another writer came first."""
        for _ in range(attempts):
            v = self.version()
            folder = uuid.uuid4().hex
            make(self.read(v)).write.parquet(f"{self.path}/data/{folder}")
            if self._commit(v + 1, folder):
                return v + 1
        raise CommitConflict(f"{attempts} attempts to change {self.path} met other commits")


def append_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """Add the rows of one batch. The same batch again replaces its own rows and no others."""
    batch = df.withColumn("batch_id", F.lit(batch_id))
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")
