"""Lookup tables that change while a stream runs."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from opsledger.operators import joins


@dataclass(frozen=True)
class VersionedLookup:
    """Snapshots of a lookup in ``tables/version=V`` and, in ``used/batch_id=K``, the version that batch K met.

    The first run of a batch takes the newest finished snapshot and records it before anything is written; a
    replay reads the record, so it gives the same rows although the lookup has changed since.
    """

    path: str
    key: str

    def publish(self, table: DataFrame) -> int:
        """Stores the next snapshot and returns its version."""
        version = max(self.versions(table.sparkSession), default=-1) + 1
        table.write.parquet(f"{self.path}/tables/version={version}")
        return version

    def versions(self, spark: SparkSession) -> list[int]:
        return sorted(_finished(spark, f"{self.path}/tables/version=*/_SUCCESS"))

    def version_of(self, spark: SparkSession, batch_id: int) -> int:
        """The recorded version of a batch; the newest one is recorded at first."""
        record = f"{self.path}/used/batch_id={batch_id}"
        if not _finished(spark, f"{record}/_SUCCESS"):
            newest = self.versions(spark)[-1]
            spark.createDataFrame([(newest,)], "version bigint").write.mode("overwrite").parquet(record)
        return spark.read.schema("version bigint").parquet(record).first()["version"]

    def attach(self, batch: DataFrame, batch_id: int, how: str = "left") -> DataFrame:
        """The batch with the lookup's columns as of its version; broadcast or shuffle is chosen for this snapshot."""
        spark = batch.sparkSession
        table = spark.read.parquet(f"{self.path}/tables/version={self.version_of(spark, batch_id)}")
        return joins.lookup(batch, table, self.key, how=how)

    def through(self, write: Callable[[DataFrame, int], None], then: Callable[[DataFrame], DataFrame] | None = None):
        """A micro-batch writer that attaches the lookup, applies ``then`` and hands the rows on."""

        def attached(batch: DataFrame, batch_id: int) -> None:
            rows = self.attach(batch, batch_id)
            write(then(rows) if then else rows, batch_id)

        return attached


def _finished(spark: SparkSession, pattern: str) -> set[int]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    return {int(re.search(r"=(\d+)/_SUCCESS$", s.getPath().toString())[1]) for s in found}
