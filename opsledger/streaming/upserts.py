"""A table kept by key that streams update: change folders per micro-batch and a base that compactions renew.

``changes/batch_id=K`` holds what batch K changed, ``base/upto=N/_range=R`` the newest row per key of range R after
batch N. A range is a whole number that follows from the row, such as the day of its window; rows of one key stay in
one range. A folder counts once its ``_SUCCESS`` is there. The newest finished base is the pointer: readers
take, for each range, the newest base that has it, and the change folders of later batches only. A compaction rewrites
the ranges that its batches touched and leaves all others where they are, so old results are not written again.

Writing and compacting may be repeated at any time: both replace their own folder. A batch that is replayed after a
compaction that holds it changes nothing for readers.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from opsledger.operators.dedup import last_per_key
from opsledger.session import remove_dir
from opsledger.streaming.sinks import BatchWriter


def range_of(time: str, seconds: int) -> Column:
    """The number of the stretch of ``seconds`` that a zoned timestamp lies in."""
    return F.floor(F.unix_micros(time) / (seconds * 1_000_000)).cast("bigint")


@dataclass(frozen=True)
class UpsertTable:
    path: str
    schema: StructType
    keys: Sequence[str]
    ranges: Column | None = None
    compact_every: int = 8

    def writer(self) -> BatchWriter:
        """A micro-batch writer; every ``compact_every`` batches it compacts what came since the last base."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.put(batch, batch_id)
            if (batch_id + 1) % self.compact_every == 0:
                self.compact(batch.sparkSession, batch_id)

        return write

    def put(self, batch: DataFrame, batch_id: int) -> None:
        """The changed rows of one batch, one row per key; an empty batch leaves an empty folder."""
        rows = batch.select(*self._columns(), F.lit(batch_id).cast("bigint").alias("_batch"), self._range().alias("_range"))
        rows.write.mode("overwrite").partitionBy("_range").parquet(f"{self.path}/changes/batch_id={batch_id}")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Merges finished changes up to a batch into a new base of the ranges they touch; then drops what it replaces.

        The base before the new one and its changes stay for readers that have started.
        """
        before = max((n for n in self._done(spark, "base", "upto") if n < upto), default=-1)
        changed = [n for n in self._done(spark, "changes", "batch_id") if before < n <= upto]
        touched = {r for n in changed for r in self._ranges(spark, f"changes/batch_id={n}")}
        bases = self._bases(spark, before)
        paths = [f"changes/batch_id={n}/_range={r}" for n in changed for r in self._ranges(spark, f"changes/batch_id={n}")]
        paths += [f"base/upto={bases[r]}/_range={r}" for r in touched if r in bases]
        self._newest(self._read(spark, paths)).withColumn("_range", self._range()).write.mode("overwrite").partitionBy("_range") \
            .parquet(f"{self.path}/base/upto={upto}")
        for n in self._done(spark, "changes", "batch_id"):
            if n <= before:
                remove_dir(spark, f"{self.path}/changes/batch_id={n}")
        for n in self._done(spark, "base", "upto"):
            for r in self._ranges(spark, f"base/upto={n}") if n < before else ():
                if bases.get(r, -1) > n:
                    remove_dir(spark, f"{self.path}/base/upto={n}/_range={r}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of every key."""
        return self._newest(self._read(spark, self.sources(spark))).drop("_batch")

    def sources(self, spark: SparkSession) -> list[str]:
        """The folders a reader needs: one base per range and the changes since the last compaction."""
        newest = max(self._done(spark, "base", "upto"), default=-1)
        out = [f"base/upto={n}/_range={r}" for r, n in sorted(self._bases(spark, newest).items())]
        later = [n for n in self._done(spark, "changes", "batch_id") if n > newest]
        return out + [f"changes/batch_id={n}/_range={r}" for n in later for r in self._ranges(spark, f"changes/batch_id={n}")]

    def read_ordered(self, spark: SparkSession, order: Sequence[Column | str], descending: bool = False,
                     rows_per_task: int = 1_000_000) -> DataFrame:
        """The newest rows in order of ``ranges`` and then of ``order``, without sampling or sorting the whole.

        The rows per range tell which ranges a task takes: neighbours up to ``rows_per_task`` rows, or one
        larger range. ``order`` has to agree with the order of the ranges.
        """
        rows = self.read(spark).withColumn("_range", self._range())
        sizes = self._read(spark, self.sources(spark)).groupBy(self._range().alias("_range")).agg(F.count("*").alias("n"))
        way = F.col("_range").desc() if descending else F.col("_range")
        before = F.coalesce(F.sum("n").over(Window.orderBy(way).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        # one row per range
        dealt = sizes.select("_range", F.floor(before / rows_per_task).cast("int").alias("_task")).collect()
        tasks = {t: i for i, t in enumerate(sorted({r["_task"] for r in dealt}))}
        if not dealt:
            return rows.drop("_range")
        places = spark.createDataFrame([(r["_range"], tasks[r["_task"]]) for r in dealt], "_range bigint, _task int")
        placed = rows.join(F.broadcast(places), "_range").repartitionById(len(tasks), F.col("_task"))
        return placed.sortWithinPartitions(way, *order).select(*self._columns())

    def _range(self) -> Column:
        return self.ranges if self.ranges is not None else F.lit(0).cast("bigint")

    def _columns(self) -> list[str]:
        return [f.name for f in self.schema]

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema) + ", _batch bigint"
        return spark.read.schema(full).parquet(*[f"{self.path}/{p}" for p in paths]) if paths else spark.createDataFrame([], full)

    def _newest(self, rows: DataFrame) -> DataFrame:
        return last_per_key(rows, self.keys, ["_batch"], [*self._columns(), "_batch"]).select(*self._columns(), "_batch")

    def _bases(self, spark: SparkSession, upto: int) -> dict[int, int]:
        """For each range the newest finished base that has it."""
        return {r: n for n in self._done(spark, "base", "upto") if n <= upto for r in self._ranges(spark, f"base/upto={n}")}

    def _done(self, spark: SparkSession, part: str, name: str) -> list[int]:
        return sorted(_numbers(spark, f"{self.path}/{part}/{name}=*/_SUCCESS", name))

    def _ranges(self, spark: SparkSession, folder: str) -> list[int]:
        return sorted(_numbers(spark, f"{self.path}/{folder}/_range=*", "_range"))


def _numbers(spark: SparkSession, pattern: str, name: str) -> set[int]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    texts = [re.search(rf"/{name}=(-?\d+)(/|$)", s.getPath().toString()) for s in found]
    return {int(m[1]) for m in texts if m}
