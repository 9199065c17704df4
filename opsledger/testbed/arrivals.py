"""Stream input that arrives piece by piece: what a source would deliver over time, cut from a finished table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SLICES = 4


def slice_of(events: DataFrame, slices: int = SLICES, late: Column | None = None, by: int = 2) -> DataFrame:
    """Events with their ``slice`` 0..slices-1 in order of time; late ones arrive ``by`` slices later."""
    second = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    first, last = events.agg(F.min(second), F.max(second)).first()
    if first is None:
        return events.withColumn("slice", F.lit(0))
    due = F.floor((second - first) * slices / (last - first + 1)).cast("int")
    return events.withColumn("slice", due if late is None else F.when(late, F.least(due + by, F.lit(slices - 1))).otherwise(due))


def deliver(sliced: DataFrame, folder: str, run: Callable[[int], None], slices: int = SLICES) -> None:
    """Writes slice after slice, each by as many tasks as the input has, and runs the stream to its end in between."""
    for i in range(slices):
        sliced.where(F.col("slice") == i).drop("slice").write.parquet(f"{folder}/slice{i}")
        run(i)


def in_order(df: DataFrame, time: str, folder: str, files: int) -> None:
    """The ``value`` of rows as text files by time, each written by a task of its own, aged in the order of their content."""
    df.repartitionByRange(files, time).select("value").write.text(folder)
    context = df.sparkSession.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
    store = where.getFileSystem(context._jsc.hadoopConfiguration())
    found = sorted((s.getPath() for s in store.globStatus(where)), key=lambda p: p.getName())
    begin = context._jvm.java.lang.System.currentTimeMillis() - 1000 * len(found)
    for i, path in enumerate(found):     # a file stream takes files by age
        store.setTimes(path, begin + 1000 * i, -1)
