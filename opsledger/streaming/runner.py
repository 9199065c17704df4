"""Starting streams: one function for scheduled and for run-to-end processing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from opsledger.streaming.sinks import BatchWriter

PROGRESS = "batch_id bigint, input_rows bigint, late boolean"


def event_time(df: DataFrame, column: str, delay: str | None) -> DataFrame:
    """The column as TIMESTAMP (watermarks need the zoned type), with a watermark if asked."""
    typed = df.withColumn(column, F.col(column).cast("timestamp"))
    return typed if delay is None else typed.withWatermark(column, delay)


def start(df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append",
          every: str | None = None) -> StreamingQuery:
    """Run continuously with a trigger interval, or to the end of the available data without one."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def show(df: DataFrame, mode: str = "complete", every: str | None = None, rows: int = 20,
         fmt: str = "console", name: str | None = None) -> StreamingQuery:
    """Print (or keep in memory under ``name``) the result of every micro-batch; for looking, not for storing."""
    writer = df.writeStream.outputMode(mode).format(fmt)
    writer = writer.option("numRows", rows) if fmt == "console" else writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_to_end(df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append") -> list[dict]:
    """Process all available data and stop; a failure of the stream is raised here.

    Returns one row per batch of this run: ``batch_id``, rows read, and whether the watermark dropped rows in it.
    """
    query = start(df, write, checkpoint, mode)
    query.awaitTermination()
    return [{"batch_id": p.batchId, "input_rows": p.numInputRows,
             "late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators) > 0} for p in query.recentProgress]


def store_progress(spark: SparkSession, progress: list[dict], path: str) -> None:
    """The batches of a run next to its result; Spark remembers a bounded number of batches per run."""
    rows = [(p["batch_id"], p["input_rows"], p["late"]) for p in progress]
    spark.createDataFrame(rows, PROGRESS).write.mode("append").parquet(path)
