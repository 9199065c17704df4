"""Micro-batch writers that can be replayed, and readers for what they wrote."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from opsledger.operators.dedup import last_per_key
from opsledger.session import remove_dir

BatchWriter = Callable[[DataFrame, int], None]


def batch_table(path: str, topics: Sequence[str] | None = None, skip_empty: bool = True,
                fmt: str = "parquet", prepare: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """One folder ``batch_id=N`` per micro-batch; replaying a batch replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = prepare(batch) if prepare else batch
        if topics is not None:
            out = out.where(F.col("topic").isin(*topics))
        out = out.persist()
        try:
            if not (skip_empty and out.isEmpty()):
                out.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")
        finally:
            out.unpersist()

    return write


def external_table(fmt: str, options: Mapping[str, str], topics: Sequence[str] | None = None) -> BatchWriter:
    """Append each micro-batch to a table that itself upserts by key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch if topics is None else batch.where(F.col("topic").isin(*topics))
        out.write.format(fmt).options(**dict(options)).mode("append").save()

    return write


def latest_table(path: str) -> BatchWriter:
    """Complete-mode results: each micro-batch writes the whole table into a folder of its own.

    Readers take the newest finished folder (:func:`read_newest`), so none sees a half-written table; the one before
    it stays for readers that have started, older ones are removed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        for old in _finished(batch.sparkSession, path):
            if old < batch_id - 1:
                remove_dir(batch.sparkSession, f"{path}/batch_id={old}")

    return write


def _finished(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batches whose folders are complete, ascending."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(int(s.getPath().getParent().getName().partition("=")[2]) for s in found)


def read_newest(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest complete table written by :func:`latest_table`; empty before the first."""
    done = _finished(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch_id={done[-1]}")


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """Everything written by :func:`batch_table`, with its ``batch_id``."""
    full = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + ["batch_id bigint"])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)      # no batch has written anything yet


def read_latest(spark: SparkSession, path: str, schema, keys: Sequence[str]) -> DataFrame:
    """Update-mode results: per key, the row of the newest batch that emitted it."""
    columns = [f.name for f in schema]
    return last_per_key(read_batches(spark, path, schema), keys, ["batch_id"], columns).select(*columns)
