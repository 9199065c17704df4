"""Tables, stored frames and checked broadcasts used by the operators of this folder."""

from __future__ import annotations

import pickle

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsledger.session import new_run_dir

BATCH_ROWS = 1000
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows and 4 MB, so long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def store(df: DataFrame, label: str) -> DataFrame:
    """The frame computed once, written to the shared folder and read from there, with its lineage cut."""
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a stored frame of fixed-width or name columns with few rows; else the frame as it is.

    The count reads at most ``rows`` + 1 rows. Without the hint, adaptive execution splits skewed join sides.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bucket_of_id(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def pieces(texts: list, limit: int = 1 << 20):
    """Ranges of the list whose texts have about ``limit`` characters together; one longer text stands alone."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > begin and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def shipped(spark: SparkSession, model: object) -> Broadcast:
    """A model of bounded size for all tasks, as bytes that a worker without this folder can open."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def opened(parcel: Broadcast):
    """The model, opened once by each worker process."""
    if not hasattr(parcel, "opened_model"):
        parcel.opened_model = pickle.loads(parcel.value)
    return parcel.opened_model
