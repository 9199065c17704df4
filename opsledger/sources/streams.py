"""One options-driven stream source: directories of text or Parquet, and message brokers.

A broker source needs its connector on the class path; offline runs read the same
``(topic, value, timestamp, key)`` records from files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RECORD_COLUMNS = ("topic", "value", "timestamp", "key")


def broker_options(servers: str, topics: Sequence[str], starting: str = "latest",
                   fail_on_data_loss: bool = False) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def read_stream(spark: SparkSession, fmt: str, path: str | None = None,
                schema: StructType | str | None = None,
                options: Mapping[str, str] | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def line_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Text files dropped into a folder, one row per line."""
    return read_stream(spark, "text", path, options=options)


def table_stream(spark: SparkSession, folder: str, table: str, **options: str) -> DataFrame:
    """A Parquet table, one file or a folder of part files, as a stream; new part files arrive as new data."""
    path = f"{folder}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return read_stream(spark, "parquet", path, schema, options)
    # a stream starts from a folder; this file is the only one whose name fits
    return read_stream(spark, "parquet", folder, schema, {"pathGlobFilter": f"{table}.parquet"} | options)


def record_stream(df: DataFrame) -> DataFrame:
    """Broker or file records with the four columns as text and a real timestamp."""
    return df.selectExpr(
        "CAST(topic AS STRING) AS topic",
        "CAST(value AS STRING) AS value",
        "CAST(timestamp AS TIMESTAMP) AS timestamp",
        "CAST(key AS STRING) AS key",
    )
