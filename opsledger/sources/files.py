"""Batch readers: text lines, JSON rows, header CSV, and header clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in ``value``."""
    return spark.read.text(path)


def read_ordered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with a sortable ``position`` (file, block, line order) for last-one-wins files."""
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("position"),
    )


def read_json_rows(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """JSON lines with a declared schema: no inference pass over the data."""
    return spark.read.schema(schema).json(path)


def read_header_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header row, every column text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def clean_header(df: DataFrame) -> DataFrame:
    """Blanks in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def bind(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a record type; values that do not cast become NULL."""
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
