"""Places in an order and dense integer ids, without collecting keys anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsledger.session import new_run_dir

# monotonically_increasing_id: the part's number above, the row's place in its part below
PLACE_BITS = 33


def ordered_positions(df: DataFrame, order: Sequence[Column | str], position: str = "position") -> DataFrame:
    """The rows with their place 0..n-1 in the order, as bigint, however many rows there are.

    The rows are cut into sorted ranges and stored once with their place inside the range; a range starts where the
    ones before it end. Only the number of rows per range meets in one task. Rows that are equal in the order get
    places next to each other. ``order`` should tell most rows apart: rows that it does not cannot be cut.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, "ordered")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path).withColumn("_range", F.shiftright("_place", PLACE_BITS))
    sizes = stored.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_place").bitwiseAND((1 << PLACE_BITS) - 1)
    # one row per range: never more than there are shuffle partitions
    return stored.join(F.broadcast(starts), "_range").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + inside).alias(position))


def dense_index(df: DataFrame, key: str, index: str) -> DataFrame:
    """``key -> index`` for the keys in their order: indexes 0..n-1 as bigint, no collisions, no null key."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return ordered_positions(keys, [key], index)
