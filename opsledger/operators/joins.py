"""Lookup joins that check a side before broadcasting it, and joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from opsledger.session import checkpointed

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the frame has at most ``max_rows`` rows and ``max_bytes`` bytes; reads no more than one row beyond that.

    Every column counts as eight bytes, text and binary ones with their content too.
    """
    size = F.lit(8 * len(df.columns))
    for f in df.schema:
        if not isinstance(f.dataType, (NumericType, BooleanType, DatetimeType)):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
    row = df.limit(max_rows + 1).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes")).first()
    return row["rows"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# most items that the sketch of frequent keys can follow
SKETCH_ITEMS = 1_000_000


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys holding more than an even share of a shuffle partition; there are fewer of them than partitions.

    Found with a mergeable sketch over the key alone, as large as the number of partitions asks for, or
    exactly in two passes where the sketch would need more than it can hold. The list only decides how rows travel,
    never which rows are kept.
    """
    parts = _partitions(df)
    keys = df.select(key).where(F.col(key).isNotNull())
    if 40 * parts > SKETCH_ITEMS:
        return _hot_keys_by_range(keys, key, parts)
    sketch = keys.agg(
        F.expr(f"approx_top_k(`{key}`, {parts}, {max(10_000, 40 * parts)})").alias("top"),
        F.count("*").alias("total"),
    )
    return (
        sketch.select(F.explode("top").alias("entry"), "total")
        .where(F.col("entry.count") * parts > F.col("total"))
        .select(F.col("entry.item").alias(key))
    )


def _hot_keys_by_range(keys: DataFrame, key: str, parts: int) -> DataFrame:
    """Hash ranges that hold more than a partition's share are the only ones with hot keys; keys are counted in them."""
    ranged = keys.withColumn("_range", F.pmod(F.xxhash64(key), F.lit(4 * parts)))
    sizes = checkpointed(ranged.groupBy("_range").agg(F.count("*").alias("_rows")))
    total = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    heavy = sizes.where(F.col("_rows") * parts > total).select("_range")
    inside = ranged.join(F.broadcast(heavy) if is_small(heavy) else heavy, "_range", "left_semi")
    return inside.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") * parts > total).select(key)


def skew_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", keys: DataFrame | None = None) -> DataFrame:
    """Join on one key where a few fact keys may be very hot and ``dim`` has few rows per key.

    Fact rows of a hot key are dealt out evenly over ``salts`` shares, and the key's dimension rows are repeated once
    per share, so the fact is read once and joined once. Rows without a key match nothing and are dealt out too.
    ``how`` is ``inner`` or ``left``. ``keys`` are rows to look for hot keys in instead of ``fact``: stored ones that it is made from.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    # stored once: both sides have to agree on which keys are hot
    hot = checkpointed(hot_keys(fact if keys is None else keys, key))
    if how == "inner" and hot.isEmpty():
        return fact.join(dim, key)
    salts = _partitions(fact)
    marked = F.broadcast(hot.select(key, F.lit(True).alias("_hot")))
    spread = F.col("_hot").isNotNull() | F.col(key).isNull()
    share = F.when(spread, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).otherwise(0)
    facts = fact.join(marked, key, "left").withColumn("_salt", share).drop("_hot")
    shares = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    dims = dim.join(marked, key, "left").withColumn("_salt", F.explode(shares)).drop("_hot")
    return facts.join(dims, [key, "_salt"], how).drop("_salt")


def lookup(fact: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, Any] | None = None,
           how: str = "left", max_rows: int = BROADCAST_ROWS, keys: DataFrame | None = None) -> DataFrame:
    """Attach dimension columns by key (unique in ``dim``), keeping unmatched rows.

    The dimension is broadcast after its rows and bytes were checked; a larger one is joined by shuffle with
    hot keys salted. Works for a stream with a static dimension too; the side is checked when the stream starts,
    so restart the stream after the dimension has grown.
    """
    if is_small(dim, max_rows):
        out = fact.join(F.broadcast(dim), key, how)
    elif fact.isStreaming:
        out = fact.join(dim, key, how)
    else:
        out = skew_join(fact, dim, key, how, keys)
    for column, value in (defaults or {}).items():
        out = out.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
    return out


def count_missing(left: DataFrame, right: DataFrame, key: str, also: Sequence[str] = ()) -> DataFrame:
    """Occurrences on the left of keys the right side does not have.

    The left is counted before the anti join, so each key crosses the network once per task.
    """
    counted = left.groupBy(key, *also).agg(F.count("*").alias("occurrences"))
    return counted.join(right.select(key).distinct(), key, "left_anti")
