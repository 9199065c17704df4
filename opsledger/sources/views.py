"""DataFrames under SQL names."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame


@contextmanager
def views(**frames: DataFrame) -> Iterator[Callable[[str], DataFrame]]:
    """Register the frames as temporary views and yield ``spark.sql``; the names go away afterwards.

    A result keeps its own plan, so it stays valid when the names are gone.
    """
    spark = next(iter(frames.values())).sparkSession
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    try:
        yield spark.sql
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)
