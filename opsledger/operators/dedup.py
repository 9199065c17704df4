"""One row per key by a total order, as a mergeable aggregate.

``min``/``max`` of a struct collapses each key inside every map task before the shuffle, so a key
holding a third of all rows costs no more than any other. (A ranking window would send the whole
key to one task.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
          keep: Sequence[str] | None, choose) -> DataFrame:
    wanted = [c for c in (keep if keep is not None else df.columns) if c not in keys]
    fields = list(order_by) + [c for c in wanted if c not in order_by]
    best: Column = choose(F.struct(*fields))
    picked = df.groupBy(*keys).agg(best.alias("_best"))
    return picked.select(*keys, *[F.col("_best")[c].alias(c) for c in wanted])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  keep: Sequence[str] | None = None) -> DataFrame:
    """The row that sorts first for each key; equal rows of ``order_by`` fall back to the other columns."""
    return _pick(df, keys, order_by, keep, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 keep: Sequence[str] | None = None) -> DataFrame:
    """The row that sorts last for each key."""
    return _pick(df, keys, order_by, keep, F.max)
