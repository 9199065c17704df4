"""Top and bottom rows with a full tie-break, and small aggregate helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import FractionalType, IntegralType, NumericType


def top(df: DataFrame, n: int, by: str, ties: Sequence[str], descending: bool = True) -> DataFrame:
    """The first ``n`` rows; each task keeps only ``n`` rows before they meet."""
    first = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(first, *ties).limit(n)


def count_matches(df: DataFrame, conditions: Mapping[str, Column], name: str, count: str) -> DataFrame:
    """Rows matching each named condition: one pass, one output row per condition."""
    labels = list(conditions)
    totals = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())])
    pairs = F.array(*[
        F.struct(F.lit(label).alias(name), F.col(f"c{i}").alias(count)) for i, label in enumerate(labels)
    ])
    return totals.select(F.inline(pairs))


def numeric_sums(df: DataFrame, by: str) -> DataFrame:
    """Sum of every numeric column per group, whole numbers as wide decimals so none overflows."""
    sums = []
    for f in df.schema:
        if isinstance(f.dataType, IntegralType):
            sums.append(F.sum(F.col(f.name).cast("decimal(28,0)")).alias(f"sum_{f.name}"))
        elif isinstance(f.dataType, NumericType | FractionalType):
            sums.append(F.sum(f.name).alias(f"sum_{f.name}"))
    return df.groupBy(by).agg(*sums)
