"""Computing costly columns once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def with_computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns through a one-row generator.

    The optimizer copies a projected expression into every filter it pushes below the projection, so
    a parsed field that is filtered, windowed and grouped would be parsed again each time. Filters
    stop at a generator: the fields are computed once per row, still inside generated code.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
