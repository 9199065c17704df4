"""Running alert totals from ``"<count> <type> | <code>"`` payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsledger.functions import alerts as a
from opsledger.operators import joins


def parse_all(records: DataFrame) -> DataFrame:
    """``error, occurrence, parse_error`` for every payload."""
    fields = records.select("*", a.code(F.col("value")).alias("error"), a.occurrence(F.col("value")).alias("occurrence"))
    problem = F.when(F.col("error").isNull(), "no code").when(F.col("occurrence").isNull(), "no count")
    return fields.withColumn("parse_error", problem)


def parse(records: DataFrame) -> DataFrame:
    """``error, occurrence`` of the payloads that have both."""
    return parse_all(records).where(F.col("parse_error").isNull()).drop("value", "parse_error")


def rejected(records: DataFrame) -> DataFrame:
    """The other payloads with the reason in ``parse_error``."""
    return parse_all(records).where(F.col("parse_error").isNotNull()).drop("error", "occurrence")


def totals(parsed: DataFrame, alerts: DataFrame) -> DataFrame:
    """Occurrences per alert code with its wording ('' when unknown).

    Counted by code first; the wording joins the counted codes.
    """
    counted = parsed.groupBy("error").agg(F.sum("occurrence").alias("occurrences"))
    return joins.lookup(counted, alerts, "error", {"message": ""})
