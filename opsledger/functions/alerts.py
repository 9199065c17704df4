"""Alert payload ``"<count> <type> | <code>"`` as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def occurrence(payload: Column) -> Column:
    return F.get(F.split(F.trim(payload), r"\s"), F.lit(0)).try_cast("int")


def code(payload: Column) -> Column:
    return F.lower(F.trim(F.get(F.split(payload, r"\|"), F.lit(1))))
