"""Accepted and rejected rows from one pass, with the counts of that same pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from opsledger.session import new_run_dir


@dataclass(frozen=True)
class Split:
    """Stored results of one parse: accepted rows, rejected rows with ``parse_error``, and one row of counts."""

    accepted: DataFrame
    rejected: DataFrame
    balance: DataFrame

    def report(self, *keys: str) -> DataFrame:
        """``kind, <keys>, value, reason, rows``: every rejected row, and what was read, accepted and rejected."""
        rows = self.rejected.select(F.lit("line").alias("kind"), *keys, "value", F.col("parse_error").alias("reason"),
                                    F.lit(1).cast("bigint").alias("rows"))
        counts = self.balance.select("input", "accepted", "rejected").unpivot([], ["input", "accepted", "rejected"], "kind", "rows")
        types = dict(self.rejected.dtypes)
        empty = [F.lit(None).cast(types[k]).alias(k) for k in (*keys, "value")]
        return rows.unionByName(counts.select("kind", *empty, F.lit(None).cast("string").alias("reason"), "rows"))


def split(lines: DataFrame, parse: Callable[[DataFrame], DataFrame]) -> Split:
    """Parses once and stores both outputs; ``parse`` keeps every line and marks the bad ones by ``parse_error``.

    The lines that enter the parse and the rows of both outputs are counted by observations of the one job that writes
    them, so ``input`` equals ``accepted`` + ``rejected`` unless the parse lost or multiplied lines.
    """
    spark = lines.sparkSession
    path = new_run_dir(spark, "split")
    read, made = Observation(), Observation()
    parsed = parse(lines.observe(read, F.count(F.lit(1)).alias("input")))
    good = F.col("parse_error").isNull()
    parsed.observe(made, F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected")) \
        .withColumn("_accepted", good).write.partitionBy("_accepted").parquet(path)
    counts = spark.createDataFrame([(read.get["input"], made.get["accepted"], made.get["rejected"])],
                                   "input bigint, accepted bigint, rejected bigint")
    full = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in parsed.schema] + ["_accepted boolean"])
    # the folders are there only if any row was written
    stored = spark.read.schema(full).parquet(path) if counts.where("input > 0").count() else spark.createDataFrame([], full)
    return Split(stored.where("_accepted").drop("_accepted", "parse_error"), stored.where("NOT _accepted").drop("_accepted"), counts)
