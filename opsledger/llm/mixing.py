"""Mixing sources to target weights: tokens per source, repetition rates, whole and Bernoulli copies.

A document's size is its number of blank-separated words. Targets share ``share`` times all sizes by weight; none
exceeds ``most`` times its source's size, the excess is shared again by weight. With a source's rate
target / size, a document appears floor(rate) times plus once more with the fraction as probability; the draw
is a hash of seed and doc_id, so reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; a source without
words has target 0; with a null doc_id the draw is that of the empty id; repeated rows are drawn alike and all
counted; an empty table gives no rows. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import broadcast_if_small, store, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A uniform number in [0, 1) from the first 52 bits of a hash."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def ranked(sources: DataFrame) -> DataFrame:
    """Zero-based rank of each source by code point, null last.

    The sorted frame is stored with a running id, so its ranges stay as they are; only their sizes meet in one task.
    """
    order = F.col("source").asc_nulls_last()
    rows = store(sources.orderBy(order).withColumn("id", F.monotonically_increasing_id()), "mix-sorted")
    rows = rows.withColumn("part", F.shiftright("id", 33)).withColumn("place", F.col("id") - F.shiftleft("part", 33))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("before"))
    return rows.join(F.broadcast(sizes), "part").select(
        "source", "source_size", (F.col("place") + F.col("before")).alias("rank")
    )


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    The level per unit of weight rises as sources reach their limit; each round settles at least one more source
    and only totals come to the driver.
    """
    sums = store(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    known = store(ranked(sums).withColumn("weight", weight), "mix-ranked")
    limit = F.col("source_size") * most
    total = known.agg(F.sum("source_size")).first()[0] or 0
    level, settled = 0.0, -1
    while True:
        full = limit <= F.col("weight") * F.lit(level)
        row = known.agg(
            F.sum(F.when(full, limit).otherwise(0)).alias("held"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(full.cast("int")).alias("n"),
        ).first()
        if not row["weight"] or row["n"] == settled:
            break
        settled, level = row["n"], (total * share - row["held"]) / row["weight"]
    full = limit <= F.col("weight") * F.lit(level)
    target = F.when(full, limit.cast("double")).otherwise(F.col("weight") * F.lit(level)) if settled >= 0 else limit.cast("double")
    return known.select("source", "source_size", target.cast("double").alias("target"))


def planned(docs: DataFrame, size: str, goals: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies``, the number of times each row is emitted."""
    goals = broadcast_if_small(goals.withColumnRenamed("source", "mix_source"))
    joined = docs.join(goals, F.col("source").eqNullSafe(F.col("mix_source")), "left").drop("mix_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (draw(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumn("copies", F.when(F.col(size) > 0, copies).otherwise(F.least(copies, F.lit(1))).cast("long"))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """Every document as often as the plan says, with ``copy_no`` from 1; columns of ``docs`` otherwise."""
    goals = targets(docs.select("source", words(F.col("text")).alias("size")), weights)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source",
                         F.lit(1).alias("size"))
    plan = planned(packed, "size", goals, seed).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy_no")
    return plan.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "copy_no"], copies)


def op9_mixing(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", words(F.col("text")).alias("size"))
    sized = store(docs, "mix-sizes")
    plan = planned(sized, "size", targets(sized.select("source", "size")))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL_SIZED = r"""
sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
          FROM {docs}),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                      row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM per_source),
mass AS (SELECT sum(source_size) AS total FROM weighed),
held AS (SELECT a.source, a.source_size, a.weight,
                coalesce(sum(2 * b.source_size) FILTER (2 * b.source_size * a.weight < 2 * a.source_size * b.weight), 0) AS held,
                coalesce(sum(b.weight) FILTER (2 * b.source_size * a.weight >= 2 * a.source_size * b.weight), 0) AS open
         FROM weighed a, weighed b GROUP BY ALL),
settled AS (SELECT h.*, 2.0 * source_size * open <= weight * (1.5 * total - held) AS capped FROM held h, mass),
level AS (SELECT CAST(1.5 * any_value(total) - coalesce(sum(2 * source_size) FILTER (capped), 0) AS DOUBLE)
                 / nullif(sum(weight) FILTER (NOT capped), 0) AS level FROM settled, mass),
goals AS (SELECT source, source_size, CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE) ELSE weight * level END AS target
          FROM settled, level),
plan AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                CAST('0x' || md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:13] AS BIGINT) / 4503599627370496.0 AS u
         FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
"""
SQL = "WITH " + SQL_SIZED.format(docs="documents") + """
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM plan
"""
