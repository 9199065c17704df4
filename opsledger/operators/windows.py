"""Tumbling and sliding event-time aggregates shared by batch and streaming frames."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, LongType


def _micros(length: timedelta) -> int:
    return length // timedelta(microseconds=1)


def _text(micros: int) -> str:
    return f"{micros} microseconds"


def tumbling(df: DataFrame, time: str, size: timedelta, keys: Sequence[str],
             measures: Mapping[str, Column]) -> DataFrame:
    """``window_start, window_end, keys, measures`` per fixed window."""
    grouped = df.groupBy(F.window(time, _text(_micros(size))), *keys)
    return _flat(grouped.agg(*[m.alias(n) for n, m in measures.items()]), keys, measures)


Measure = Column | tuple[Column, Callable[[str], Column]]


def sliding(df: DataFrame, time: str, size: timedelta, slide: timedelta, keys: Sequence[str],
            measures: Mapping[str, Measure]) -> DataFrame:
    """Sliding windows over counts, sums, and measures given with the aggregate that merges them.

    A measure is a count or sum, or a pair such as ``(F.max("x"), F.max)``. Others cannot be merged from
    parts of a window and are refused; an average is a sum and a count.

    In batch, rows are first reduced to :func:`buckets` and only those reach the windows that hold them. A
    stream keeps the single-step form, which every output mode accepts, at the price of size/slide copies of each
    row; a stream that may update its results should keep buckets as state and :func:`spread` them where it is read.
    """
    if df.isStreaming:
        plain = _plain(measures)
        window = F.window(time, _text(_micros(size)), _text(_micros(slide)))
        return _flat(df.groupBy(window, *keys).agg(*[m.alias(n) for n, m in plain.items()]), keys, plain)
    return spread(buckets(df, time, size, slide, keys, measures), size, slide, keys, measures)


def buckets(df: DataFrame, time: str, size: timedelta, slide: timedelta, keys: Sequence[str],
            measures: Mapping[str, Measure]) -> DataFrame:
    """``bucket_start, keys, measures``: one row per slide-aligned part of the windows; one copy of each input row."""
    _merges(measures)
    part = F.window(time, _text(math.gcd(_micros(size), _micros(slide))))
    grouped = df.groupBy(part.alias("bucket"), *keys).agg(*[m.alias(n) for n, m in _plain(measures).items()])
    return grouped.select(F.col("bucket.start").alias("bucket_start"), *keys, *measures)


def spread(parts: DataFrame, size: timedelta, slide: timedelta, keys: Sequence[str],
           measures: Mapping[str, Measure]) -> DataFrame:
    """The sliding windows that :func:`buckets` belong to, measures merged.

    Counts and sums of whole numbers or decimals go through :func:`changes`, two rows per bucket whatever size/slide is.
    Measures that cannot be taken back exactly (doubles, maxima) go through one copy of the bucket per window.
    """
    exact = all(isinstance(parts.schema[n].dataType, IntegralType | DecimalType) for n in measures)
    if exact and not any(isinstance(m, tuple) for m in measures.values()):
        steady = runs(parts, size, slide, keys, list(measures))
        every, span = _interval(_micros(slide)), _interval(_micros(size))
        window = F.explode(F.sequence(F.col("first_start"), F.col("last_start"), every))
        return steady.withColumn("window_start", window).select(
            "window_start", (F.col("window_start") + span).alias("window_end"), *keys, *measures)
    return _fanned(parts, size, slide, keys, measures)


def _interval(micros: int) -> Column:
    return F.expr(f"INTERVAL '{micros / 1e6:.6f}' SECOND")


def _fanned(parts: DataFrame, size: timedelta, slide: timedelta, keys: Sequence[str],
            measures: Mapping[str, Measure]) -> DataFrame:
    size_us, slide_us = _micros(size), _micros(slide)
    latest = F.window("bucket_start", _text(slide_us)).getField("start")
    back = (math.ceil(size_us / slide_us) - 1) * slide_us
    fanned = (
        parts.withColumn("latest", latest)
        .withColumn("window_start", F.explode(F.sequence(F.col("latest") - _interval(back), F.col("latest"), _interval(slide_us))))
        .where(F.col("window_start") + _interval(size_us) > F.col("bucket_start"))
    )
    totals = fanned.groupBy("window_start", *keys).agg(*[merge(n).alias(n) for n, merge in _merges(measures).items()])
    return totals.select("window_start", (F.col("window_start") + _interval(size_us)).alias("window_end"), *keys, *measures)


# a range of time holds so many slides at least, and more than one window
RANGE_SLIDES = 4096


def changes(parts: DataFrame, size: timedelta, slide: timedelta, keys: Sequence[str],
            measures: Sequence[str]) -> DataFrame:
    """``at, _range, keys, measures, _live``: what enters and what leaves the window that starts at ``at``.

    A bucket adds its measures to the first window that holds it and takes them back at the first one that does not
    hold it any more. ``_live`` counts buckets in the same way, ``_live_<measure>`` those where the measure is not null.
    """
    size_us, slide_us = _micros(size), _micros(slide)
    back = _interval((math.ceil(size_us / slide_us) - 1) * slide_us)
    latest, every = F.col("_latest"), _interval(slide_us)
    first = F.when(latest - back + _interval(size_us) > F.col("bucket_start"), latest - back).otherwise(latest - back + every)
    counted = {m: F.coalesce(F.col(m), F.lit(0)) for m in measures} | {"_live": F.lit(1)}
    counted |= {f"_live_{m}": F.col(m).isNotNull().cast("int") for m in measures if parts.schema[m].nullable}
    timed = parts.withColumn("_latest", F.window("bucket_start", _text(slide_us)).getField("start")).select(
        first.alias("_first"), (latest + every).alias("_over"), *keys, *[c.alias(n) for n, c in counted.items()])
    signed = F.explode(F.array(F.struct(F.col("_first").alias("at"), F.lit(1).alias("sign")),
                               F.struct(F.col("_over").alias("at"), F.lit(-1).alias("sign"))))
    moved = timed.where("_first < _over").withColumn("_moved", signed).select(
        F.col("_moved.at").alias("at"), *keys, *[(F.col(n) * F.col("_moved.sign")).alias(n) for n in counted])
    length = max(RANGE_SLIDES, size_us // slide_us + 2) * slide_us
    return moved.withColumn("_range", F.window("at", _text(length)).getField("start"))


def runs(parts: DataFrame, size: timedelta, slide: timedelta, keys: Sequence[str],
         measures: Sequence[str]) -> DataFrame:
    """``first_start, last_start, keys, measures``: stretches of neighbouring windows with equal content.

    Running sums over :func:`changes`; windows that hold no bucket are in no stretch. The sums of a key are taken
    range by range: each range begins with what the ranges before it leave, so a key with very many buckets, or no key
    at all, is spread over as many tasks as there are ranges. Only one row per key and range meets its neighbours.
    """
    moved = changes(parts, size, slide, keys, measures)
    names = [c for c in moved.columns if c not in ("at", "_range", *keys)]
    totals = moved.groupBy("_range", *keys).agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col("_range").alias("at"), *keys, "_range", *[F.sum(n).over(earlier).alias(n) for n in names])
    carried = carried.where(F.col("_live") > 0)
    # grouped and summed where the rows of a key and range meet once
    met = moved.select("at", *keys, "_range", *names).unionByName(carried).repartition("_range", *keys)
    stepped = met.groupBy("_range", "at", *keys).agg(*[F.sum(n).alias(n) for n in names])
    inside = Window.partitionBy("_range", *keys).orderBy("at")
    slide_us = _micros(slide)
    length = max(RANGE_SLIDES, _micros(size) // slide_us + 2) * slide_us
    summed = stepped.select(
        "at", F.coalesce(F.lead("at").over(inside), F.col("_range") + _interval(length)).alias("_next"), *keys,
        *[F.sum(n).over(inside).alias(n) for n in names]).where(F.col("_live") > 0)
    out = [F.when(F.col(f"_live_{m}") > 0, F.col(m)).otherwise(None) if f"_live_{m}" in names else F.col(m) for m in measures]
    return summed.select(F.col("at").alias("first_start"), (F.col("_next") - _interval(slide_us)).alias("last_start"), *keys,
                         *[c.cast(_sum_type(parts.schema[m].dataType)).alias(m) for c, m in zip(out, measures, strict=True)])


def _sum_type(kind: DataType) -> DataType:
    """Type of a sum of sums, as merging by ``sum`` gives it."""
    return LongType() if isinstance(kind, IntegralType) else DecimalType(min(38, kind.precision + 10), kind.scale)


def _plain(measures: Mapping[str, Measure]) -> dict[str, Column]:
    return {n: m[0] if isinstance(m, tuple) else m for n, m in measures.items()}


def _merges(measures: Mapping[str, Measure]) -> dict[str, Callable[[str], Column]]:
    return {n: m[1] if isinstance(m, tuple) else _additive(n, m) for n, m in measures.items()}


def _additive(name: str, measure: Column) -> Callable[[str], Column]:
    if not re.match(r"Column<'(count|count_if|sum|countif)\((?!distinct)", str(measure), re.IGNORECASE):
        raise ValueError(f"measure {name} needs the aggregate that merges it")
    return F.sum


def _flat(grouped: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys, *measures,
    )


def ratio_alarm(counts: DataFrame, minimum: int = 100, threshold: float = 0.5) -> DataFrame:
    """Alarm state from ``success`` and ``failure`` counts.

    Up to ``minimum`` decisions there is no verdict; failures without any success are an alarm.
    """
    ratio = F.try_divide(F.col("failure").cast("double"), F.col("success").cast("double"))
    state = (
        F.when(F.col("success") + F.col("failure") <= minimum, "too few")
        .when((F.col("success") == 0) | (ratio > threshold), "alarm")
        .otherwise("ok")
    )
    return counts.withColumn("ratio", ratio).withColumn("state", state)
