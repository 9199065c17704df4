"""Web access-log analytics: parse, status by hour, top URLs, agents, error-ratio alarm."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from opsledger.functions import access_log as al
from opsledger.operators import windows
from opsledger.operators.compute import with_computed



def parse(lines: DataFrame) -> DataFrame:
    """Typed access-log entries; failures carry ``parse_error``. Other input columns are kept."""
    split = with_computed(lines, {"_fields": al.split_fields(F.col("value"))})
    valid = F.size("_fields") == len(al.FIELDS)
    text = {name: F.when(valid, al.field(F.col("_fields"), name)) for name in al.FIELDS}
    status = text["status_text"].try_cast("int")
    timed = with_computed(split, {"ts": al.event_time(text["date_text"])})
    typed = timed.select(
        *lines.columns, text["ip"].alias("ip"), text["client"].alias("client"), text["user"].alias("user"), "ts",
        text["request"].alias("request"), al.request_url(text["request"]).alias("url"), status.alias("status"),
        text["bytes_text"].try_cast("bigint").alias("bytes"), text["referer"].alias("referer"),
        text["agent"].alias("agent"), valid.alias("_valid"),
    )
    error = F.when(~F.col("_valid"), "bad line").when(F.col("ts").isNull(), "bad date")
    return typed.withColumn("parse_error", error).drop("_valid")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNull()).drop("parse_error", "value")


def rejected(parsed: DataFrame, *keys: str) -> DataFrame:
    return parsed.where(F.col("parse_error").isNotNull()).select(*keys, "value", "parse_error")


def status_hourly(entries: DataFrame, time: str = "ts") -> DataFrame:
    return windows.tumbling(entries, time, timedelta(hours=1), ["status"], {"requests": F.count("*")})


def _requests() -> dict[str, Column]:
    return {"requests": F.count("*")}


def url_counts(entries: DataFrame, size: timedelta, slide: timedelta, time: str = "ts") -> DataFrame:
    """Requests per URL over sliding windows."""
    return windows.sliding(entries.where(F.col("url").isNotNull()), time, size, slide, ["url"], _requests())


def url_buckets(entries: DataFrame, size: timedelta, slide: timedelta, time: str = "ts") -> DataFrame:
    """The parts of :func:`url_counts` a stream keeps; :func:`url_windows` makes the windows of them."""
    return windows.buckets(entries.where(F.col("url").isNotNull()), time, size, slide, ["url"], _requests())


def url_windows(parts: DataFrame, size: timedelta, slide: timedelta) -> DataFrame:
    return windows.spread(parts, size, slide, ["url"], _requests())


def agent_counts(entries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return entries.groupBy(*keys, "agent").agg(F.count("*").alias("total"))


def _tallies() -> dict[str, Column]:
    outcome = al.status_class(F.col("status"))
    return {
        "success": F.count_if(outcome == "Success"),
        "failure": F.count_if(outcome == "Failure"),
        "other": F.count_if(outcome == "Other"),
    }


def error_alarm(entries: DataFrame, size: timedelta, slide: timedelta, time: str = "ts",
                minimum: int = 100, threshold: float = 0.5) -> DataFrame:
    """Success, failure and other counts per sliding window with the alarm state."""
    return windows.ratio_alarm(windows.sliding(entries, time, size, slide, [], _tallies()), minimum, threshold)


def outcome_buckets(entries: DataFrame, size: timedelta, slide: timedelta, time: str = "ts") -> DataFrame:
    """The parts of :func:`error_alarm` a stream keeps; :func:`alarm_windows` makes the alarms of them."""
    return windows.buckets(entries, time, size, slide, [], _tallies())


def alarm_windows(parts: DataFrame, size: timedelta, slide: timedelta,
                  minimum: int = 100, threshold: float = 0.5) -> DataFrame:
    return windows.ratio_alarm(windows.spread(parts, size, slide, [], _tallies()), minimum, threshold)
