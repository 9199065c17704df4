"""Device-log analytics: parse, enrich, compare runs, search, count over windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from opsledger.functions import cleaning, device_log as dl, predicates as p
from opsledger.operators import joins, ranking, windows
from opsledger.operators.compute import with_computed
from opsledger.operators.dedup import first_per_key

MESSAGE_LENGTH_LIMIT = 60


def parse(records: DataFrame, year: int, form: str = "colon", min_fraction: int = 0,
          max_fraction: int = 6, trim: bool = True) -> DataFrame:
    """Broker-shaped records to ``ts, message, char_count``; failures carry ``parse_error``.

    Every input column except ``value`` is kept.
    """
    message = cleaning.without_digits(dl.message(F.col("value"), form))
    parsed = with_computed(records, {
        "ts": dl.event_time(F.col("value"), year, min_fraction, max_fraction),
        "message": F.trim(message) if trim else message,
    })
    return parsed.withColumn("char_count", F.length("message")).withColumn(
        "parse_error",
        F.when(F.col("ts").isNull(), "no timestamp").when(F.col("message").isNull(), "no message"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNull()).drop("parse_error", "value")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNotNull()).drop("ts", "message", "char_count")


def with_codes(messages: DataFrame, codes: DataFrame, default: int = 0) -> DataFrame:
    """Known-error code per message, ``default`` for unknown messages."""
    return joins.lookup(messages, codes, "message", {"code": default})


def with_devices(messages: DataFrame, devices: DataFrame) -> DataFrame:
    """Device attributes per topic; a topic without a device row keeps NULLs."""
    return joins.lookup(messages, devices, "topic")


def severity_counts(messages: DataFrame, start: datetime, end: datetime, min_code: int = 0,
                    above: int = 1, below: int = 10) -> DataFrame:
    """Messages in (start, end] at or over a severity, seen more than ``above`` and less than ``below`` times."""
    return (
        messages.where((F.col("code") >= min_code) & p.within(F.col("ts"), start, end))
        .groupBy("message").agg(F.count("*").alias("occurrences"))
        .where((F.col("occurrences") > above) & (F.col("occurrences") < below))
        .orderBy("occurrences", "message")
    )


def parse_run(records: DataFrame, year: int, drop_ids: bool = True) -> DataFrame:
    """Lines of one run with ``ts`` and the normalised ``message``; lines without one carry ``parse_error``."""
    parsed = with_computed(records, {
        "ts": dl.event_time(F.col("value"), year),
        "message": F.trim(cleaning.normalised_message(dl.message(F.col("value")), drop_ids)),
    })
    return parsed.withColumn("parse_error", F.when(F.col("message").isNull(), "no message"))


def run_messages(records: DataFrame, year: int, drop_ids: bool = True, failures_only: bool = True) -> DataFrame:
    """Normalised messages of one run, failure-like ones only unless told otherwise."""
    parsed = parse_run(records, year, drop_ids).where(F.col("parse_error").isNull()).drop("parse_error")
    return parsed.where(p.mentions_any(F.col("message"))) if failures_only else parsed


def run_counts(messages: DataFrame, failing: Column) -> DataFrame:
    """Lines of both runs and messages of the failing run only, from one count per message."""
    counts = messages.groupBy("message").agg(
        F.count_if(~failing).alias("passing"), F.count_if(failing).alias("failing"))
    totals = counts.agg(
        F.coalesce(F.sum("passing"), F.lit(0)).alias("passing"), F.coalesce(F.sum("failing"), F.lit(0)).alias("failing"),
        F.count_if((F.col("passing") == 0) & (F.col("failing") > 0)).alias("difference"))
    return totals.unpivot([], ["passing", "failing", "difference"], "side", "lines")


def only_in_failing(failing: DataFrame, passing: DataFrame, codes: DataFrame,
                    after: datetime | None = None, times: int | None = None) -> DataFrame:
    """Messages of the failing run that the passing run never logged, with count and code."""
    failing = failing.where(p.after(F.col("ts"), after))
    missing = joins.count_missing(failing, passing, "message")
    if times is not None:
        missing = missing.where(F.col("occurrences") == times)
    return with_codes(missing, codes).orderBy("occurrences", "message")


def search(lines: DataFrame, fragments: Sequence[str], column: str = "value") -> DataFrame:
    return lines.where(p.contains_in_order(F.col(column), fragments))


def word_filter(lines: DataFrame, drop: int = 6, wanted: Sequence[str] = p.ALERT_WORDS) -> DataFrame:
    """Shortened lines (``stamp> tail``) that mention a wanted word."""
    short = with_computed(lines, {"text": dl.stamped_tail(F.col("value"), drop, "> ")})
    return short.where(p.has_words(F.col("text"), wanted)).drop("value")


def labelled_errors(lines: DataFrame, drop: int = 10,
                    wanted: Sequence[str] = ("error", "restarting", "warning")) -> DataFrame:
    """Lines with a wanted word, as level label plus tail."""
    hits = lines.where(p.has_words(F.col("value"), wanted))
    text = F.concat(dl.level_label(F.col("value")), dl.drop_tokens(F.col("value"), drop))
    return hits.withColumn("text", text).drop("value")


def one_per_clock_second(lines: DataFrame, tag: str, order_by: Sequence[str], drop: int = 5) -> DataFrame:
    """The first tagged line of every clock second, shortened."""
    tagged = lines.where(F.col("value").contains(tag)).select(
        *order_by, dl.stamped_tail(F.col("value"), drop, " ").alias("text")
    )
    tagged = tagged.withColumn("clock", dl.clock(F.col("text")))
    return first_per_key(tagged, ["clock"], list(order_by), ["text"])


def pattern_counts(lines: DataFrame, patterns: Mapping[str, Sequence[str]], column: str = "value") -> DataFrame:
    """Lines per named fragment list, all patterns in one pass."""
    tests = {name: p.contains_in_order(F.col(column), parts) for name, parts in patterns.items()}
    return ranking.count_matches(lines, tests, "pattern", "occurrences")


def message_windows(messages: DataFrame, size: timedelta, time: str = "ts", above: int = 1) -> DataFrame:
    """Messages seen more than ``above`` times in a window."""
    counts = windows.tumbling(messages, time, size, ["message"], {"occurrences": F.count("*")})
    return counts.where(F.col("occurrences") > above)


def device_windows(messages: DataFrame, codes: DataFrame, devices: DataFrame, size: timedelta,
                   time: str = "ts", max_length: int = MESSAGE_LENGTH_LIMIT,
                   wanted: Sequence[str] = p.ALERT_WORDS) -> DataFrame:
    """Windowed counts of alert messages per device with code totals and device attributes.

    The lookups follow the aggregation because code and attributes depend on its keys alone:
    they meet counted groups instead of raw lines.
    """
    kept = messages.where((F.length("message") < max_length) & p.mentions_any(F.col("message"), wanted))
    counted = windows.tumbling(kept, time, size, ["topic", "message"], {"occurrences": F.count("*")})
    coded = with_codes(counted, codes).withColumn("code", F.col("code") * F.col("occurrences"))
    return with_devices(coded, devices).select(
        "window_start", "topic", "message", "occurrences", "code", "ip", "realm", "model"
    )


def average_length(messages: DataFrame, keys: Sequence[str], word: str = "error") -> DataFrame:
    """Average length of the messages that mention a word."""
    return (
        messages.where(p.mentions_any(F.col("message"), [word]))
        .groupBy(*keys).agg(F.avg("char_count").alias("average_chars"))
    )


def average_length_sliding(messages: DataFrame, size: timedelta, slide: timedelta, keys: Sequence[str],
                           time: str = "ts") -> DataFrame:
    """True average message length per sliding window."""
    sums = windows.sliding(messages, time, size, slide, keys,
                           {"chars": F.sum("char_count"), "n": F.count("char_count")})
    return sums.withColumn("average_chars", F.col("chars") / F.col("n")).drop("chars", "n")


def parse_sentences(lines: DataFrame) -> DataFrame:
    """``<timestamp> code sentence`` lines as ``ts, code, text``; others carry ``parse_error``."""
    value = F.col("value")
    parsed = with_computed(lines, {
        "ts": dl.bracketed_time(value),
        "code": dl.bracketed_code(value),
        "text": dl.bracketed_text(value),
    })
    return parsed.withColumn("parse_error", F.when(F.col("text").isNull(), "bad line").when(F.col("ts").isNull(), "bad time"))


def coded_sentences(lines: DataFrame) -> DataFrame:
    """The lines that :func:`parse_sentences` accepts."""
    return parse_sentences(lines).where(F.col("parse_error").isNull()).drop("value", "parse_error")
