"""Device-log line parsing as column expressions (timestamp, message, tokens, clock)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from opsledger.functions.text import tokens

# Log-line patterns.
STAMP = r"\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}\.\d{%d,%d}"
MESSAGE_FORMS = {
    "colon": r"[IDEW]\D{0,100}?:(.*)",
    "letter": r"[I|D|E](.*)",  # the bar belongs to the class
    "word": r"[IDEW]\s\w{0,100}:(.*)",
}
BRACKETED = r"<(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{6})>\s+(\d+)\s+(.*)"
CLOCK = r"(\d{2}:\d{2}(?::\d{2})?)"


def _group(line: Column, pattern: str, index: int) -> Column:
    """One capture group of the first match, NULL (not '') where the pattern does not occur."""
    return F.get(F.regexp_extract_all(line, F.lit(pattern), F.lit(index)), F.lit(0))


def event_time(line: Column, year: int, min_fraction: int = 0, max_fraction: int = 6) -> Column:
    """``MM-dd HH:mm:ss.f`` anywhere in the line as TIMESTAMP_NTZ; NULL if absent or impossible."""
    found = F.regexp_extract(line, STAMP % (min_fraction, max_fraction), 0)
    return F.concat(F.lit(f"{year}-"), found).try_cast("timestamp_ntz")


def message(line: Column, form: str = "colon") -> Column:
    """Text after the level letter; NULL when the line has none."""
    return _group(line, MESSAGE_FORMS[form], 1)


def bracketed_time(line: Column) -> Column:
    return _group(line, BRACKETED, 1).try_cast("timestamp_ntz")


def bracketed_code(line: Column) -> Column:
    return _group(line, BRACKETED, 2).try_cast("int")


def bracketed_text(line: Column) -> Column:
    return _group(line, BRACKETED, 3)


def clock(line: Column) -> Column:
    """First ``HH:mm[:ss]`` in the line, ``'0'`` if there is none."""
    return F.coalesce(_group(line, CLOCK, 1), F.lit("0"))


def drop_tokens(line: Column, count: int) -> Column:
    """The line without its first ``count`` blank-separated tokens."""
    parts = tokens(line)
    return F.array_join(F.slice(parts, count + 1, F.greatest(F.size(parts), F.lit(1))), " ")


def stamped_tail(line: Column, count: int, separator: str) -> Column:
    """Second token (when there are more than three), separator, then the tail after ``count`` tokens."""
    parts = tokens(line)
    stamp = F.when(F.size(parts) > 3, F.get(parts, F.lit(1))).otherwise(F.lit(""))
    return F.concat(stamp, F.lit(separator), drop_tokens(line, count))


def level_label(line: Column) -> Column:
    """``'ERROR '`` wins over ``'WARNING '``; empty when neither word occurs."""
    low = F.lower(line)
    return (
        F.when(low.contains("error"), "ERROR ")
        .when(low.contains("warning"), "WARNING ")
        .otherwise("")
    )
