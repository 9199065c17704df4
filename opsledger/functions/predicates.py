"""Row predicates used by the log and returns reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, functions as F

from opsledger.functions.text import has_word

# Filter words of the log reports.
FAILURE_WORDS = ("error", "warning", "fail", "crash")
ALERT_WORDS = ("error", "warning")
LINE_LENGTH_LIMIT = 210
# The stop words of the word count.
STOP_WORDS = ("is", "you", "to", "your", "the", "a", "of")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def mentions_any(text: Column, words: Sequence[str] = FAILURE_WORDS) -> Column:
    """Case-insensitive substring search for any of the words."""
    low = F.lower(text)
    return any_of([low.contains(w) for w in words])


def contains_in_order(text: Column, fragments: Sequence[str]) -> Column:
    """All fragments in this order, as one LIKE with its wildcards escaped."""
    def literal(s: str) -> str:
        return s.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")

    return text.like("%" + "%".join(literal(f) for f in fragments) + "%")


def has_words(line: Column, wanted: Sequence[str], unwanted: Sequence[str] = ("info",),
              max_length: int = LINE_LENGTH_LIMIT) -> Column:
    """Short line whose whole words include a wanted and no unwanted one."""
    return (F.length(line) < max_length) & has_word(line, wanted) & ~has_word(line, unwanted)


def _instant(value: datetime) -> Column:
    # through text, so that no session or machine time zone shifts it
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def after(moment: Column, start: datetime | None) -> Column:
    """Strictly later than ``start``; no bound when it is None."""
    return F.lit(True) if start is None else moment > _instant(start)


def before(moment: Column, end: datetime | None) -> Column:
    return F.lit(True) if end is None else moment < _instant(end)


def within(moment: Column, start: datetime, end: datetime) -> Column:
    """The half-open range (start, end]."""
    return after(moment, start) & (moment <= _instant(end))


def is_stop_word(word: Column, words: Sequence[str] = STOP_WORDS) -> Column:
    return word.isin(*words)
