"""Text clean-up expressions that make similar messages group together."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: id phrases that may be dropped from a normalised message.
ID_PHRASES = r"session_id\:\s\S*| pair\sid\:\s\S*| notification_id\:\s\S*| event_id\:\s\S*| action_queue\:\s\S"
# Fixed value: marks removed from report rows.
REPORT_MARKS = r"CASE\d{6}|\[|\]|-"
CASE_DELIMITERS = r"[\[\],\s-]"


def without_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\d", "")


def similar_message(text: Column) -> Column:
    """Digits out and trimmed: the grouping key of the count reports."""
    return F.trim(without_digits(text))


def normalised_message(text: Column, drop_ids: bool = False) -> Column:
    """Digits, stray colons and runs of blanks removed; optionally id phrases too."""
    out = without_digits(text)
    # up to two colons right after a blank become one more blank
    out = F.regexp_replace(out, r"(\s):{0,2}", "$1 ")
    # colons that still follow a non-word character disappear
    out = F.regexp_replace(out, r"(\W):+", "$1")
    out = F.regexp_replace(out, r"\s{2,}", " ")
    if drop_ids:
        out = F.regexp_replace(out, ID_PHRASES, "")
    return out


def case_reason(case_text: Column) -> Column:
    """Reason wording of a case text: first token dropped, delimiters to single blanks."""
    tail = F.regexp_replace(case_text, r"^[^\[\],\s-]*", "")
    return F.trim(F.regexp_replace(tail, CASE_DELIMITERS + "+", " "))


def report_text(text: Column) -> Column:
    """Report wording: case number, brackets and minus signs removed."""
    return F.trim(F.regexp_replace(text, REPORT_MARKS, ""))


def unit_count(quantity: Column) -> Column:
    """Whole units of a signed quantity."""
    return F.floor(F.abs(quantity)).cast("bigint")
