"""Splitting text into blank-separated tokens and testing for whole words."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def tokens(line: Column) -> Column:
    """Blank-separated tokens.

    Runs of blanks become one space first, also at the end, where it is cut off: replacing reuses one compiled pattern for all rows and a
    one-character split needs none, while splitting by a pattern compiles it for every row.
    """
    return F.split(F.rtrim(F.regexp_replace(line, r"\s+", " ")), " ")


def has_word(line: Column, words: Sequence[str]) -> Column:
    """Whether the line contains one of the words in any case, bounded by non-word characters."""
    options = "|".join(re.escape(w.lower()) for w in words)
    return F.lower(line).rlike(rf"(?:^|\W)(?:{options})(?:\W|$)")
