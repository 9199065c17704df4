"""Word count with a stop-word mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from opsledger.functions import predicates as p


def word_counts(lines: DataFrame, text: str = "value", mode: str = "drop",
                stop_words: Sequence[str] = p.STOP_WORDS) -> DataFrame:
    """Occurrences per lower-cased word; ``mode`` drops the stop words or keeps only them."""
    if mode not in ("drop", "keep"):
        raise ValueError("mode is 'drop' or 'keep'")
    words = lines.select(F.explode(F.split(F.lower(text), r"\W+")).alias("word")).where(F.col("word") != "")
    stop = p.is_stop_word(F.col("word"), stop_words)
    words = words.where(stop if mode == "keep" else ~stop)
    return words.groupBy("word").agg(F.count("*").alias("occurrences"))
