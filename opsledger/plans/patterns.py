"""Searching lines for a whole table of patterns at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsledger.operators import joins
from opsledger.session import new_run_dir, remove_dir

GRAM = 3
MARK = "g"               # runs of characters begin with it, words with the character before them
# the filter of waiting keys: FILTER_ROWS rows of FILTER_WORDS times 64 bits, 16 MB in all, PROBES bits per key
FILTER_ROWS, FILTER_WORDS, PROBES = 1 << 15, 64, 3


def _in_order() -> Column:
    """Whether all ``fragments`` stand in ``value`` in this order, without overlap."""
    return F.expr("aggregate(fragments, 1, (at, f) -> CASE WHEN at = 0 OR locate(f, value, at) = 0 THEN 0 "
                  "ELSE locate(f, value, at) + length(f) END) > 0")


def _whole_words(text: Column) -> Column:
    """Whole words that do not begin or end the text, each with the character before it."""
    return F.regexp_extract_all(text, F.lit(r"\W\w+(?=\W)"), F.lit(0))


def _grams(text: Column, size: Column) -> Column:
    """All runs of ``size`` characters, marked so that they differ from words; the empty run for size 0."""
    places = F.when(size == 0, F.array(F.lit(1))).when(
        F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.concat(F.lit(MARK), F.substring(text, i, size))))


def _row_of(h: Column) -> Column:
    """The row of the filter that a hashed key belongs to."""
    return h.bitwiseAND(FILTER_ROWS - 1).cast("int")


def _places(h: Column) -> list[Column]:
    """The bits of a hashed key in its row."""
    return [F.shiftrightunsigned(h, 15 + 12 * i).bitwiseAND(64 * FILTER_WORDS - 1).cast("int") for i in range(PROBES)]


def _key_filter(waiting: DataFrame) -> DataFrame:
    """``row, words``: the bits of all keys of ``waiting``. Never larger than 16 MB; with very many keys it lets more others pass."""
    h = F.xxhash64("key")
    bits = waiting.select(_row_of(h).alias("row"), F.explode(F.array(*_places(h))).alias("place"))
    words = bits.groupBy("row", F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, place & 63)")).alias("bits"))
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    return words.groupBy("row").agg(by_word.alias("words")).select("row", F.transform(
        F.sequence(F.lit(0), F.lit(FILTER_WORDS - 1)), lambda i: F.coalesce(F.try_element_at("words", i), F.lit(0))).alias("words"))


def _maybe_waiting(keyed: DataFrame, waiting: DataFrame) -> DataFrame:
    """The rows whose key waits, and few of the others, before any row travels."""
    h = F.col("_hash")
    met = keyed.withColumn("_hash", F.xxhash64("key")).withColumn("_row", _row_of(h)).join(
        F.broadcast(_key_filter(waiting).withColumnsRenamed({"row": "_row", "words": "_words"})), "_row")
    for place in _places(h):
        met = met.where(F.getbit(F.get("_words", F.shiftright(place, 6)), place.bitwiseAND(63)) == 1)
    return met.drop("_hash", "_row", "_words")


class PatternTable:
    """Patterns ``pattern_id, fragments`` stored by their rarest word.

    A pattern of ordered fragments can only match a line that holds its whole words behind the same characters, so each
    pattern waits under one such word: the one that the fewest lines hold, counted over the lines if they are given and over the
    patterns else. A pattern without a whole word inside a fragment waits under the rarest run of three characters of its longest fragment (of all its
    characters if it is shorter; under the empty run if it has none and matches every line). Lines are read once, whatever the
    number of patterns, and every pattern that a line's words bring up is verified. With more patterns than a broadcast
    takes, a line travels once per word that has patterns waiting, and a filter of bounded size keeps its other words back.
    """

    def __init__(self, patterns: DataFrame, lines: DataFrame | None = None):
        spark = patterns.sparkSession
        self.path = new_run_dir(spark, "patterns")
        given = patterns.select("pattern_id", F.filter("fragments", lambda f: f != "").alias("fragments"))
        words = F.flatten(F.transform("fragments", _whole_words))
        longest = F.array_max(F.transform("fragments", lambda f: F.struct(F.length(f).alias("n"), f.alias("f"))))["f"]
        longest = F.coalesce(longest, F.lit(""))
        keys = F.when(F.size(words) > 0, F.array_distinct(words)).otherwise(_grams(longest, F.least(F.lit(GRAM), F.length(longest))))
        pairs = given.select("pattern_id", "fragments", F.explode(keys).alias("key"))
        pairs.write.parquet(f"{self.path}/pairs")
        pairs = spark.read.schema(pairs.schema).parquet(f"{self.path}/pairs")
        runs = pairs.where(F.col("key").startswith(MARK)).select((F.length("key") - 1).alias("n")).distinct()
        self.sizes = sorted(r.n for r in runs.collect())       # 0 to GRAM
        # counted before they meet the patterns: of a word, a task sends one row
        counted = pairs if lines is None else self._waiting(self._keyed(lines).select("key"), pairs.select("key").distinct())
        seen = counted.groupBy("key").agg(F.count("*").alias("n"))
        best = pairs.join(seen, "key", "left").groupBy("pattern_id", "fragments").agg(
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("best"))
        best.select(F.col("best.key").alias("key"), "pattern_id", "fragments").write.parquet(f"{self.path}/by_key")
        self.by_key = spark.read.parquet(f"{self.path}/by_key")
        remove_dir(spark, f"{self.path}/pairs")

    @staticmethod
    def _waiting(keyed: DataFrame, waiting: DataFrame) -> DataFrame:
        if joins.is_small(waiting):
            return keyed.join(F.broadcast(waiting), "key", "left_semi")
        return _maybe_waiting(keyed, waiting)

    def _keyed(self, lines: DataFrame) -> DataFrame:
        keys = [F.array_distinct(_whole_words(F.col("value"))), *[_grams(F.col("value"), F.lit(n)) for n in self.sizes]]
        return lines.where(F.col("value").isNotNull()).withColumn("key", F.explode(F.concat(*keys)))

    def matches(self, lines: DataFrame) -> DataFrame:
        """The lines with ``pattern_id`` of every pattern they match, once each; other columns are kept."""
        if joins.is_small(self.by_key):
            met = self._keyed(lines).join(F.broadcast(self.by_key), "key")
        else:
            # a word that very many lines hold is dealt out, its patterns are repeated per share
            met = joins.skew_join(_maybe_waiting(self._keyed(lines), self.by_key.select("key")), self.by_key, "key")
        return met.where(_in_order()).drop("key", "fragments")

    def counts(self, lines: DataFrame) -> DataFrame:
        """``pattern_id, occurrences`` of the patterns that any line matches."""
        return self.matches(lines.select("value")).groupBy("pattern_id").agg(F.count("*").alias("occurrences"))
