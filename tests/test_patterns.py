import random

import pytest
from pyspark.sql import functions as F

from opsledger.operators import joins
from opsledger.plans import patterns

LINES = ["E svc_error: error code:17 stage ab", "[::9] crash dump xy info", "warning: retry 4 pair id: p3", "", None, "é, ü", "100% done",
         "a.b.c", "ab", "x", "stage stage code", "code error", "crash dump, crash dump", "a_b%c\\d"]
PATTERNS = [("bound", ["E svc_error", "error code", "stage a"]), ("dump", ["[", " crash dump ", "info"]), ("percent", ["100%"]),
            ("twice", ["crash dump", "crash dump"]), ("order", ["code", "error"]), ("dots", [".", "."]), ("one", ["x"]), ("all", []),
            ("blank", ["", ""]), ("none", ["no such text"]), ("short", ["ab"]), ("wild", ["_b%", "\\d"]), ("accent", ["é", "ü"])]


def matching(fragments, line):
    at = 0
    for f in fragments:
        at = line.find(f, at)
        if at < 0:
            return False
        at += len(f)
    return True


def brute(wanted, lines):
    return sorted((p, i) for p, fragments in wanted for i, line in enumerate(lines) if line is not None and matching(fragments, line))


def frames(spark, wanted, lines):
    return (spark.createDataFrame(wanted, "pattern_id string, fragments array<string>"),
            spark.createDataFrame(list(enumerate(lines)), "i int, value string").repartition(3))


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("counted", [True, False])
def test_equals_every_pattern_on_every_line(spark, monkeypatch, small, counted):
    if not small:
        monkeypatch.setattr(joins, "is_small", lambda df, *_: False)
    rng = random.Random(1)
    words = ["error", "code", "stage", "ab", "retry", "x", "17", "info"]
    lines = LINES + [rng.choice([" ", ": ", "_"]).join(rng.choices(words, k=rng.randrange(8))) for _ in range(60)]
    wanted = PATTERNS + [(f"p{i}", [rng.choice(["", " "]) + rng.choice([" ", "_"]).join(rng.choices(words, k=rng.randrange(1, 4)))
                                    for _ in range(rng.randrange(1, 3))]) for i in range(60)]
    table, rows = frames(spark, wanted, lines)
    got = patterns.PatternTable(table, rows if counted else None).matches(rows)
    assert got.columns == ["i", "value", "pattern_id"]
    assert sorted((r.pattern_id, r.i) for r in got.collect()) == brute(wanted, lines)


def test_thousands_of_patterns_read_the_lines_once(spark, tmp_path):
    spark.range(2000).select(F.concat(F.lit("unit "), F.col("id"), F.lit(" failed, code "), F.col("id") % 7).alias("value")) \
        .write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    table = patterns.PatternTable(spark.range(3000).select(
        F.col("id").alias("pattern_id"), F.array(F.concat(F.lit("unit "), F.col("id"), F.lit(" ")), F.lit("code")).alias("fragments")), lines)
    counts = table.counts(lines)
    assert counts._jdf.queryExecution().executedPlan().toString().count(str(tmp_path / "lines")) == 1
    got = {r.pattern_id: r.occurrences for r in counts.collect()}
    assert got == dict.fromkeys(range(2000), 1)
    # every pattern waits under its own number, not under a word that all lines hold
    assert table.by_key.groupBy("key").count().agg(F.max("count")).first()[0] == 1


def test_no_patterns_and_no_lines(spark):
    table, rows = frames(spark, PATTERNS, LINES)
    assert patterns.PatternTable(table.limit(0)).matches(rows).count() == 0
    assert patterns.PatternTable(table).matches(rows.limit(0)).count() == 0


def test_a_line_travels_only_under_words_that_patterns_wait_under(spark, monkeypatch):
    lines = spark.range(500).select(F.concat(F.lit("CASE7 - red ring, 1-LOW ref 3-"), F.col("id"), F.lit("-"), F.col("id") % 9).alias("value"))
    wanted = F.array(F.lit(" - red ring,"), F.lit("ref "), F.concat(F.lit("-"), F.col("id"), F.lit("-")))
    sent = []
    monkeypatch.setattr(joins, "is_small", lambda df, *_: False)
    joined = joins.skew_join
    monkeypatch.setattr(joins, "skew_join", lambda fact, dim, key, how="inner": sent.append(fact) or joined(fact, dim, key, how))
    table = patterns.PatternTable(spark.range(400).select(F.col("id").alias("pattern_id"), wanted.alias("fragments")), lines)
    assert {r.pattern_id: r.occurrences for r in table.counts(lines).collect()} == dict.fromkeys(range(400), 1)
    # each line has nine words; the number of a part is the one that patterns wait under
    assert sent[0].count() <= 420
