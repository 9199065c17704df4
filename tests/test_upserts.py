import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from opsledger.session import new_run_dir, remove_dir
from opsledger.sources import streams
from opsledger.streaming import lookups, runner, sinks, upserts
from opsledger.testbed import arrivals

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "at timestamp, k string, n bigint"
DAY = 86_400


def batches(seed, count=20, ranges=6):
    """Changed rows per batch; later batches touch old keys too."""
    r = random.Random(seed)
    return [{(r.randrange(ranges), r.choice("abc")): r.randrange(100) for _ in range(6)} for _ in range(count)]


def frame(spark, rows):
    return spark.createDataFrame([(BASE + timedelta(days=d, hours=3), k, n) for (d, k), n in rows.items()], SCHEMA)


def table(spark, compact_every=4, ranged=True):
    path = new_run_dir(spark, "upserts")
    return upserts.UpsertTable(path, spark.createDataFrame([], SCHEMA).schema, ["at", "k"],
                               upserts.range_of("at", DAY) if ranged else None, compact_every)


def content(rows):
    return {((r["at"].replace(tzinfo=timezone.utc) - BASE).days, r["k"]): r["n"] for r in rows}


@pytest.mark.parametrize("ranged", [True, False])
def test_twenty_batches_with_compactions_and_replays(spark, ranged):
    kept, want, sent = table(spark, 6, ranged), {}, batches(1)
    write = kept.writer()
    assert kept.read(spark).count() == 0
    for i, rows in enumerate(sent):
        write(frame(spark, rows), i)
        want |= rows
        if i in (2, 5, 11):         # replayed at once, before and right after a compaction
            write(frame(spark, rows), i)
        if i == 13:                 # a replay from before the last compaction
            write(frame(spark, sent[3]), 3)
        if i in (0, 5, 6, 13, 19):
            assert content(kept.read(spark).collect()) == want
    # a reader opens one base per range and what came after the last compaction (batch 17)
    sources = kept.sources(spark)
    assert all("batch_id=18" in s or "batch_id=19" in s for s in sources if s.startswith("changes"))
    ranges = [s.rsplit("=", 1)[1] for s in sources if s.startswith("base")]
    assert len(ranges) == len(set(ranges))


def test_a_compaction_that_died_is_ignored_and_repeated(spark):
    kept, want = table(spark, 100), {}
    for i, rows in enumerate(batches(2, 5)):
        kept.put(frame(spark, rows), i)
        want |= rows
    kept.compact(spark, 3)
    remove_dir(spark, f"{kept.path}/base/upto=3/_SUCCESS")
    assert content(kept.read(spark).collect()) == want and not [s for s in kept.sources(spark) if "base" in s]
    kept.compact(spark, 3)
    kept.compact(spark, 3)
    assert content(kept.read(spark).collect()) == want and [s for s in kept.sources(spark) if "base" in s]


def test_untouched_ranges_are_not_written_again(spark):
    kept = table(spark, 2)
    write = kept.writer()
    for i, rows in enumerate([{(0, "a"): 1}, {(1, "a"): 1}, {(2, "a"): 1}, {(1, "a"): 5}, {(2, "b"): 7}, {(2, "a"): 8}]):
        write(frame(spark, rows), i)
    zero = (BASE - datetime(1970, 1, 1, tzinfo=timezone.utc)).days
    assert kept.sources(spark) == [f"base/upto={n}/_range={zero + d}" for d, n in ((0, 1), (1, 3), (2, 5))]
    assert content(kept.read(spark).collect()) == {(0, "a"): 1, (1, "a"): 5, (2, "a"): 8, (2, "b"): 7}


@pytest.mark.parametrize("descending", [False, True])
def test_ordered_reading_needs_no_sort_of_the_whole(spark, descending):
    kept, want = table(spark, 7), {}
    write = kept.writer()
    for i, rows in enumerate(batches(3, 20, ranges=30)):
        write(frame(spark, rows), i)
        want |= rows
    order = [F.col("at").desc() if descending else "at", "k"]
    got = kept.read_ordered(spark, order, descending, rows_per_task=5)
    assert got._jdf.queryExecution().executedPlan().toString().count("rangepartitioning") == 0
    rows = got.collect()
    days = [(r["at"], r["k"]) for r in rows]
    assert days == sorted(sorted(days, key=lambda x: x[1]), key=lambda x: x[0], reverse=descending)
    assert content(rows) == want
    assert table(spark).read_ordered(spark, order).count() == 0


def test_a_batch_keeps_the_lookup_it_met_first(spark):
    lookup = lookups.VersionedLookup(new_run_dir(spark, "lookup"), "k")
    assert lookup.publish(spark.createDataFrame([("a", "one")], "k string, name string")) == 0
    batch = spark.createDataFrame([("a",), ("b",)], "k string")
    first = {r.k: r.name for r in lookup.attach(batch, 0).collect()}
    assert lookup.publish(spark.createDataFrame([("a", "two"), ("b", "three")], "k string, name string")) == 1
    assert first == {"a": "one", "b": None} == {r.k: r.name for r in lookup.attach(batch, 0).collect()}
    assert {r.k: r.name for r in lookup.attach(batch, 1).collect()} == {"a": "two", "b": "three"}
    # broadcast while it is small, by shuffle when it has grown
    lookup.publish(spark.range(200_001).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("name")))
    plans = [lookup.attach(batch, i)._jdf.queryExecution().analyzed().toString() for i in (1, 2)]
    assert ["_salt" in p for p in plans] == [False, True]


def test_late_rows_show_in_the_progress(spark):
    out = new_run_dir(spark, "late")
    rows = [(BASE + timedelta(minutes=i), i) for i in range(100)]
    events = spark.createDataFrame(rows, "ts timestamp, id int")
    sliced = arrivals.slice_of(events, late=F.col("id") == 3)
    assert {r.slice for r in sliced.where("id = 3").collect()} == {2}
    found = []

    def run(_):
        stream = runner.event_time(streams.read_stream(spark, "parquet", f"{out}/in/slice*", events.schema), "ts", "1 minute")
        counts = stream.groupBy(F.window("ts", "10 minutes")).agg(F.count("*").alias("n"))
        found.extend(runner.run_to_end(counts, sinks.batch_table(f"{out}/rows"), f"{out}/cp", "append"))

    arrivals.deliver(sliced, f"{out}/in", run)
    assert [(p["input_rows"], p["late"]) for p in found if p["input_rows"]] == [(24, False), (25, False), (26, True), (25, False)]
    runner.store_progress(spark, found, f"{out}/progress")
    assert spark.read.parquet(f"{out}/progress").where("late").count() == 1


def test_files_in_order_of_time(spark):
    out = new_run_dir(spark, "ordered")
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("t"), (F.col("id") * 7 % 1000).cast("string").alias("value"))
    arrivals.in_order(df, "t", out, 8)
    stream = streams.line_stream(spark, out, maxFilesPerTrigger="1")
    runner.run_to_end(stream, sinks.batch_table(f"{out}-rows"), f"{out}-cp")
    got = sinks.read_batches(spark, f"{out}-rows", stream.schema).groupBy("batch_id").agg(
        F.min(F.col("value").cast("int")).alias("a"), F.max(F.col("value").cast("int")).alias("b")).orderBy("batch_id").collect()
    assert len(got) == 8 and all(x.b < y.a for x, y in zip(got, got[1:], strict=False))
