import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from opsledger.operators import dedup, indexing, joins, ranking, windows
from opsledger.plans import access_logs, device_logs, words


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_survivor_does_not_depend_on_partitioning(spark):
    rng = random.Random(1)
    data = [(rng.randint(0, 5), rng.randint(0, 9), rng.random()) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, o int, x double")
    want = {}
    for k, o, x in data:
        want[k] = min(want.get(k, (99, 9.0)), (o, x))
    for parts in (1, 7):
        got = dedup.first_per_key(df.repartition(parts), ["k"], ["o"]).collect()
        assert {r.k: (r.o, r.x) for r in got} == want
    last = dedup.last_per_key(df, ["k"], ["o"], ["x"]).collect()
    assert {r.k: r.x for r in last} == {k: max((o, x) for kk, o, x in data if kk == k)[1] for k in want}


@pytest.fixture()
def skewed(spark):
    # one key holds most rows, several rows have no key, all copies are identical
    data = [("hot", 1)] * 600 + [(None, 2)] * 50 + [(f"k{i % 40}", i) for i in range(200)]
    fact = spark.createDataFrame(data, "key string, v int")
    dim = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"K{i}") for i in range(0, 40, 2)], "key string, name string")
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(skewed, how):
    fact, dim = skewed
    assert [r.key for r in joins.hot_keys(fact, "key").collect()] == ["hot"]
    assert rows_of(joins.skew_join(fact, dim, "key", how)) == rows_of(fact.join(dim, "key", how))


def test_lookup_small_and_large_dimension_agree(skewed):
    fact, dim = skewed
    small = joins.lookup(fact, dim, "key", {"name": "none"})
    large = joins.lookup(fact, dim, "key", {"name": "none"}, max_rows=3)
    assert rows_of(small) == rows_of(large)
    assert small.count() == fact.count()


def test_all_keys_above_an_even_share_are_found(spark):
    # 600 keys of 20 rows and 12,000 of one row: with 2,000 partitions an even share is 12 rows
    old = spark.conf.get("spark.sql.shuffle.partitions")
    fact = spark.range(24_000).select(F.when(F.col("id") < 12_000, F.col("id") % 600).otherwise(F.col("id")).alias("key"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        assert joins.hot_keys(fact, "key").where("key < 600").count() == 600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("parts", [30_000, 1_000_000])
def test_hot_keys_where_partitions_outnumber_the_sketch(spark, parts):
    """Keys of 10 rows and single ones; a partition's share is far below one row, or 1.7 rows."""
    n = 50_000 if parts == 30_000 else 100
    df = spark.range(n).select(F.when(F.col("id") < 500, F.col("id") % 50).otherwise(F.col("id")).alias("key")).unionByName(
        spark.createDataFrame([(None,)] * 5, "key bigint"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    joins_at = joins._partitions
    joins._partitions = lambda _: parts      # the session keeps its own number, so that the test need not run so many tasks
    try:
        got = {r.key for r in joins.hot_keys(df, "key").collect()}
    finally:
        joins._partitions = joins_at
    assert spark.conf.get("spark.sql.shuffle.partitions") == old
    assert got == set(range(50))


def test_wide_rows_are_not_small(spark):
    wide = spark.range(50).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 100_000).alias("text"))
    assert not joins.is_small(wide, max_bytes=1 << 20) and joins.is_small(wide)


def test_skew_join_scans_the_fact_once(spark, skewed, tmp_path):
    fact, dim = skewed
    fact.write.parquet(str(tmp_path / "fact"))
    joined = joins.skew_join(spark.read.parquet(str(tmp_path / "fact")), dim, "key", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Location: InMemoryFileIndex") + plan.count("FileScan parquet [key") <= 2
    assert plan.count("FileScan parquet") == 1


def test_sliding_merges_or_refuses(spark):
    base = datetime(2024, 1, 1)
    df = spark.createDataFrame([(base + timedelta(seconds=i), v) for i, v in enumerate((1, 3, 5))], "ts timestamp_ntz, v int")
    size, slide = timedelta(seconds=6), timedelta(seconds=3)
    got = windows.sliding(df, "ts", size, slide, [], {"most": (F.max("v"), F.max), "n": F.count("*")})
    assert {(r.window_start, r.most, r.n) for r in got.collect()} == {(base, 5, 3), (base - slide, 5, 3)}
    with pytest.raises(ValueError):
        windows.sliding(df, "ts", size, slide, [], {"mean": F.avg("v")})


def test_count_missing_keeps_duplicates(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", 2)], "m string, code int")
    right = spark.createDataFrame([("b",), ("b",)], "m string")
    assert rows_of(joins.count_missing(left, right, "m", ["code"])) == [("a", 1, 2), ("c", 2, 1)]


@pytest.mark.parametrize("size,slide", [(6, 3), (6, 6), (10, 1), (7, 3), (5, 4)])
def test_sliding_equals_brute_force(spark, size, slide):
    rng = random.Random(size * 10 + slide)
    base = datetime(2024, 1, 1)
    data = [(base + timedelta(seconds=rng.randint(-40, 40)), rng.choice("xy"), rng.randint(1, 9)) for _ in range(200)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string, v int")
    got = windows.sliding(df, "ts", timedelta(seconds=size), timedelta(seconds=slide), ["k"],
                          {"n": F.count("*"), "total": F.sum("v")})
    want = Counter()
    sums = Counter()
    epoch = datetime(1970, 1, 1)
    for ts, k, v in data:
        second = int((ts - epoch).total_seconds())
        start = second // slide * slide
        while start > second - size:
            key = (epoch + timedelta(seconds=start), k)
            want[key] += 1
            sums[key] += v
            start -= slide
    assert {(r.window_start, r.k): (r.n, r.total) for r in got.collect()} == {k: (want[k], sums[k]) for k in want}
    assert all(r.window_end - r.window_start == timedelta(seconds=size) for r in got.collect())


@pytest.mark.parametrize("size,slide,length", [(300, 1, 4), (7, 3, 1), (4, 7, 1), (6, 6, 1)])
def test_signed_changes_over_many_ranges_equal_the_copies(spark, monkeypatch, size, slide, length):
    """Short ranges, so that most windows reach over a border; null keys, null values, sums of zero, gaps."""
    monkeypatch.setattr(windows, "RANGE_SLIDES", length)
    rng = random.Random(size)
    base = datetime(1969, 12, 31, 23)
    data = [(base + timedelta(seconds=rng.choice([rng.randint(0, 900), rng.randint(4000, 4100)])), rng.choice(["x", "y", None]),
             rng.choice([None, -3, 0, 3]), Decimal(rng.randint(-5, 5)) / 4) for _ in range(150)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string, v int, d decimal(9,2)")
    span = timedelta(seconds=size), timedelta(seconds=slide)
    for keys in (["k"], []):
        measures = {"n": F.count("*"), "total": F.sum("v"), "exact": F.sum("d")}
        parts = windows.buckets(df, "ts", *span, keys, measures).cache()
        got = windows.spread(parts, *span, keys, measures)
        want = windows._fanned(parts, *span, keys, measures)
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        parts.unpersist()


def test_a_bucket_sends_two_rows_however_many_windows_hold_it(spark):
    df = spark.range(50).select(F.timestamp_seconds(F.col("id") * 1000).cast("timestamp_ntz").alias("ts"))
    size, slide = timedelta(seconds=300), timedelta(seconds=1)
    parts = windows.buckets(df, "ts", size, slide, [], {"n": F.count("*")})
    assert parts.count() == 50 and windows.changes(parts, size, slide, [], ["n"]).count() == 100
    out = windows.spread(parts, size, slide, [], {"n": F.count("*")})
    assert out.count() == 50 * 300 and out.agg(F.min("n")).first()[0] == 1     # windows that fell to 0 do not appear
    # windows are listed after the last shuffle only
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sequence(") == 1 and plan.index("sequence(") < plan.index("Exchange")


def test_doubles_are_merged_not_taken_back(spark):
    base = datetime(2024, 1, 1)
    df = spark.createDataFrame([(base, 1e16), (base + timedelta(seconds=1), 1.0)], "ts timestamp_ntz, v double")
    got = windows.sliding(df, "ts", timedelta(seconds=2), timedelta(seconds=1), [], {"v": F.sum("v")})
    assert {r.window_start: r.v for r in got.collect()}[base + timedelta(seconds=1)] == 1.0


def test_alarm_states(spark):
    counts = spark.createDataFrame(
        [("few", 40, 60), ("half", 100, 50), ("over", 100, 51), ("none", 0, 101), ("zero", 0, 0)],
        "name string, success bigint, failure bigint")
    got = {r.name: (r.state, r.ratio) for r in windows.ratio_alarm(counts).collect()}
    assert got == {"few": ("too few", 1.5), "half": ("ok", 0.5), "over": ("alarm", 0.51),
                   "none": ("alarm", None), "zero": ("too few", None)}


def test_alarm_from_entries(spark):
    base = datetime(2024, 1, 1)
    data = [(base + timedelta(seconds=i), s) for i, s in enumerate([200] * 60 + [500] * 50 + [302] * 5)]
    entries = spark.createDataFrame(data, "ts timestamp_ntz, status int")
    got = access_logs.error_alarm(entries, timedelta(minutes=5), timedelta(minutes=5)).collect()
    assert [(r.success, r.failure, r.other, r.state) for r in got] == [(60, 50, 5, "alarm")]


def test_severity_range_is_open_at_start_closed_at_end(spark):
    def at(second, micro=0):
        return datetime(2024, 1, 1, 0, 0, second, micro)
    data = [(at(32), "m", 5), (at(32, 500000), "m", 5), (at(42), "m", 5), (at(42, 1000), "m", 5), (at(40), "m", 1)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, message string, code int")
    assert rows_of(device_logs.severity_counts(df, at(32), at(42), min_code=5)) == [("m", 2)]
    assert rows_of(device_logs.severity_counts(df, at(32), at(42), above=3)) == []


def test_failing_run_difference(spark):
    def run(messages):
        return spark.createDataFrame([(datetime(2024, 1, 1, i), m) for i, m in enumerate(messages)],
                                     "ts timestamp_ntz, message string")
    codes = spark.createDataFrame([("only error", 9)], "message string, code int")
    failing, passing = run(["only error", "both fail", "only error", "crash x"]), run(["both fail"])
    got = device_logs.only_in_failing(failing, passing, codes)
    assert [tuple(r) for r in got.select("message", "occurrences", "code").collect()] == [("crash x", 1, 0), ("only error", 2, 9)]
    late = device_logs.only_in_failing(failing, passing, codes, after=datetime(2024, 1, 1, 1))
    assert {r.message: r.occurrences for r in late.collect()} == {"only error": 1, "crash x": 1}
    assert device_logs.only_in_failing(failing, passing, codes, times=2).count() == 1


def test_dense_index_is_contiguous(spark):
    df = spark.createDataFrame([(f"u{i % 500}",) for i in range(2000)], "user string")
    got = {r.user: r.i for r in indexing.dense_index(df, "user", "i").collect()}
    assert got == {u: i for i, u in enumerate(sorted({f"u{i % 500}" for i in range(2000)}))}
    assert indexing.dense_index(df.limit(0), "user", "i").count() == 0
    holes = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "user string")
    assert {r.user: r.i for r in indexing.dense_index(holes, "user", "i").collect()} == {"a": 0, "b": 1}
    assert dict(indexing.dense_index(df, "user", "i").dtypes)["i"] == "bigint"


def test_positions_follow_the_order_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("v"), (F.col("id") % 3).alias("w")).repartition(7)
        got = indexing.ordered_positions(df, [F.col("w").desc(), "v"], "at")
        rows = [(r.w, r.v) for r in got.orderBy("at").collect()]
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1])) and len(rows) == 3000
    # the rows are read and given their range's start by broadcast; only range sizes meet in one task
    assert "SortMergeJoin" not in plan and plan.count("SinglePartition") == 1


def test_top_breaks_ties(spark):
    df = spark.createDataFrame([(3, 1), (1, 5), (2, 5), (4, 0)], "item int, score int")
    assert [r.item for r in ranking.top(df, 2, "score", ["item"]).collect()] == [1, 2]
    assert [r.item for r in ranking.top(df, 2, "score", ["item"], descending=False).collect()] == [4, 3]


def test_numeric_sums_do_not_overflow(spark):
    df = spark.createDataFrame([("a", 2**62, 0.5), ("a", 2**62, 1.0), ("a", 2**62, 1.0)], "g string, n bigint, x double")
    row = ranking.numeric_sums(df, "g").first()
    assert int(row.sum_n) == 3 * 2**62 and row.sum_x == 2.5


def test_word_modes(lines):
    df = lines(["The cat, the hat", "is YOU a cat?"])
    keep = {r.word: r.occurrences for r in words.word_counts(df, mode="keep").collect()}
    drop = {r.word: r.occurrences for r in words.word_counts(df, mode="drop").collect()}
    assert keep == {"the": 2, "is": 1, "you": 1, "a": 1}
    assert drop == {"cat": 2, "hat": 1}
    with pytest.raises(ValueError):
        words.word_counts(df, mode="other")
