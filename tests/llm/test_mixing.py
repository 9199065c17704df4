import collections
import math

from pyspark.sql import functions as F

from opsledger.llm import mixing


def goals(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by filling up step by step, in plain Python."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level >= most * sizes[s]]
        if not over:
            return full | {s: weight[s] * level for s in open_}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


def test_targets_equal_plain_filling(spark):
    sizes = {"a": 10, "b": 1000, "c": 1000, "d": 1, "é": 50, None: 400, "zero": 0}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    want = goals(sizes)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def test_copies_are_near_targets_and_reruns_agree(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 3)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"))
    got = collections.Counter()
    first = mixing.mixed(docs).collect()
    for r in first:
        got[r.source] += len(r.text.split())
    sized = docs.select("source", mixing.words(F.col("text")).alias("size"))
    for r in mixing.targets(sized).collect():
        assert abs(got[r.source] - r.target) < 0.05 * r.target
        assert got[r.source] <= 2 * r.source_size
    assert sorted(map(tuple, first)) == sorted(map(tuple, mixing.mixed(docs.repartition(5)).collect()))


def test_messy_rows_keep_their_columns(messy):
    got = mixing.mixed(messy)
    assert got.columns == [*messy.columns, "copy_no"]
    assert max(r["count"] for r in got.groupBy("doc_id", "copy_no").count().where("doc_id = 1").collect()) <= 2
    assert got.count() > 0


def test_empty_table(nothing):
    assert mixing.mixed(nothing).count() == 0
