from pyspark.sql import functions as F

from opsledger.operators import balance
from opsledger.plans import device_logs
from opsledger.session import new_run_dir
from opsledger.sources import dimensions, streams


def parse(lines):
    return lines.withColumn("n", F.col("value").try_cast("int")).withColumn("parse_error", F.when(F.col("n").isNull(), "no number"))


def test_both_outputs_and_counts_come_from_one_job(spark, lines):
    done = balance.split(lines(["1", "x", "3", None, ""]), parse)
    assert sorted(r.n for r in done.accepted.collect()) == [1, 3]
    assert {(r.value, r.parse_error) for r in done.rejected.collect()} == {("x", "no number"), (None, "no number"), ("", "no number")}
    assert tuple(done.balance.first()) == (5, 2, 3)
    kinds = {r.kind: r.rows for r in done.report("position").where("kind <> 'line'").collect()}
    assert kinds == {"input": 5, "accepted": 2, "rejected": 3} and done.report("position").count() == 6


def test_lost_and_multiplied_lines_do_not_balance(spark, lines):
    twice = balance.split(lines(["1", "x"]), lambda df: parse(df.unionByName(df.where("value = '1'"))))
    row = twice.balance.first()
    assert row.accepted + row.rejected == 3
    assert tuple(balance.split(lines(["1"]).limit(0), parse).balance.first()) == (0, 0, 0)
    lost = balance.split(lines(["1", "x"]), lambda df: parse(df.where("value = '1'"))).balance.first()
    assert lost.accepted + lost.rejected == 1 < lost.input


def test_lookup_and_sentence_lines_that_fail(spark, lines):
    df = lines(["a, 1", "b", "c, x", None])
    assert sorted(r.position for r in dimensions.parse_codes(df).where("parse_error IS NOT NULL").collect()) == [1, 2, 3]
    names = dimensions.parse_names(lines(['1 "A"', "2", 'x "B"', None]))
    assert {r.position: r.parse_error for r in names.collect()} == {0: None, 1: "no name", 2: "no id", 3: "no name"}
    found = device_logs.parse_sentences(lines(["<2024-01-01 00:00:00.000000> 7 Fine.", "<2024-13-01 00:00:00.000000> 7 Bad.", "x", None]))
    assert [r.parse_error for r in found.orderBy("position").collect()] == [None, "bad time", "bad line", "bad line"]


def test_stream_source_hands_options_on(spark):
    class Reader:
        def __init__(self):
            self.seen = []

        def format(self, name):
            self.seen.append(name)
            return self

        def options(self, **given):
            self.seen.append(given)
            return self

        def load(self, *path):
            return self.seen, path

    class Session:
        readStream = Reader()

    options = streams.broker_options("a:1,b:2", ["x", "y"], "earliest", True)
    assert streams.read_stream(Session(), "kafka", options=options) == (["kafka", {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "x,y", "startingOffsets": "earliest", "failOnDataLoss": "true"}], ())
    assert new_run_dir(spark, "x") != new_run_dir(spark, "x")
