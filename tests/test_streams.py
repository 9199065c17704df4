from datetime import datetime, timedelta

from pyspark.sql import functions as F

from opsledger.operators import windows
from opsledger.plans import access_logs, alerts as alert_plans
from opsledger.session import new_run_dir
from opsledger.sources import streams
from opsledger.streaming import runner, sinks

BASE = datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, topic string, n int"


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def table(spark, folder, *batches):
    """One Parquet file per batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/part{i}")
    return f"{folder}/part*"


def stream(spark, path, delay):
    df = streams.read_stream(spark, "parquet", path, SCHEMA, {"maxFilesPerTrigger": "1"})
    return runner.event_time(df, "ts", delay)


def counts(df):
    return windows.tumbling(df, "ts", timedelta(seconds=10), ["topic"], {"rows": F.count("*"), "total": F.sum("n")})


def plain(rows):
    return sorted((r.window_start.replace(tzinfo=None), r.topic, r.rows, r.total) for r in rows)


BATCHES = (
    [(at(1), "a", 1), (at(12), "a", 2), (at(13), "b", 3)],
    [(at(5), "a", 4), (at(40), "b", 5)],
    [(at(41), "b", 8)],
    [(at(2), "a", 6), (at(55), "a", 7)],      # the first row is late by then
)


def batch_result(spark, *rows):
    return plain(counts(spark.createDataFrame([r for rs in rows for r in rs], SCHEMA)).collect())


def test_update_mode_over_several_batches_equals_batch(spark):
    out = new_run_dir(spark, "u")
    frame = counts(stream(spark, table(spark, f"{out}/in", *BATCHES), "1 day"))
    runner.run_to_end(frame, sinks.batch_table(f"{out}/rows"), f"{out}/cp", "update")
    latest = sinks.read_latest(spark, f"{out}/rows", frame.schema, ["window_start", "topic"])
    assert plain(latest.collect()) == batch_result(spark, *BATCHES)
    assert sinks.read_batches(spark, f"{out}/rows", frame.schema).select("batch_id").distinct().count() == 4


def test_complete_mode_keeps_late_rows_and_append_mode_drops_them(spark):
    out = new_run_dir(spark, "c")
    path = table(spark, f"{out}/in", *BATCHES)
    complete = counts(stream(spark, path, "10 seconds"))
    runner.run_to_end(complete, sinks.latest_table(f"{out}/complete"), f"{out}/cp1", "complete")
    assert plain(sinks.read_newest(spark, f"{out}/complete", complete.schema).collect()) == batch_result(spark, *BATCHES)
    assert sinks.read_newest(spark, f"{out}/none", complete.schema).count() == 0
    assert len(sinks._finished(spark, f"{out}/complete")) == 2      # the newest table and the one before it
    append = counts(stream(spark, path, "10 seconds"))
    runner.run_to_end(append, sinks.batch_table(f"{out}/append"), f"{out}/cp2", "append")
    got = plain(sinks.read_batches(spark, f"{out}/append", append.schema).collect())
    # the watermark ends at second 45: later windows stay open, the late row is gone
    on_time = batch_result(spark, *BATCHES[:3])
    assert got == [w for w in on_time if w[0] + timedelta(seconds=10) <= at(45)]


def test_sliding_stream_equals_batch_form(spark):
    out = new_run_dir(spark, "s")
    size, slide = timedelta(seconds=10), timedelta(seconds=5)
    measures = {"rows": F.count("*"), "total": F.sum("n")}
    frame = windows.sliding(stream(spark, table(spark, f"{out}/in", *BATCHES), None), "ts", size, slide, ["topic"], measures)
    runner.run_to_end(frame, sinks.latest_table(f"{out}/rows"), f"{out}/cp", "complete")
    static = windows.sliding(spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA), "ts", size, slide, ["topic"], measures)
    assert plain(sinks.read_newest(spark, f"{out}/rows", frame.schema).collect()) == plain(static.collect())


def test_alarm_works_on_a_stream(spark):
    out = new_run_dir(spark, "a")
    rows = [(at(i % 9), "x", s) for i, s in enumerate([200] * 60 + [500] * 50)]
    entries = stream(spark, table(spark, f"{out}/in", rows), None).withColumnRenamed("n", "status")
    frame = access_logs.error_alarm(entries, timedelta(seconds=10), timedelta(seconds=10))
    runner.run_to_end(frame, sinks.latest_table(f"{out}/rows"), f"{out}/cp", "complete")
    got = sinks.read_newest(spark, f"{out}/rows", frame.schema).collect()
    assert [(r.success, r.failure, r.state) for r in got] == [(60, 50, "alarm")]


def test_replayed_batch_replaces_itself_and_restart_adds_nothing(spark):
    out = new_run_dir(spark, "r")
    path = table(spark, f"{out}/in", *BATCHES)
    write = sinks.batch_table(f"{out}/rows", topics=["a"])
    frame = stream(spark, path, None)
    runner.run_to_end(frame, write, f"{out}/cp")
    first = sinks.read_batches(spark, f"{out}/rows", frame.schema).count()
    runner.run_to_end(stream(spark, path, None), write, f"{out}/cp")            # same checkpoint: no new input
    runner.run_to_end(stream(spark, path, None), write, f"{out}/fresh")         # true replay of every batch
    again = sinks.read_batches(spark, f"{out}/rows", frame.schema)
    assert first == again.count() == 5
    assert {r.topic for r in again.collect()} == {"a"}


def test_empty_batches_are_skipped_on_request(spark):
    out = new_run_dir(spark, "e")
    empty = spark.createDataFrame([], SCHEMA)
    sinks.batch_table(f"{out}/skip")(empty, 0)
    sinks.batch_table(f"{out}/keep", skip_empty=False)(empty, 0)
    assert sinks.read_batches(spark, f"{out}/keep", empty.schema).count() == 0
    assert sinks.read_batches(spark, f"{out}/skip", empty.schema).count() == 0
    assert sinks.read_latest(spark, f"{out}/skip", empty.schema, ["topic"]).count() == 0


def test_external_table_gets_allowed_topics_only(spark):
    out = new_run_dir(spark, "x")
    write = sinks.external_table("parquet", {"path": f"{out}/rows"}, topics=["b"])
    runner.run_to_end(stream(spark, table(spark, f"{out}/in", *BATCHES), None), write, f"{out}/cp")
    assert sorted(r.n for r in spark.read.parquet(f"{out}/rows").collect()) == [3, 5, 8]


def test_running_totals_with_static_lookup(spark):
    out = new_run_dir(spark, "t")
    data = [("alerts", "2 x|0xA", BASE, "1"), ("alerts", "3 x | 0xa", BASE, "2"), ("alerts", "1 x|0xB", BASE, "3")]
    schema = "topic string, value string, timestamp timestamp_ntz, key string"
    spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{out}/in")
    records = streams.record_stream(streams.read_stream(spark, "parquet", f"{out}/in", schema, {"maxFilesPerTrigger": "1"}))
    alerts = spark.createDataFrame([("0xa", "hot")], "error string, message string")
    frame = alert_plans.totals(alert_plans.parse(records), alerts)
    runner.run_to_end(frame, sinks.batch_table(f"{out}/rows"), f"{out}/cp", "update")
    got = sinks.read_latest(spark, f"{out}/rows", frame.schema, ["error"]).collect()
    assert {(r.error, r.message, r.occurrences) for r in got} == {("0xa", "hot", 5), ("0xb", "", 1)}


def test_scheduled_stream_starts_and_stops(spark):
    out = new_run_dir(spark, "p")
    query = runner.start(stream(spark, table(spark, f"{out}/in", *BATCHES), None), sinks.batch_table(f"{out}/rows"),
                         f"{out}/cp", every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{out}/rows").count() == 8


def test_show_in_memory_and_on_the_console(spark, capfd):
    out = new_run_dir(spark, "m")
    path = table(spark, f"{out}/in", *BATCHES)
    runner.show(counts(stream(spark, path, None)), fmt="memory", name="seen").awaitTermination()
    assert plain(spark.table("seen").collect()) == batch_result(spark, *BATCHES)
    runner.show(counts(stream(spark, path, None)).orderBy("window_start"), rows=5).awaitTermination()


def test_broker_options():
    options = streams.broker_options("host:9092", ["a", "b"])
    assert options == {"kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "startingOffsets": "latest",
                       "failOnDataLoss": "false"}


def test_table_stream_reads_folders_and_exact_names(spark):
    folder = new_run_dir(spark, "tables")
    spark.createDataFrame(BATCHES[0], SCHEMA).repartition(3).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame(BATCHES[0] * 2, SCHEMA).write.parquet(f"{folder}/partsupp.parquet")
    query = (streams.table_stream(spark, folder, "part").writeStream.format("memory").queryName("table_stream_rows")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("table_stream_rows").count() == len(BATCHES[0])
