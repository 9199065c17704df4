"""Registered streaming queries: each runs a real stream to the end of its input.

The oracle is the batch SQL of the same result.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from opsledger.catalog import access_queries as aq, device_queries as dq, sql as q
from opsledger.operators import windows
from opsledger.plans import access_logs as access, alerts as alert_plans, device_logs as logs
from opsledger.session import new_run_dir
from opsledger.sources.files import read_table
from opsledger.sources.streams import line_stream, read_stream, record_stream, table_stream
from opsledger.streaming import lookups, runner, sinks, upserts
from opsledger.testbed import arrivals, tables as t

SIX_HOURS = timedelta(hours=6)
DAY_SECONDS = 86_400
STREAM_FILES = 4
FILE_ROWS = 1_000_000
LATE_EVERY = 37
UPSERT_BATCHES = 20
REPLAYED = (5, 18)
STORED_TOPICS = ("device_1", "device_2", "device_3", "device_10", "device_29")


def _stream_messages(spark, d, delay: str | None = "1 hour") -> DataFrame:
    """The device log as broker records from files, parsed with an event-time watermark."""
    records = record_stream(t.device_records(table_stream(spark, d, "events")))
    parsed = logs.accepted(logs.parse(records, t.YEAR))
    return runner.event_time(parsed, "ts", delay)


def _plain_time(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def stream_tumbling_counts(spark, d):
    """Update mode: only changed windows are written; the newest row per window and key is the result."""
    out = new_run_dir(spark, "stream-tumbling")
    counts = windows.tumbling(_stream_messages(spark, d), "ts", SIX_HOURS, ["message"], {"occurrences": F.count("*")})
    runner.run_to_end(counts, sinks.batch_table(f"{out}/rows"), f"{out}/checkpoint", "update")
    rows = sinks.read_latest(spark, f"{out}/rows", counts.schema, ["window_start", "message"])
    return _plain_time(rows.select("window_start", "message", "occurrences"), "window_start")


def _late_run(spark, d) -> tuple[str, DataFrame]:
    """Sliding counts in append mode over slices that arrive one after the other, some rows two slices late."""
    out = new_run_dir(spark, "stream-append")
    events = read_table(spark, d, "events")
    sliced = arrivals.slice_of(events, late=F.col("event_id") % LATE_EVERY == 5)
    counts = None

    def run(_: int) -> None:
        nonlocal counts
        stream = read_stream(spark, "parquet", f"{out}/in/slice*", events.schema)
        parsed = logs.accepted(logs.parse(record_stream(t.device_records(stream)), t.YEAR))
        counts = windows.sliding(runner.event_time(parsed, "ts", "1 hour"), "ts", SIX_HOURS, timedelta(hours=3), ["topic"],
                                 {"occurrences": F.count("*")})
        done = runner.run_to_end(counts, sinks.batch_table(f"{out}/rows"), f"{out}/checkpoint", "append")
        runner.store_progress(spark, done, f"{out}/progress")

    arrivals.deliver(sliced, f"{out}/in", run)
    return out, counts


def stream_append_late(spark, d):
    """Append mode: only windows the watermark has closed are written, once each, without what came too late for them."""
    out, counts = _late_run(spark, d)
    rows = sinks.read_batches(spark, f"{out}/rows", counts.schema)
    return _plain_time(rows.select("window_start", "topic", "occurrences"), "window_start")


def stream_late_batches(spark, d):
    """What the stream's own progress says of each slice: rows read, and whether the watermark dropped any."""
    out, _ = _late_run(spark, d)
    runs = spark.read.schema(runner.PROGRESS).parquet(f"{out}/progress").where("input_rows > 0")
    place = F.row_number().over(Window.orderBy("batch_id")) - 1
    return runs.select(place.cast("bigint").alias("slice"), "input_rows", "late")


def stream_upserts(spark, d):
    """Totals per user over twenty micro-batches, kept by key: compacted on the way, two batches replayed at the end."""
    out = new_run_dir(spark, "stream-upserts")
    events = read_table(spark, d, "events")
    events.repartition(UPSERT_BATCHES).write.parquet(f"{out}/in")
    stream = read_stream(spark, "parquet", f"{out}/in", events.schema, {"maxFilesPerTrigger": "1"})
    totals = stream.groupBy("user_id").agg(F.count("*").alias("events"), F.sum(F.floor("value")).cast("bigint").alias("total"))
    table = upserts.UpsertTable(f"{out}/table", totals.schema, ["user_id"])
    put = table.writer()

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id in REPLAYED:
            batch.write.mode("overwrite").parquet(f"{out}/kept/{batch_id}")
        put(batch, batch_id)

    runner.run_to_end(totals, write, f"{out}/checkpoint", "update")
    for batch_id in REPLAYED:       # one from before the last compaction, one from after it
        put(spark.read.schema(totals.schema).parquet(f"{out}/kept/{batch_id}"), batch_id)
    return table.read(spark)


def stream_lookup_changes(spark, d):
    """Events per micro-batch and customer segment, with a lookup that gains its odd keys between batch 1 and 2.

    Batch 1 is replayed at the end and still meets the lookup it met first.
    """
    out = new_run_dir(spark, "stream-lookup")
    events = read_table(spark, d, "events")
    customers = read_table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    lookup = lookups.VersionedLookup(f"{out}/customers", "user_id")
    write = lookup.through(sinks.batch_table(f"{out}/rows"), lambda rows: rows.groupBy("segment").agg(F.count("*").alias("events")))
    sliced = arrivals.slice_of(events)

    def run(i: int) -> None:
        if i == 0:
            lookup.publish(customers.where("user_id % 2 = 0"))
        if i == 2:
            lookup.publish(customers)
        stream = read_stream(spark, "parquet", f"{out}/in/slice*", events.schema)
        runner.run_to_end(stream.select("user_id"), write, f"{out}/checkpoint")

    arrivals.deliver(sliced, f"{out}/in", run)
    write(spark.read.parquet(f"{out}/in/slice1").select("user_id"), 1)
    return sinks.read_batches(spark, f"{out}/rows", spark.createDataFrame([], "segment string, events bigint").schema)


def stream_foreach_batch(spark, d):
    """Micro-batches of allow-listed topics, one replaceable folder per batch."""
    out = new_run_dir(spark, "stream-batches")
    messages = _stream_messages(spark, d, None).select("topic", "message", "char_count", "key")
    runner.run_to_end(messages, sinks.batch_table(f"{out}/rows", topics=STORED_TOPICS), f"{out}/checkpoint")
    rows = sinks.read_batches(spark, f"{out}/rows", messages.schema)
    return rows.groupBy("topic").agg(F.count("*").alias("lines"), F.sum("char_count").alias("chars"))


def _stream_entries(spark, d, folder: str, delay: str | None) -> DataFrame:
    """Access-log text files, written from the tables in order of time, as a stream of one file per micro-batch."""
    events = read_table(spark, d, "events")
    timed = t.access_lines(events, read_table(spark, d, "pages")).join(
        events.select(F.col("event_id").alias("key"), "ts"), "key")
    # a file stays small; a micro-batch takes its share of them
    each = max(1, -(-events.count() // (STREAM_FILES * FILE_ROWS)))
    arrivals.in_order(timed, "ts", f"{folder}/lines", STREAM_FILES * each)
    lines = line_stream(spark, f"{folder}/lines", maxFilesPerTrigger=str(each))
    return runner.event_time(access.accepted(access.parse(lines)), "ts", delay)


def stream_status_hourly(spark, d):
    """Update mode: changed hours are written into their day, compactions rewrite touched days only, and the reader
    orders the rows from the number of rows per day."""
    out = new_run_dir(spark, "stream-status")
    counts = access.status_hourly(_stream_entries(spark, d, f"{out}/in", "1 hour"))
    table = upserts.UpsertTable(f"{out}/table", counts.schema, ["window_start", "status"],
                                upserts.range_of("window_start", DAY_SECONDS), compact_every=3)
    runner.run_to_end(counts, table.writer(), f"{out}/checkpoint", "update")
    rows = table.read_ordered(spark, ["window_start", "status"])
    return _plain_time(rows.select("window_start", "status", "requests"), "window_start")


def stream_status_complete(spark, d):
    """Complete mode: the ordered table is replaced by every micro-batch, for small results."""
    out = new_run_dir(spark, "stream-complete")
    entries = _stream_entries(spark, d, f"{out}/in", None)
    counts = access.status_hourly(entries).orderBy("window_start", "status")
    runner.run_to_end(counts, sinks.latest_table(f"{out}/rows"), f"{out}/checkpoint", "complete")
    rows = sinks.read_newest(spark, f"{out}/rows", counts.schema)
    return _plain_time(rows.select("window_start", "status", "requests"), "window_start")


def stream_top_urls(spark, d):
    """Sliding URL counts: the state holds slide-sized parts, each micro-batch writes its changed parts, and the
    reader makes the windows, sorted by count."""
    out = new_run_dir(spark, "stream-urls")
    size, slide = SIX_HOURS, timedelta(hours=3)
    parts = access.url_buckets(_stream_entries(spark, d, f"{out}/in", "1 hour"), size, slide)
    runner.run_to_end(parts, sinks.batch_table(f"{out}/rows"), f"{out}/checkpoint", "update")
    rows = sinks.read_latest(spark, f"{out}/rows", parts.schema, ["bucket_start", "url"])
    counts = access.url_windows(rows, size, slide).orderBy(F.col("requests").desc(), "window_start", "url")
    return _plain_time(counts.select("window_start", "url", "requests"), "window_start")


def stream_error_alarm(spark, d):
    """The error-ratio alarm per sliding window over the slide-sized parts that the stream keeps."""
    out = new_run_dir(spark, "stream-alarm")
    size, slide = timedelta(days=1), timedelta(hours=6)
    parts = access.outcome_buckets(_stream_entries(spark, d, f"{out}/in", "1 hour"), size, slide)
    runner.run_to_end(parts, sinks.batch_table(f"{out}/rows"), f"{out}/checkpoint", "update")
    rows = sinks.read_latest(spark, f"{out}/rows", parts.schema, ["bucket_start"])
    return _plain_time(access.alarm_windows(rows, size, slide).drop("window_end"), "window_start")


def stream_repeated_messages(spark, d):
    """Update mode with a bound on the counts; the reader gives the newest window first."""
    out = new_run_dir(spark, "stream-repeated")
    counts = logs.message_windows(_stream_messages(spark, d, "2 seconds"), SIX_HOURS)
    table = upserts.UpsertTable(f"{out}/table", counts.schema, ["window_start", "message"],
                                upserts.range_of("window_start", DAY_SECONDS))
    runner.run_to_end(counts, table.writer(), f"{out}/checkpoint", "update")
    rows = table.read_ordered(spark, [F.col("window_start").desc(), F.col("occurrences").desc(), "message"], descending=True)
    return _plain_time(rows.select("window_start", "message", "occurrences"), "window_start")


def stream_alert_totals(spark, d):
    """Running totals without a window, alert wording joined from a static table."""
    out = new_run_dir(spark, "stream-alerts")
    records = record_stream(t.alert_records(table_stream(spark, d, "events")))
    totals = alert_plans.totals(alert_plans.parse(records), dq.alert_dim(spark, d))
    runner.run_to_end(totals, sinks.batch_table(f"{out}/rows"), f"{out}/checkpoint", "update")
    return sinks.read_latest(spark, f"{out}/rows", totals.schema, ["error"]).select("error", "message", "occurrences")


def stream_device_windows(spark, d):
    """The windowed, enriched device counts as a stream (update mode, upsert by window and key)."""
    out = new_run_dir(spark, "stream-devices")
    counts = logs.device_windows(_stream_messages(spark, d, "20 seconds"), dq.codes(spark), dq.devices(spark, d), SIX_HOURS)
    runner.run_to_end(counts, sinks.batch_table(f"{out}/rows"), f"{out}/checkpoint", "update")
    rows = sinks.read_latest(spark, f"{out}/rows", counts.schema, ["window_start", "topic", "message"])
    return _plain_time(rows, "window_start")


def stream_batch_averages(spark, d):
    """Per micro-batch: average length of error messages by topic; the input arrives in slices of time, one per batch."""
    out = new_run_dir(spark, "stream-averages")
    events = read_table(spark, d, "events")

    def averages(batch: DataFrame) -> DataFrame:
        return logs.average_length(batch, ["topic"])

    def messages(frame: DataFrame) -> DataFrame:
        parsed = logs.accepted(logs.parse(record_stream(t.device_records(frame)), t.YEAR))
        return parsed.select("topic", "message", "char_count")

    def run(_: int) -> None:
        stream = read_stream(spark, "parquet", f"{out}/in/slice*", events.schema)
        runner.run_to_end(messages(stream), sinks.batch_table(f"{out}/rows", prepare=averages), f"{out}/checkpoint")

    arrivals.deliver(arrivals.slice_of(events), f"{out}/in", run)
    rows = sinks.read_batches(spark, f"{out}/rows", averages(messages(events.limit(0))).schema)
    return rows.select("batch_id", "topic", "average_chars")


QUERIES = {
    f.__name__: f for f in (
        stream_tumbling_counts, stream_append_late, stream_late_batches, stream_upserts, stream_lookup_changes,
        stream_foreach_batch, stream_status_hourly, stream_status_complete, stream_top_urls,
        stream_error_alarm, stream_repeated_messages, stream_alert_totals,
        stream_device_windows, stream_batch_averages,
    )
}

_TOPICS = ", ".join(f"'{x}'" for x in STORED_TOPICS)

# the slice in which an event is due, and the one in which it arrives
_ARRIVED = f"""
    ends AS (SELECT min(epoch_us(ts) // 1000000) AS first, max(epoch_us(ts) // 1000000) AS last FROM events),
    due_events AS (SELECT event_id, user_id AS u, CAST((epoch_us(ts) // 1000000 - first) * 4 // (last - first + 1) AS INTEGER) AS due
      FROM events, ends),
    arrived AS (SELECT *, CASE WHEN event_id % {LATE_EVERY} = 5 THEN least(due + 2, 3) ELSE due END AS arrival FROM due_events)"""
# a copy of a row per window, late where its window was closed by what had arrived in earlier slices
_LATE = f"""{q.DEVICE_PARSED}, {_ARRIVED},
    sent AS (SELECT topic, ts, arrival FROM good JOIN arrived ON "key" = event_id),
    marks AS (SELECT a AS arrival, (SELECT max(epoch_ms(ts)) - 3600000 FROM sent WHERE arrival < a) AS mark FROM range(4) r(a)),
    copies AS (SELECT topic, arrival, w, mark IS NULL OR (w + 21600) * 1000 > mark AS in_time
      FROM (SELECT topic, arrival, {q.window_starts('ts', 21600, 10800)} AS w FROM sent) JOIN marks USING (arrival)),
    closed AS (SELECT max(epoch_ms(ts)) - 3600000 AS watermark_ms FROM sent)"""

SQL = {
    "stream_tumbling_counts": f"""WITH {q.DEVICE_PARSED},
        spread AS (SELECT message, {q.window_starts('ts', 21600, 21600)} AS w FROM good)
        SELECT {q.instant('w')} AS window_start, message, count(*) AS occurrences FROM spread GROUP BY w, message""",
    "stream_append_late": f"""WITH {_LATE}
        SELECT {q.instant('w')} AS window_start, topic, count(*) AS occurrences FROM copies, closed
        WHERE (w + 21600) * 1000 <= watermark_ms AND in_time GROUP BY w, topic""",
    "stream_late_batches": f"""WITH {_LATE},
        late AS (SELECT arrival, bool_or(NOT in_time) AS late FROM copies GROUP BY arrival)
        SELECT CAST(arrival AS BIGINT) AS slice, count(*) AS input_rows, coalesce(any_value(late), false) AS late
        FROM arrived LEFT JOIN late USING (arrival) GROUP BY arrival""",
    "stream_upserts": """SELECT user_id, count(*) AS events, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total
        FROM events GROUP BY user_id""",
    "stream_lookup_changes": f"""WITH {_ARRIVED},
        named AS (SELECT arrival, CASE WHEN due > 1 OR u % 2 = 0 THEN c_mktsegment END AS segment
          FROM (SELECT *, due AS arrival FROM due_events) LEFT JOIN customer ON c_custkey = u)
        SELECT CAST(arrival AS BIGINT) AS batch_id, segment, count(*) AS events FROM named GROUP BY ALL""",
    "stream_foreach_batch": f"""WITH {q.DEVICE_PARSED}
        SELECT topic, count(*) AS lines, CAST(sum(char_count) AS BIGINT) AS chars FROM good
        WHERE topic IN ({_TOPICS}) GROUP BY topic""",
    "stream_status_hourly": f"""WITH {q.ACCESS_LINES}
        SELECT date_trunc('hour', ts) AS window_start, status, count(*) AS requests FROM entries GROUP BY 1, 2""",
    "stream_status_complete": f"""WITH {q.ACCESS_LINES}
        SELECT date_trunc('hour', ts) AS window_start, status, count(*) AS requests FROM entries GROUP BY 1, 2""",
    "stream_top_urls": aq.SQL["top_urls_sliding"],
    "stream_error_alarm": aq.alarm_sql(86400, 21600),
    "stream_repeated_messages": dq.SQL["message_counts_tumbling"],
    "stream_alert_totals": f"WITH {dq.ALERT_SQL} SELECT error, message, occurrences FROM alert_rows",
    "stream_device_windows": dq.SQL["device_windows_enriched"],
    "stream_batch_averages": f"""WITH {q.DEVICE_PARSED}, {_ARRIVED}
        SELECT CAST(due AS BIGINT) AS batch_id, topic, avg(char_count) AS average_chars FROM good JOIN due_events ON "key" = event_id
        WHERE lower(message) LIKE '%error%' GROUP BY due, topic""",
}
