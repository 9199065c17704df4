"""Registered device-log and alert queries with their oracle SQL."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsledger.catalog import sql as q
from opsledger.functions import cleaning, device_log as dl
from opsledger.operators import balance
from opsledger.plans import alerts as alert_plans, device_logs as logs
from opsledger.session import new_run_dir
from opsledger.sources import dimensions, files
from opsledger.sources.files import read_table
from opsledger.testbed import tables as t

SPLIT = datetime(2024, 1, 16)
RANGE = (datetime(2024, 1, 5, 6), datetime(2024, 1, 25, 18))
SIX_HOURS, THREE_HOURS, DAY = timedelta(hours=6), timedelta(hours=3), timedelta(days=1)


def records(spark: SparkSession, d: str) -> DataFrame:
    return t.device_records(read_table(spark, d, "events"))


def messages(spark: SparkSession, d: str) -> DataFrame:
    return logs.accepted(logs.parse(records(spark, d), t.YEAR))


def codes(spark: SparkSession) -> DataFrame:
    return dimensions.error_codes(t.error_code_lines(spark))


def devices(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.devices(t.device_lines(read_table(spark, d, "nation"), read_table(spark, d, "region")))


def alert_dim(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.alerts(t.alert_lines(read_table(spark, d, "nation")))


def _runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The passing and the failing run: log lines before and since the split day."""
    everything = records(spark, d)
    early = everything.where(F.col("timestamp") < F.lit(SPLIT.isoformat()).cast("timestamp_ntz"))
    late = everything.where(F.col("timestamp") >= F.lit(SPLIT.isoformat()).cast("timestamp_ntz"))
    return logs.run_messages(early, t.YEAR), logs.run_messages(late, t.YEAR)


def device_log_parse(spark, d):
    return messages(spark, d).select("key", "topic", "ts", "message", "char_count")


def device_log_rejects(spark, d):
    return logs.rejected(logs.parse(records(spark, d), t.YEAR)).select("key", "value", "parse_error")


def device_log_forms(spark, d):
    value = F.col("value")
    return records(spark, d).select(
        "key",
        cleaning.without_digits(dl.message(value, "letter")).alias("letter_form"),
        F.trim(cleaning.without_digits(dl.message(value, "word"))).alias("word_form"),
        dl.event_time(value, t.YEAR, 3, 3).alias("milli_time"),
    )


def message_normalize(spark, d):
    raw = dl.message(F.col("value"))
    return records(spark, d).where(raw.isNotNull()).select(
        "key",
        F.trim(cleaning.normalised_message(raw)).alias("with_ids"),
        F.trim(cleaning.normalised_message(raw, drop_ids=True)).alias("without_ids"),
    )


def error_code_lookup(spark, d):
    coded = logs.with_codes(messages(spark, d), codes(spark))
    return coded.where(F.col("code") >= 100_000).groupBy("message", "code").agg(F.count("*").alias("occurrences"))


def device_enrich(spark, d):
    return logs.with_devices(messages(spark, d), devices(spark, d)).select("key", "topic", "ip", "realm", "model")


def device_lookup_files(spark, d):
    """Device lines in several text files, later files with newer lines of the same devices; the last line wins."""
    folder = new_run_dir(spark, "device-lines")
    lines = t.device_lines(read_table(spark, d, "nation"), read_table(spark, d, "region"))
    old = lines.select(F.concat("value", F.lit(" old")).alias("value"))
    half = lines.where(F.col("position") % 2 == 0)
    for name, part in (("a", old), ("b", lines.select("value")), ("c", half.select(F.concat("value", F.lit(" new"))))):
        part.coalesce(1).write.text(f"{folder}/{name}")
    read = dimensions.devices(files.read_ordered_lines(spark, [f"{folder}/{name}" for name in "abc"]))
    return read.select("topic", "ip", "realm", "model")


def device_line_rejects(spark, d):
    """Device lines of which every fourth has lost its last field."""
    lines = t.device_lines(read_table(spark, d, "nation"), read_table(spark, d, "region"))
    cut = F.when(F.col("position") % 4 == 0, F.regexp_replace("value", ", [^,]*$", "")).otherwise(F.col("value"))
    return dimensions.rejected_devices(lines.withColumn("value", cut)).select("value", "parse_error")


def alert_rejects(spark, d):
    """Alert payloads of which some have lost their code mark or their number."""
    value, key = F.col("value"), F.col("key")
    damaged = F.when(key % 7 == 0, F.translate(value, "|", "/")).when(key % 11 == 0, F.concat(F.lit("x"), value)).otherwise(value)
    records_ = t.alert_records(read_table(spark, d, "events")).withColumn("value", damaged)
    return alert_plans.rejected(records_).select("key", "parse_error")


def sentence_rejects(spark, d):
    """Bracketed lines of one parse: the rejected ones and the balance of the same job."""
    return balance.split(t.sentence_lines(read_table(spark, d, "events")), logs.parse_sentences).report("key")


def run_message_rejects(spark, d):
    """Lines of both runs without a message, and the balance of the job that found the others."""
    return balance.split(records(spark, d), lambda lines: logs.parse_run(lines, t.YEAR)).report("key")


def lookup_rejects(spark, d):
    """Codes, alerts and names read from text files that grow with the tables, each with its rejected lines and balance."""
    found = None
    for name, lines, parse in (
        ("codes", t.part_code_lines(read_table(spark, d, "part")), dimensions.parse_codes),
        ("alerts", t.supplier_alert_lines(read_table(spark, d, "supplier")), dimensions.parse_alerts),
        ("names", t.customer_name_lines(read_table(spark, d, "customer")), dimensions.parse_names),
    ):
        folder = new_run_dir(spark, f"{name}-lines")
        lines.write.text(folder)
        report = balance.split(files.read_ordered_lines(spark, folder), parse).report().withColumn("lookup", F.lit(name))
        found = report if found is None else found.unionByName(report)
    return found


def lookup_tables(spark, d):
    """The same files as lookup tables: rows per lookup, and of alerts the wordings."""
    def read(lines, name):
        folder = new_run_dir(spark, f"{name}-table")
        lines.write.text(folder)
        return files.read_ordered_lines(spark, folder)

    codes_ = dimensions.error_codes(read(t.part_code_lines(read_table(spark, d, "part")), "codes"))
    alerts_ = dimensions.alerts(read(t.supplier_alert_lines(read_table(spark, d, "supplier")), "alerts"))
    names_ = dimensions.quoted_names(read(t.customer_name_lines(read_table(spark, d, "customer")), "names"))
    return codes_.select(F.lit("codes").alias("lookup"), F.col("message").alias("key"), F.col("code").cast("string").alias("found")) \
        .unionByName(alerts_.select(F.lit("alerts").alias("lookup"), F.col("error").alias("key"), F.col("message").alias("found"))) \
        .unionByName(names_.select(F.lit("names").alias("lookup"), F.col("node").cast("string").alias("key"), F.col("name").alias("found")))


def severity_range_counts(spark, d):
    coded = logs.with_codes(messages(spark, d), codes(spark))
    return logs.severity_counts(coded, *RANGE)


def failing_not_in_passing(spark, d):
    passing, failing = _runs(spark, d)
    return logs.only_in_failing(failing, passing, codes(spark)).select("message", "occurrences", "code")


def log_line_counts(spark, d):
    since = F.col("timestamp") >= F.lit(SPLIT.isoformat()).cast("timestamp_ntz")
    return logs.run_counts(logs.run_messages(records(spark, d), t.YEAR), since)


def log_search_fragments(spark, d):
    return logs.search(records(spark, d), t.ERROR_PATTERNS["bound error"]).select("key", "value")


def log_word_filter(spark, d):
    return logs.word_filter(records(spark, d), drop=5).select("key", "text")


def thin_one_per_second(spark, d):
    return logs.one_per_clock_second(records(spark, d), "svc_purchase", ["timestamp", "key"]).select("clock", "text")


def pattern_table_counts(spark, d):
    return logs.pattern_counts(records(spark, d), t.ERROR_PATTERNS)


def errors_sliding(spark, d):
    labelled = logs.labelled_errors(records(spark, d), drop=4)
    similar = labelled.withColumn("text", cleaning.similar_message(F.col("text")))
    return logs.windows.sliding(similar, "timestamp", DAY, SIX_HOURS, ["text"], {"occurrences": F.count("*")}).select(
        "window_start", "text", "occurrences"
    )


def avg_error_length_by_topic(spark, d):
    daily = messages(spark, d).withColumn("day", F.to_date("ts"))
    return logs.average_length(daily, ["day", "topic"]).orderBy("day", "average_chars", "topic")


def avg_by_topic_sliding(spark, d):
    return logs.average_length_sliding(messages(spark, d), SIX_HOURS, THREE_HOURS, ["topic"]).select(
        "window_start", "topic", "average_chars"
    )


def message_counts_tumbling(spark, d):
    counts = logs.message_windows(messages(spark, d), SIX_HOURS)
    return counts.select("window_start", "message", "occurrences").orderBy(
        F.col("window_start").desc(), F.col("occurrences").desc(), "message"
    )


def device_windows_enriched(spark, d):
    out = logs.device_windows(messages(spark, d), codes(spark), devices(spark, d), SIX_HOURS)
    return out.orderBy(F.col("window_start").desc(), F.col("occurrences").desc(), "topic", "message")


def sentence_windows(spark, d):
    lines = t.sentence_lines(read_table(spark, d, "events"))
    counts = logs.windows.tumbling(logs.coded_sentences(lines), "ts", SIX_HOURS, ["text"],
                                   {"occurrences": F.count("*"), "code": F.sum("code")})
    return counts.select("window_start", "text", "occurrences", "code")


def alert_totals(spark, d):
    parsed = alert_plans.parse(t.alert_records(read_table(spark, d, "events")))
    return alert_plans.totals(parsed, alert_dim(spark, d)).orderBy(F.col("occurrences").desc(), "error")


QUERIES = {
    f.__name__: f for f in (
        device_log_parse, device_log_rejects, device_log_forms, message_normalize, error_code_lookup,
        device_enrich, device_lookup_files, device_line_rejects, alert_rejects,
        sentence_rejects, run_message_rejects, lookup_rejects, lookup_tables, severity_range_counts, failing_not_in_passing, log_line_counts, log_search_fragments,
        log_word_filter, thin_one_per_second, pattern_table_counts, errors_sliding, avg_error_length_by_topic,
        avg_by_topic_sliding, message_counts_tumbling, device_windows_enriched, sentence_windows, alert_totals,
    )
}

_RUNS = q.DEVICE_PARSED + f""",
run_lines AS (
  SELECT {q.NORMAL_MESSAGE.format(raw='raw')} AS message, event_ts < TIMESTAMP '2024-01-16' AS early
  FROM parsed WHERE raw IS NOT NULL
),
runs AS (SELECT * FROM run_lines WHERE regexp_matches(lower(message), 'error|warning|fail|crash')),
missing AS (
  SELECT f.message, count(*) AS occurrences FROM runs f
  WHERE NOT f.early AND NOT EXISTS (SELECT 1 FROM runs p WHERE p.early AND p.message = f.message)
  GROUP BY f.message
),"""
_TOKENS = r"regexp_split_to_array(value, '\s+')"

ALERT_SQL = """
ev AS (SELECT CAST(floor(value) AS BIGINT) AS n, user_id % 30 AS k FROM events),
per_code AS (
  SELECT '0x0100' || lpad(CAST(k AS VARCHAR), 4, '0') AS error, k, CAST(sum(n) AS BIGINT) AS occurrences
  FROM ev GROUP BY k
),
alert_rows AS (
  SELECT error, occurrences,
    CASE WHEN n_name IS NULL THEN '' WHEN k = 7 THEN 'Did Not match Regex' WHEN k % 5 = 0 THEN 'No Eng Message'
         ELSE 'Inspect ' || n_name || ', then retry' END AS message
  FROM per_code LEFT JOIN nation ON n_nationkey = k)"""

_CODE_LINES = """code_lines AS (SELECT CASE WHEN p_partkey % 5 = 0 THEN p_name || ', none'
    ELSE p_name || ' error ' || p_brand || ', ' || (100000 + p_partkey) || ', lab' END AS value, p_partkey AS k FROM part)"""
_ALERT_LINES = """alert_lines AS (SELECT CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey AS VARCHAR)
    ELSE s_suppkey || ',0x0100' || s_suppkey || ',FAMILY,' || s_name || ',watch.cpp,Error,TRUE,'
      || CASE WHEN s_suppkey % 9 = 1 THEN 'MAYBE' ELSE 'TRUE' END || ',TRUE,stops,"Check it, please",FALSE,'
      || CASE WHEN s_suppkey % 5 = 1 THEN '' ELSE '"Inspect ' || s_name || ', then retry"' END END AS value, s_suppkey AS k FROM supplier)"""
_NAME_LINES = """name_lines AS (SELECT CASE WHEN c_custkey % 6 = 0 THEN CAST(c_custkey AS VARCHAR) WHEN c_custkey % 7 = 0 THEN 'x' || c_custkey || ' "' || c_name || '"'
    ELSE c_custkey || ' "' || c_name || '"' END AS value, c_custkey AS k FROM customer)"""


def _report(lookup: str, table: str, bad: str, reason: str) -> str:
    counts = {"input": "true", "accepted": f"NOT ({bad})", "rejected": bad}
    parts = [f"SELECT '{lookup}' AS lookup, 'line' AS kind, value, {reason} AS reason, CAST(1 AS BIGINT) AS rows FROM {table} WHERE {bad}"]
    parts += [f"SELECT '{lookup}', '{kind}', NULL, NULL, count(*) FILTER (WHERE {test}) FROM {table}" for kind, test in counts.items()]
    return " UNION ALL ".join(parts)


def _keyed_report(table: str, bad: str, reason: str) -> str:
    counts = {"input": "true", "accepted": f"NOT ({bad})", "rejected": bad}
    parts = [f"""SELECT 'line' AS kind, "key", value, {reason} AS reason, CAST(1 AS BIGINT) AS rows FROM {table} WHERE {bad}"""]
    parts += [f"SELECT '{kind}', NULL, NULL, NULL, count(*) FILTER (WHERE {test}) FROM {table}" for kind, test in counts.items()]
    return " UNION ALL ".join(parts)


SQL = {
    "sentence_rejects": f"""WITH ev AS (SELECT event_id, ts, event_type, CAST(floor(value) AS BIGINT) AS v FROM events),
        lines AS (SELECT event_id AS "key", '<' || CASE WHEN v % 11 = 3 THEN 'no-stamp' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END || '> '
          || v || ' The ' || event_type || ' took ' || chr(CAST(97 + v % 26 AS INTEGER)) || '.' AS value, v FROM ev)
        {_keyed_report('lines', 'v % 11 = 3', "'bad line'")}""",
    "run_message_rejects": f"""WITH {q.DEVICE_PARSED} {_keyed_report('parsed', 'raw IS NULL', "'no message'")}""",
    "lookup_rejects": f"""WITH {_CODE_LINES}, {_ALERT_LINES}, {_NAME_LINES}
        {_report('codes', 'code_lines', 'k % 5 = 0', "'no code'")}
        UNION ALL {_report('alerts', 'alert_lines', 'k % 4 = 0', "'no code'")}
        UNION ALL {_report('names', 'name_lines', 'k % 6 = 0 OR k % 7 = 0', "CASE WHEN k % 6 = 0 THEN 'no name' ELSE 'no id' END")}""",
    "lookup_tables": r"""WITH named AS (SELECT trim(regexp_replace(p_name || ' error ' || p_brand, '\d', '', 'g')) AS message, p_partkey FROM part WHERE p_partkey % 5 <> 0)
        SELECT 'codes' AS lookup, message AS key, CAST(100000 + max(p_partkey) AS VARCHAR) AS found FROM named GROUP BY message
        UNION ALL SELECT 'alerts', '0x0100' || s_suppkey, CASE WHEN s_suppkey % 9 = 1 THEN 'Did Not match Regex' WHEN s_suppkey % 5 = 1 THEN 'No Eng Message'
          ELSE 'Inspect ' || s_name || ', then retry' END FROM supplier WHERE s_suppkey % 4 <> 0
        UNION ALL SELECT 'names', CAST(c_custkey AS VARCHAR), c_name FROM customer WHERE c_custkey % 6 <> 0 AND c_custkey % 7 <> 0""",
    "device_log_parse": f'WITH {q.DEVICE_PARSED} SELECT "key", topic, ts, message, char_count FROM good',
    "device_log_rejects": f"""WITH {q.DEVICE_PARSED}
        SELECT "key", value, CASE WHEN ts IS NULL THEN 'no timestamp' ELSE 'no message' END AS parse_error
        FROM parsed WHERE ts IS NULL OR message IS NULL""",
    "device_log_forms": rf"""WITH {q.DEVICE_PARSED}, t AS (
        SELECT *, regexp_extract(value, '(\d\d-\d\d\s\d\d:\d\d:\d\d\.\d\d\d)', 1) AS milli FROM parsed)
        SELECT "key",
          CASE WHEN regexp_matches(value, '[I|ED]') THEN
            regexp_replace(regexp_extract(value, '[I|D|E](.*)', 1), '\d', '', 'g') END AS letter_form,
          CASE WHEN regexp_matches(value, '[IDEW]\s\w{{0,100}}:') THEN
            trim(regexp_replace(regexp_extract(value, '[IDEW]\s\w{{0,100}}:(.*)', 1), '\d', '', 'g')) END AS word_form,
          CASE WHEN milli <> '' THEN strptime('2024-' || milli, '%Y-%m-%d %H:%M:%S.%g') END AS milli_time
        FROM t""",
    "message_normalize": rf"""WITH {q.DEVICE_PARSED}, n AS (
        SELECT "key", regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '\d', '', 'g'),
            '(\s):{{0,2}}', '\1 ', 'g'), '(\W):+', '\1', 'g'), '\s{{2,}}', ' ', 'g') AS m
        FROM parsed WHERE raw IS NOT NULL)
        SELECT "key", trim(m) AS with_ids, trim(regexp_replace(m,
          'session_id:\s\S*| pair\sid:\s\S*| notification_id:\s\S*| event_id:\s\S*| action_queue:\s\S', '', 'g'))
          AS without_ids FROM n""",
    "error_code_lookup": f"""WITH {q.DEVICE_PARSED}, {q.CODES}
        SELECT g.message, c.code, count(*) AS occurrences FROM good g JOIN codes c ON g.message = c.message
        GROUP BY g.message, c.code""",
    "device_line_rejects": """SELECT 'device_' || n_nationkey || ', 10.0.' || n_nationkey || '.1, ' || r_name AS value,
        'missing fields' AS parse_error FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 = 0""",
    "alert_rejects": """SELECT event_id AS "key", CASE WHEN event_id % 7 = 0 THEN 'no code' ELSE 'no count' END AS parse_error
        FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0""",
    "device_lookup_files": """SELECT 'device_' || n_nationkey AS topic, '10.0.' || n_nationkey || '.1' AS ip, r_name AS realm,
        n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' new' ELSE '' END AS model
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "device_enrich": f"""WITH {q.DEVICE_PARSED}, {q.DEVICES}
        SELECT g."key", g.topic, v.ip, v.realm, v.model FROM good g LEFT JOIN devices v ON g.topic = v.topic""",
    "severity_range_counts": f"""WITH {q.DEVICE_PARSED}
        SELECT message, count(*) AS occurrences FROM good
        WHERE ts > TIMESTAMP '2024-01-05 06:00:00' AND ts <= TIMESTAMP '2024-01-25 18:00:00'
        GROUP BY message HAVING count(*) > 1 AND count(*) < 10 ORDER BY occurrences, message""",
    "failing_not_in_passing": f"""WITH {_RUNS} {q.CODES}
        SELECT m.message, m.occurrences, coalesce(c.code, 0) AS code
        FROM missing m LEFT JOIN codes c ON m.message = c.message ORDER BY occurrences, m.message""",
    "log_line_counts": f"""WITH {_RUNS} one AS (SELECT 1)
        SELECT 'passing' AS side, count(*) AS lines FROM runs WHERE early
        UNION ALL SELECT 'failing', count(*) FROM runs WHERE NOT early
        UNION ALL SELECT 'difference', count(*) FROM missing""",
    "log_search_fragments": f"""WITH {q.DEVICE_LINES}
        SELECT "key", value FROM device_lines WHERE value LIKE '%E svc\\_error%error code%stage b%' ESCAPE '\\'""",
    "log_word_filter": rf"""WITH {q.DEVICE_LINES}, tok AS (
        SELECT "key", {_TOKENS} AS w FROM device_lines),
        cut AS (SELECT "key", (CASE WHEN len(w) > 3 THEN w[2] ELSE '' END) || '> ' || array_to_string(w[6:], ' ') AS text FROM tok),
        words AS (SELECT *, regexp_split_to_array(lower(text), '\W') AS ws FROM cut)
        SELECT "key", text FROM words
        WHERE length(text) < 210 AND list_has_any(ws, ['error', 'warning']) AND NOT list_contains(ws, 'info')""",
    "thin_one_per_second": rf"""WITH {q.DEVICE_LINES}, tok AS (
        SELECT "key", event_ts, {_TOKENS} AS w FROM device_lines WHERE contains(value, 'svc_purchase')),
        cut AS (SELECT "key", event_ts,
            (CASE WHEN len(w) > 3 THEN w[2] ELSE '' END) || ' ' || array_to_string(w[6:], ' ') AS text FROM tok),
        timed AS (SELECT *, CASE WHEN regexp_matches(text, '\d\d:\d\d') THEN
            regexp_extract(text, '\d\d:\d\d(:\d\d)?') ELSE '0' END AS clock FROM cut),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY clock ORDER BY event_ts, "key") AS rn FROM timed)
        SELECT clock, text FROM ranked WHERE rn = 1""",
    "pattern_table_counts": f"""WITH {q.DEVICE_LINES},
        patterns(pattern, p) AS (VALUES ('bound error', '%E svc\\_error%error code%stage b%'),
          ('crash dump', '%[%crash dump%info%'), ('retry', '%warning: retry%'), ('percent', '%100\\%%'))
        SELECT pattern, count(value) AS occurrences
        FROM patterns LEFT JOIN device_lines ON value LIKE p ESCAPE '\\' GROUP BY pattern""",
    "errors_sliding": rf"""WITH {q.DEVICE_LINES}, hits AS (
        SELECT value, event_ts, regexp_split_to_array(lower(value), '\W') AS ws FROM device_lines WHERE length(value) < 210),
        kept AS (SELECT * FROM hits WHERE list_has_any(ws, ['error', 'restarting', 'warning']) AND NOT list_contains(ws, 'info')),
        labelled AS (SELECT event_ts, trim(regexp_replace(
            (CASE WHEN contains(lower(value), 'error') THEN 'ERROR ' WHEN contains(lower(value), 'warning') THEN 'WARNING ' ELSE '' END)
            || array_to_string(({_TOKENS})[5:], ' '), '\d', '', 'g')) AS text FROM kept),
        spread AS (SELECT text, {q.window_starts('event_ts', 86400, 21600)} AS w FROM labelled)
        SELECT {q.instant('w')} AS window_start, text, count(*) AS occurrences FROM spread GROUP BY w, text""",
    "avg_error_length_by_topic": f"""WITH {q.DEVICE_PARSED}
        SELECT CAST(ts AS DATE) AS day, topic, avg(char_count) AS average_chars FROM good
        WHERE lower(message) LIKE '%error%' GROUP BY 1, 2 ORDER BY day, average_chars, topic""",
    "avg_by_topic_sliding": f"""WITH {q.DEVICE_PARSED},
        spread AS (SELECT topic, char_count, {q.window_starts('ts', 21600, 10800)} AS w FROM good)
        SELECT {q.instant('w')} AS window_start, topic, sum(char_count)::DOUBLE / count(*) AS average_chars
        FROM spread GROUP BY w, topic""",
    "message_counts_tumbling": f"""WITH {q.DEVICE_PARSED},
        spread AS (SELECT message, {q.window_starts('ts', 21600, 21600)} AS w FROM good)
        SELECT {q.instant('w')} AS window_start, message, count(*) AS occurrences
        FROM spread GROUP BY w, message HAVING count(*) > 1 ORDER BY 1 DESC, 3 DESC, 2""",
    "device_windows_enriched": f"""WITH {q.DEVICE_PARSED}, {q.CODES}, {q.DEVICES},
        coded AS (SELECT g.*, coalesce(c.code, 0) AS code, v.ip, v.realm, v.model FROM good g
          LEFT JOIN codes c ON g.message = c.message LEFT JOIN devices v ON g.topic = v.topic
          WHERE length(g.message) < 60 AND (lower(g.message) LIKE '%error%' OR lower(g.message) LIKE '%warning%')),
        spread AS (SELECT *, {q.window_starts('ts', 21600, 21600)} AS w FROM coded)
        SELECT {q.instant('w')} AS window_start, topic, message, count(*) AS occurrences,
          CAST(sum(code) AS BIGINT) AS code, ip, realm, model
        FROM spread GROUP BY w, topic, message, ip, realm, model ORDER BY 1 DESC, 4 DESC, 2, 3""",
    "sentence_windows": f"""WITH ev AS (SELECT ts, event_type, CAST(floor(value) AS BIGINT) AS v FROM events),
        spread AS (SELECT 'The ' || event_type || ' took ' || chr(CAST(97 + v % 26 AS INTEGER)) || '.' AS text, v,
          {q.window_starts('ts', 21600, 21600)} AS w FROM ev WHERE v % 11 <> 3)
        SELECT {q.instant('w')} AS window_start, text, count(*) AS occurrences, CAST(sum(v) AS BIGINT) AS code
        FROM spread GROUP BY w, text""",
    "alert_totals": f"""WITH {ALERT_SQL}
        SELECT error, message, occurrences FROM alert_rows ORDER BY occurrences DESC, error""",
}
