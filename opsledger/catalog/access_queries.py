"""Registered access-log queries with their oracle SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsledger.catalog import sql as q
from opsledger.functions import access_log as al
from opsledger.plans import access_logs as access
from opsledger.sources.files import read_table
from opsledger.sources.views import views
from opsledger.testbed import tables as t


def lines(spark: SparkSession, d: str) -> DataFrame:
    return t.access_lines(read_table(spark, d, "events"), read_table(spark, d, "pages"))


def entries(spark: SparkSession, d: str) -> DataFrame:
    return access.accepted(access.parse(lines(spark, d)))


def access_log_parse(spark, d):
    return entries(spark, d).select("key", "ip", "ts", "url", "status", "bytes", "agent")


def access_log_rejects(spark, d):
    return access.rejected(access.parse(lines(spark, d)), "key")


def access_quick_fields(spark, d):
    value = F.col("value")
    return lines(spark, d).select(
        "key", al.token(value, 5).alias("method"), al.token(value, 6).alias("target"),
        al.last_quoted(value).alias("agent"),
    )


def top_urls_sliding(spark, d):
    counts = access.url_counts(entries(spark, d), timedelta(hours=6), timedelta(hours=3))
    return counts.select("window_start", "url", "requests").orderBy(
        "window_start", F.col("requests").desc(), "url"
    )


def status_hourly(spark, d):
    return access.status_hourly(entries(spark, d)).select("window_start", "status", "requests").orderBy(
        "window_start", "status"
    )


def agent_counts_per_batch(spark, d):
    daily = entries(spark, d).withColumn("day", F.to_date("ts"))
    return access.agent_counts(daily, ["day"])


def agent_counts_sql(spark, d):
    """The same entries as a temporary view under plain SQL."""
    with views(requests=entries(spark, d)) as run:
        return run("SELECT agent, count(*) AS total FROM requests GROUP BY agent")


def error_ratio_alarm(spark, d):
    out = access.error_alarm(entries(spark, d), timedelta(days=1), timedelta(hours=1))
    return out.select("window_start", "success", "failure", "other", "ratio", "state")


def error_alarm_seconds(spark, d):
    """The alarm over five minutes, every second: windows and largest failure count per day and state."""
    out = access.error_alarm(entries(spark, d), timedelta(seconds=300), timedelta(seconds=1), minimum=1)
    return out.groupBy(F.to_date("window_start").alias("day"), "state").agg(
        F.count("*").alias("windows"), F.max("failure").alias("most_failures"), F.sum("success").alias("successes"))


QUERIES = {
    f.__name__: f for f in (
        access_log_parse, access_log_rejects, access_quick_fields, top_urls_sliding, status_hourly,
        agent_counts_per_batch, agent_counts_sql, error_ratio_alarm, error_alarm_seconds,
    )
}

def alarm_sql(size: int, slide: int, minimum: int = 100) -> str:
    return f"""WITH {q.ACCESS_LINES},
        spread AS (SELECT status, {q.window_starts('ts', size, slide)} AS w FROM entries),
        tallied AS (SELECT w, count(*) FILTER (WHERE status >= 200 AND status < 300) AS success,
          count(*) FILTER (WHERE status >= 500 AND status < 600) AS failure,
          count(*) FILTER (WHERE status < 200 OR (status >= 300 AND status < 500) OR status >= 600) AS other
          FROM spread GROUP BY w)
        SELECT {q.instant('w')} AS window_start, success, failure, other,
          CASE WHEN success > 0 THEN CAST(failure AS DOUBLE) / success END AS ratio,
          CASE WHEN success + failure <= {minimum} THEN 'too few' WHEN success = 0 THEN 'alarm'
               WHEN CAST(failure AS DOUBLE) / success > 0.5 THEN 'alarm' ELSE 'ok' END AS state
        FROM tallied"""


SQL = {
    "access_log_parse": f"""WITH {q.ACCESS_LINES}
        SELECT "key", ip, ts, url, status, bytes, agent FROM entries""",
    "access_log_rejects": f"""WITH {q.ACCESS_LINES}
        SELECT "key", value, CASE WHEN ok THEN 'bad date' ELSE 'bad line' END AS parse_error
        FROM access_parsed WHERE NOT ok OR ts IS NULL""",
    "access_quick_fields": f"""WITH {q.ACCESS_LINES}, tok AS (
        SELECT "key", string_split(value, ' ') AS w, string_split(value, '"') AS quoted FROM access_lines)
        SELECT "key", replace(w[6], '"', '') AS method, replace(w[7], '"', '') AS target, quoted[-2] AS agent FROM tok""",
    "top_urls_sliding": f"""WITH {q.ACCESS_LINES},
        spread AS (SELECT url, {q.window_starts('ts', 21600, 10800)} AS w FROM entries WHERE url IS NOT NULL)
        SELECT {q.instant('w')} AS window_start, url, count(*) AS requests FROM spread GROUP BY w, url
        ORDER BY 1, 3 DESC, 2""",
    "status_hourly": f"""WITH {q.ACCESS_LINES}
        SELECT date_trunc('hour', ts) AS window_start, status, count(*) AS requests FROM entries
        GROUP BY 1, 2 ORDER BY 1, 2""",
    "agent_counts_per_batch": f"""WITH {q.ACCESS_LINES}
        SELECT CAST(ts AS DATE) AS day, agent, count(*) AS total FROM entries GROUP BY 1, 2""",
    "error_ratio_alarm": alarm_sql(86400, 3600),
    "error_alarm_seconds": f"""SELECT CAST(window_start AS DATE) AS day, state, count(*) AS windows, max(failure) AS most_failures,
        CAST(sum(success) AS BIGINT) AS successes FROM ({alarm_sql(300, 1, 1)}) GROUP BY 1, 2""",
    "agent_counts_sql": f"""WITH {q.ACCESS_LINES}
        SELECT agent, count(*) AS total FROM entries GROUP BY agent""",
}
