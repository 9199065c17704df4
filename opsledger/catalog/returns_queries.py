"""Registered returns-report queries with their oracle SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from opsledger.catalog import sql as q
from opsledger.plans import patterns, returns as r
from opsledger.session import new_run_dir, stored
from opsledger.sources import files, sinks
from opsledger.testbed import tables as t

START = datetime(1996, 6, 1)
BEFORE = datetime(2000, 1, 1)


def returns_kpis(spark, d):
    """The library's own path: survivors are picked on the finished export."""
    return r.kpis(r.one_per_document(t.return_lines(spark, d), t.SURVIVOR_ORDER, r.REPORT_COLUMNS), start=START)


def returns_kpis_unbounded(spark, d):
    return r.kpis(t.return_documents(spark, d))


def returns_documents(spark, d):
    """The de-duplication itself, taken on the finished export lines."""
    kept = r.one_per_document(t.return_lines(spark, d), t.SURVIVOR_ORDER, ["internal_id", "category", "quantity"])
    return kept.select("document_number", "internal_id", "category", "quantity")


def returns_reason_totals(spark, d):
    return r.failed_reasons(t.return_lines(spark, d), START)


def returns_pending_reasons(spark, d):
    return r.pending_reasons(t.return_lines(spark, d))


def returns_reason_customer(spark, d):
    return r.reason_customer(t.return_documents(spark, d, customers=True), START)


def returns_customer_totals(spark, d):
    return r.customer_totals(t.return_documents(spark, d, customers=True), START)


def returns_pending_before(spark, d):
    return r.pending_before(t.return_documents(spark, d, customers=True), BEFORE)


def returns_gen1(spark, d):
    return r.generation(t.return_documents(spark, d, customers=True), second=False, start=START)


def returns_gen2(spark, d):
    return r.generation(t.return_documents(spark, d, customers=True), second=True, start=START)


def returns_pending_by_type(spark, d):
    return r.pending_by_type(t.return_documents(spark, d))


def returns_spec_breakdown(spark, d):
    return r.spec_breakdown(t.return_documents(spark, d), START)


EXPORT = StructType([
    StructField("Internal_ID", StringType()),
    StructField("Document_Number", StringType()),
    StructField("Return_Category", StringType()),
    StructField("Sum_Of_Quantity", DoubleType()),
    StructField("RMA_Record_Created_Date", StringType()),
])


def csv_header_clean(spark, d):
    """Write the export with blanks in its header and dates as text, then load it back typed."""
    path = new_run_dir(spark, "returns-csv")
    created = F.lower(F.date_format("created_at", "M/d/yyyy h:mm a"))
    t.return_lines(spark, d).select(
        F.col("internal_id").alias("Internal ID"),
        F.col("document_number").alias("Document Number"),
        F.col("category").alias("Return Category"),
        F.col("quantity").alias("Sum Of Quantity"),
        created.alias("RMA Record Created Date"),
    ).write.option("header", True).csv(path)
    typed = files.bind(files.clean_header(files.read_header_csv(spark, path)), EXPORT)
    created_at = F.try_to_timestamp("RMA_Record_Created_Date", F.lit("M/d/yyyy h:mm a")).cast("timestamp_ntz")
    return typed.select(
        F.col("Document_Number").alias("document_number"),
        F.col("Internal_ID").alias("internal_id"),
        F.col("Return_Category").alias("category"),
        F.col("Sum_Of_Quantity").alias("quantity"),
        created_at.alias("created_at"),
    )


def report_text_single_file(spark, d):
    """A finished report as one text file, read back line by line."""
    path = new_run_dir(spark, "customer-totals")
    sinks.write_single_text(r.customer_totals(t.return_documents(spark, d, customers=True), START), path)
    return files.read_lines(spark, path).withColumnRenamed("value", "line")


def report_text_parts(spark, d):
    """A detail report as ordered, compressed text parts, read back line by line."""
    path = new_run_dir(spark, "gen2")
    sinks.write_text_report(r.generation(t.return_documents(spark, d, customers=True), second=True, start=START), path, "gzip")
    return files.read_lines(spark, path).withColumnRenamed("value", "line")


def pattern_counts_by_part(spark, d):
    """Lines per pattern of a table of patterns: one per part, found in the case lines through their rarest words."""
    exported = t.return_lines(spark, d)
    # the words are counted, then looked up: the joins that make the lines run once
    lines = stored(exported.select(F.concat("case_text", F.lit(" ref "), "internal_id").alias("value")), "case-lines")
    part = files.read_table(spark, d, "part")
    wanted = F.array(F.concat(F.lit(" - "), "p_name", F.lit(",")), F.lit("ref "), F.concat(F.lit("-"), "p_partkey", F.lit("-")))
    table = patterns.PatternTable(part.select(F.col("p_partkey").alias("pattern_id"), wanted.alias("fragments")), lines)
    return table.counts(lines)


QUERIES = {
    f.__name__: f for f in (
        returns_kpis, returns_kpis_unbounded, returns_documents, returns_reason_totals, returns_pending_reasons,
        returns_reason_customer, returns_customer_totals, returns_pending_before, returns_gen1, returns_gen2,
        returns_pending_by_type, returns_spec_breakdown, csv_header_clean, report_text_single_file,
        report_text_parts, pattern_counts_by_part,
    )
}

_LATE = "created_at > TIMESTAMP '1996-06-01'"


def _kpi_sql(bound: str) -> str:
    spec = "regexp_matches(category, 'Preemptive|Return for Upgrade|Below Spec|Retrofit')"
    loan = "regexp_matches(category, 'Loaner|Eval')"
    tests = {
        "total_returns": "true",
        "total_failed": "category LIKE '%Failed Unit%'",
        "failed_odu": "category = 'Failed Unit' AND (display_name LIKE '%ODU%' OR display_name = 'OS-1 Sensor')",
        "failed_sinbon": "category = 'Failed Unit' AND (display_name LIKE '%SINBON%' OR display_name LIKE '%Sinbon%' "
                         "OR display_name LIKE '%OS1-64 No iBox%')",
        "failed_gen2": "category LIKE '%Failed Unit%' AND description LIKE '%GEN2%'",
        "loaner_odu": f"{loan} AND (display_name LIKE '%ODU%' OR display_name LIKE '%OS-1 Sensor%')",
        "loaner_sinbon": f"{loan} AND display_name LIKE '%SINBON%'",
        "loaner_gen2": f"{loan} AND description LIKE '%GEN2%'",
        "unused_odu": "category LIKE '%Unopened%' AND (display_name LIKE '%ODU%' OR display_name LIKE '%OS-1 Sensor%')",
        "unused_sinbon": "category LIKE '%Unopened%' AND display_name LIKE '%SINBON%'",
        "unused_gen2": "category LIKE '%Unopened%' AND description LIKE '%GEN2%'",
        "spec_odu": f"({spec} AND display_name LIKE '%ODU%') OR "
                    "(category LIKE '%Preemptive%' AND display_name LIKE '%OS-1 Sensor%')",
        "spec_sinbon": f"{spec} AND display_name LIKE '%SINBON%'",
        "spec_gen2": f"{spec} AND description LIKE '%GEN2%'",
        "recalibration": "category LIKE '%Recalibration%'",
        "wrong_sent": "category LIKE '%wrong sensor%'",
        "unlabelled": "category LIKE '%None%'",
        "swap_program": "category LIKE '%Swap%'",
        "expectation_not_met": "category LIKE '%meet customer req%'",
        "cancelled": "status LIKE '%Cancelled%' OR category LIKE '%Cancelled%'",
    }
    sums = ", ".join(f"sum(CASE WHEN ({c}) AND {bound} THEN quantity END) AS {n}" for n, c in tests.items())
    return f"WITH {q.RETURNS} SELECT {sums} FROM documents_kept"


_PENDING = "(status LIKE '%Pending Receipt%' OR status LIKE '%Pending Approval%')"
_DETAIL = "row_reason AS reason, customer, abs(quantity) AS quantity, created_at, document_number"
_CUSTOMER_LINES = f"""WITH {q.RETURNS}
    SELECT customer, abs(sum(quantity)) AS quantity FROM documents_kept WHERE {_LATE} GROUP BY customer"""

SQL = {
    "pattern_counts_by_part": r"""WITH texts AS (SELECT p_name, 'CASE' || lpad(CAST(l_orderkey % 1000000 AS VARCHAR), 6, '0') || ' - ' || p_name || ', '
          || o_orderpriority || ' ref ' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
        SELECT p_partkey AS pattern_id, count(*) AS occurrences FROM texts JOIN part ON part.p_name = texts.p_name
          AND contains(value, '-' || p_partkey || '-') AND value LIKE '% - ' || part.p_name || ',%ref %-' || p_partkey || '-%'
        GROUP BY p_partkey""",
    "returns_kpis": _kpi_sql(_LATE),
    "returns_kpis_unbounded": _kpi_sql("true"),
    "returns_documents": f"WITH {q.RETURNS} SELECT document_number, internal_id, category, quantity FROM documents_kept",
    "returns_reason_totals": f"""WITH {q.RETURNS}
        SELECT clean_reason AS reason, CAST(sum(abs(quantity)) AS BIGINT) AS quantity FROM described
        WHERE {_LATE} AND category LIKE '%Failed Unit%' GROUP BY 1 ORDER BY 2 DESC, 1""",
    "returns_pending_reasons": f"""WITH {q.RETURNS}
        SELECT clean_reason AS reason, CAST(sum(abs(quantity)) AS BIGINT) AS quantity FROM described
        WHERE {_PENDING} GROUP BY 1 ORDER BY 2 DESC, 1""",
    "returns_reason_customer": f"""WITH {q.RETURNS}
        SELECT row_reason AS reason, customer, abs(quantity) AS quantity, internal_id, document_number
        FROM documents_kept WHERE {_LATE}""",
    "returns_customer_totals": f"{_CUSTOMER_LINES} ORDER BY quantity DESC, customer",
    "returns_pending_before": f"""WITH {q.RETURNS} SELECT {_DETAIL} FROM documents_kept
        WHERE created_at < TIMESTAMP '2000-01-01' AND {_PENDING} ORDER BY created_at DESC, document_number""",
    "returns_gen1": f"""WITH {q.RETURNS} SELECT {_DETAIL} FROM documents_kept
        WHERE {_LATE} AND display_name NOT LIKE '%GEN2%' ORDER BY created_at DESC, document_number""",
    "returns_gen2": f"""WITH {q.RETURNS} SELECT {_DETAIL} FROM documents_kept
        WHERE {_LATE} AND display_name LIKE '%GEN2%' ORDER BY created_at DESC, document_number""",
    "returns_pending_by_type": f"""WITH {q.RETURNS}
        SELECT display_name, count(*) AS documents FROM documents_kept
        WHERE (status LIKE '%Pending Receipt%' OR status LIKE '%Pending Receive%') AND category = 'Failed Unit'
        GROUP BY 1 ORDER BY 2 DESC, 1""",
    "returns_spec_breakdown": f"""WITH {q.RETURNS}
        SELECT display_name, category, abs(sum(quantity)) AS quantity FROM documents_kept
        WHERE {_LATE} AND display_name LIKE '%GEN2%' GROUP BY 1, 2 ORDER BY 3, 1, 2""",
    "csv_header_clean": f"""WITH {q.RETURNS}
        SELECT document_number, internal_id, category, quantity, created_at FROM described""",
    "report_text_single_file": f"""SELECT customer || ',' || CAST(quantity AS VARCHAR) AS line
        FROM ({_CUSTOMER_LINES})""",
    "report_text_parts": f"""WITH {q.RETURNS}
        SELECT row_reason || ',' || customer || ',' || CAST(abs(quantity) AS VARCHAR) || ','
          || strftime(created_at, '%Y-%m-%d %H:%M:%S') || ',' || document_number AS line
        FROM documents_kept WHERE {_LATE} AND display_name LIKE '%GEN2%'""",
}
