from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsledger.plans import returns as r
from opsledger.session import new_run_dir
from opsledger.sources import files, sinks
from opsledger.testbed import tables as t

SCHEMA = ("document_number string, line_no int, category string, status string, display_name string, description string, "
          "quantity double, created_at timestamp_ntz, customer string, case_text string, internal_id string")
OLD, NEW, NEWER = datetime(2019, 1, 1), datetime(2019, 9, 4), datetime(2019, 9, 26)


def row(doc, line, cat, disp="X", desc="plain", qty=-1.0, created=NEW, status="Closed", customer="c1", case="CASE000001 - broken"):
    return (doc, line, cat, status, disp, desc, qty, created, customer, case, f"{doc}-{line}")


ROWS = [
    # two lines with different categories: the first one counts, whatever the filters say
    row("d1", 1, "Loaner Return", "ODU one"),
    row("d1", 2, "Failed Unit", "ODU one", qty=-50.0),
    row("d2", 1, "Failed Unit", "big ODU", qty=-2.0, status="Pending Receipt"),
    row("d3", 1, "Loaner / Failed Unit", "OS-1 Sensor", "GEN2 lens", qty=-4.0),
    row("d4", 1, "Failed Unit", "OS-1 Sensor", qty=-8.0, created=NEWER, status="Pending Receive"),
    row("d5", 1, "Failed Unit", "OS-1 Sensor B", qty=-16.0, created=OLD),
    row("d6", 1, "Failed Unit", "Sinbon cable", "GEN2", qty=-32.0, customer="c2", status="Pending Approval"),
    row("d7", 1, "Eval", "SINBON", "GEN2", qty=-64.0),
    row("d8", 1, "Unopened box", "SINBON OS-1 Sensor", "GEN2", qty=-128.0, customer="c2"),
    row("d9", 1, "Preemptive", "OS-1 Sensor", "GEN2 SINBON", qty=-256.0),
    row("d10", 1, "Retrofit", "OS-1 Sensor SINBON", qty=-512.0),
    row("d11", 1, "Below Spec", "GEN2 ODU", "GEN2", qty=-1024.0, created=NEWER),
    row("d12", 1, "Recalibration", qty=-2048.0, status="RMA Cancelled"),
    row("d13", 1, "wrong sensor sent", qty=-4096.0),
    row("d14", 1, "Wrong Sensor sent", qty=-8192.0),
    row("d15", 1, "None", qty=-16384.0),
    row("d16", 1, "Swap Program", qty=-32768.0),
    row("d17", 1, "Did not meet customer req", qty=-65536.0),
    row("d18", 1, "Cancelled", qty=-131072.0),
]


@pytest.fixture(scope="module")
def export(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def documents(export):
    return r.one_per_document(export, ["line_no"])


def test_every_kpi(documents):
    got = r.kpis(documents).first().asDict()
    total = sum(x[6] for x in ROWS) + 50
    assert got == {
        "total_returns": total, "total_failed": -62.0, "failed_odu": -10.0, "failed_sinbon": -32.0,
        "failed_gen2": -36.0, "loaner_odu": -5.0, "loaner_sinbon": -64.0, "loaner_gen2": -68.0,
        "unused_odu": -128.0, "unused_sinbon": -128.0, "unused_gen2": -128.0,
        "spec_odu": -1280.0, "spec_sinbon": -512.0, "spec_gen2": -1280.0,
        "recalibration": -2048.0, "wrong_sent": -4096.0, "unlabelled": -16384.0, "swap_program": -32768.0,
        "expectation_not_met": -65536.0, "cancelled": -133120.0,
    }


def test_start_is_exclusive_and_empty_totals_are_null(documents):
    got = r.kpis(documents, start=NEW).first()
    assert got.failed_odu == -8.0 and got.total_returns == -1032.0 and got.swap_program is None


def test_reports(export, documents):
    reasons = r.failed_reasons(export).collect()
    assert [(x.reason, x.quantity) for x in reasons] == [("broken", 112)]
    assert [x.quantity for x in r.pending_reasons(export).collect()] == [34]
    customers = [(x.customer, x.quantity) for x in r.customer_totals(documents).collect()]
    assert customers[0][0] == "c1" and customers[1] == ("c2", 160.0)
    assert [x.document_number for x in r.pending_before(documents, NEWER).collect()] == ["d2", "d6"]
    assert r.pending_before(documents).count() == 2
    assert [x.document_number for x in r.generation(documents, second=True).collect()] == ["d11"]
    first = [x.created_at for x in r.generation(documents, second=False).collect()]
    assert first == sorted(first, reverse=True) and len(first) == 17
    assert {(x.display_name, x.documents) for x in r.pending_by_type(documents).collect()} == {("big ODU", 1), ("OS-1 Sensor", 1)}
    assert [(x.display_name, x.category, x.quantity) for x in r.spec_breakdown(documents).collect()] == [("GEN2 ODU", "Below Spec", 1024.0)]
    detail = {x.document_number: x.reason for x in r.reason_customer(documents, NEW).collect()}
    assert detail == {"d4": "broken", "d11": "broken"}


def test_text_report_strips_marks_and_keeps_every_row(spark, documents, monkeypatch):
    path = new_run_dir(spark, "t")
    sinks.write_single_text(r.customer_totals(documents), path)
    files_written = spark.read.text(path).inputFiles()
    assert len(files_written) == 1
    text = [x.value for x in spark.read.text(path).collect()]
    assert text[1] == "c2,160.0" and len(text) == 2
    # replaced, several parts, compressed: always one file, in order
    ranged = spark.range(5000).repartitionByRange(5, "id").sortWithinPartitions("id")
    for codec, ending in (("gzip", ".gz"), ("bzip2", ".bz2"), ("none", ".txt")):
        sinks.write_single_text(ranged, path, codec)
        written = spark.read.text(path)
        assert [x.value for x in written.collect()] == [str(i) for i in range(5000)]
        assert len(written.inputFiles()) == 1 and written.inputFiles()[0].endswith(ending)
    with pytest.raises(ValueError):
        sinks.write_single_text(ranged, path, "snappy")
    monkeypatch.setattr(sinks, "SINGLE_BYTES", 1000)
    with pytest.raises(ValueError, match="stays in parts"):
        sinks.write_single_text(ranged, path)
    assert spark.read.text(path).count() == 5000     # the report of before


def test_total_counts_rows_without_category(spark, documents):
    more = documents.withColumn("category", F.lit(None).cast("string"))
    assert r.kpis(more).first()["total_returns"] == documents.agg(F.sum("quantity")).first()[0]


def test_csv_header_and_bad_values(spark, tmp_path):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    source = tmp_path / "x.csv"
    source.write_text("Internal ID,Sum Of Quantity\n7,-2.0\n8,oops\n")
    raw = files.clean_header(files.read_header_csv(spark, str(source)))
    assert raw.columns == ["Internal_ID", "Sum_Of_Quantity"]
    typed = files.bind(raw, StructType([StructField("Internal_ID", StringType()), StructField("Sum_Of_Quantity", DoubleType())]))
    assert [tuple(x) for x in typed.collect()] == [("7", -2.0), ("8", None)]


def test_survivors_chosen_before_and_after_the_joins_agree(spark):
    folder = "/root/testdata/sf0.001"
    early = t.return_documents(spark, folder)
    late = r.one_per_document(t.return_lines(spark, folder), t.SURVIVOR_ORDER, early.columns).select(*early.columns)
    assert early.exceptAll(late).count() == 0 and late.exceptAll(early).count() == 0
