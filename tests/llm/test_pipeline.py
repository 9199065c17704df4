import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from opsledger.llm import queries
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@there
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_oracle(spark, name):
    problem, rows, _ = compare(spark, connect(FOLDER), FOLDER, entry.queries()[name], queries.SQL[name])
    assert problem is None and rows > 0


@there
def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.store(stage(spark, docs, FOLDER), "stage-test")
        if name != "mixing":
            assert made.columns == docs.columns
            assert made.select("doc_id").subtract(docs.select("doc_id")).isEmpty()
        counts.append(made.count())
        docs = made
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] >= counts[4] > 0.5 * counts[0]
    assert docs.groupBy("doc_id", "copy_no").count().where("count > 1").isEmpty()


def test_stages_on_messy_and_empty_tables(spark, messy, nothing, tmp_path):
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this kind")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (messy, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.store(stage(spark, docs, str(tmp_path)), "stage-test")
            assert docs.columns == ([*start.columns, "copy_no"] if name == "mixing" else start.columns)
    assert docs.count() == 0


def test_every_query_is_registered():
    names = {n for n in entry.queries() if n.startswith("op") and n[2].isdigit()}
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14)) and "pipeline" in entry.queries()


def test_lines_are_taken_out_of_a_text_once(spark):
    own = [" ".join(f"{sign}{n * n}" for n in range(12)) for sign in "abcde"]
    docs = spark.createDataFrame([(i, f"{line}\na line that all of them have, word for word", 70) for i, line in enumerate(own)],
                                 "doc_id long, text string, n_chars int")
    found = corpus_pipeline.line_stage(spark, docs, None)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    rows = {r.doc_id: (r.text.count("\n"), r.n_chars == len(r.text) or r.doc_id == 0) for r in found.collect()}
    assert rows == {i: (int(i == 0), True) for i in range(5)}
