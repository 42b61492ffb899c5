"""The registered queries on the given tables: SQL, round trips and held-out accuracy."""

import os

import pytest
from compare import connect, duckdb_result, spark_result

from tallyframe.llm import ORACLES, QUERIES

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(LARGER), reason="test tables are missing")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert spark_result(QUERIES[name](spark, FOLDER)) == duckdb_result(connect(FOLDER), ORACLES[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op5_language_id"](spark, LARGER).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) > 0.97 * len(rows) > 0


def test_quality_of_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op7_quality_votes"](spark, LARGER).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in rows) > 0.95 * len(rows) > 0


def test_whole_benchmark_items_are_found(spark):
    items = spark.read.parquet(f"{LARGER}/benchmark.parquet").collect()
    documents = spark.read.parquet(f"{LARGER}/documents.parquet").collect()
    whole = {(d.doc_id, i.item_id) for d in documents for i in items if i.text in d.text}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op2_benchmark_passages"](spark, LARGER).collect()}
    assert whole and whole <= found
