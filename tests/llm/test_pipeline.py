"""Registered queries and the pipeline on the driver's smallest tables."""

import os

import pytest

import __spark_entry__ as driver
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
NUMBERED = sorted(n for n in driver.queries() if n.startswith("op"))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NUMBERED) == list(range(1, 14))
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("name", [n for n in NUMBERED if not n.startswith(("op5_", "op10_", "op11_"))])
def test_every_document_has_a_row(spark, name):
    ids = sorted(r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in driver.queries()[name](spark, FOLDER).collect()) == ids


def test_stages_act_and_keep_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for place, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, FOLDER).cache()
        if place < 4:
            assert out.columns == columns and out.count() <= n
            n = out.count()
            docs = out
        else:
            assert out.count() == n and "ids_sha256" in out.columns
    whole = corpus_pipeline.run(spark, FOLDER)
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in out.collect()}


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, FOLDER).count() == 0
