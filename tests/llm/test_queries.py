"""Registered queries against their SQL on the smallest tables, and the pipeline's stages."""

from __future__ import annotations

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from cliplake.llm.oracle import ORACLES
from cliplake.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op5_substring_dedup"}))
def test_one_row_per_document(spark, name):
    rows = QUERIES[name](spark, SF)
    assert rows.count() == rows.select("doc_id").distinct().count() == table(spark, SF, "documents").count()


def test_held_out_toxicity(spark):
    found = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").where("held_out")
    joined = found.join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
    right = joined.agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 0, F.col("predicted")))
    ).first()
    assert right[0] > 0.8 and right[1] < 0.01


def test_pipeline_stages_keep_columns(spark):
    docs = table(spark, SF, "documents")
    docs = docs.union(docs.limit(2)).union(docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(10_000).cast("long")))
    columns, count = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "mixing":
            assert docs.columns == columns
        left = docs.count()
        assert 0 < left <= count
        count = left
    assert docs.select("doc_id").distinct().count() == docs.count()
    assert docs.where("taken <> copies * size or copies < 1").count() == 0


def test_pipeline_loses_no_text_to_ids(spark):
    """Rows that share an id and rows without one are documents of their own in every stage."""
    texts = [" ".join(f"t{i}w{k}" for k in range(120)) for i in range(5)]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (3, texts[4]), (1, texts[0]), (None, texts[4])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string"
    docs = spark.createDataFrame([(i, t, "en", "a", len(t), "big") for i, t in rows], schema)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_dedup"](spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(
        [(1, texts[0]), (1, texts[1]), (0, texts[2]), (0, texts[3]), (3, texts[4])]
    )
    cut = {(r.doc_id, r.text) for r in stages["substring_dedup"](spark, docs, SF).collect()}
    assert {t for _, t in cut} == set(texts) and len(cut) == 5
    assert stages["decontamination"](spark, docs, SF).count() == 7
    mixed = stages["mixing"](spark, docs, SF)
    assert mixed.columns[:6] == docs.columns
    assert set(mixed.columns[6:]) == {"mix_size", "source_size", "target", "copies", "taken"}
    assert {r.text for r in mixed.collect()} == set(texts) and mixed.count() == 7
