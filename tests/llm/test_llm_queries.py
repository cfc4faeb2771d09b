"""The registered queries on the smallest tables."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_ten_and_the_pipeline_are_registered():
    names = oracle.contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_top_k_against_sql(spark):
    assert oracle.compare(spark, oracle.connect(SF), "op3_exact_top_k", SF) is None


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = labels.where("quality = 1 and toxic = 0").count()
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
        kept = corpus_pipeline.keep(kept, name)
        if name == "quality":
            assert kept.join(labels.where("quality = 1 and toxic = 0"), "doc_id", "left_semi").count() >= 0.95 * clean
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert fill.agg(F.max("n")).first()[0] <= 2048
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}


@pytest.mark.parametrize("name", ["op5_license_scan", "op9_substring_dedup"])
def test_one_row_per_document(spark, name):
    got = oracle.contract.queries()[name](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_repeated_rows_stay_once_in_the_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    plain = corpus_pipeline.run(spark, SF).select("doc_id").distinct()
    clean = labels.where("quality = 1 and toxic = 0").join(plain, "doc_id").join(docs, "doc_id").where("size(split(text, ' ')) >= 40")
    a, b, c, d = [r.doc_id for r in clean.orderBy("doc_id").limit(4).collect()]
    again = docs.where(f"doc_id = {a}")  # the same row twice under one id
    nulls = docs.where(f"doc_id = {b}").withColumn("doc_id", F.lit(None).cast("long"))  # copies under null ids only
    copy = docs.where(f"doc_id = {c}").withColumn("doc_id", F.lit(-1).cast("long"))  # c's text under a smaller id, ...
    other = docs.where(f"doc_id = {d}").withColumn("doc_id", F.lit(c).cast("long"))  # ... and d's text under c's id
    rows = docs.where(f"doc_id not in ({b}, {d})").unionByName(again).unionByName(nulls).unionByName(nulls).unionByName(copy).unionByName(other)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    stage = corpus_pipeline.near_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    texts = {i: docs.where(f"doc_id = {i}").first().text for i in (a, b, c, d)}
    kept = [(r.doc_id, r.text) for r in stage.collect()]
    assert [sum(t == texts[i] for _, t in kept) for i in (a, b, c, d)] == [1, 1, 1, 1]
    assert (-1, texts[c]) in kept and (c, texts[d]) in kept and (None, texts[b]) in kept

    out = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert {a, None, -1, c} <= out
