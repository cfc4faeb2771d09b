"""Documents through quality, near-duplicate and passage filters into packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import near, packing, quality, repeats
from floodmark.llm.base import keep, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.classify(docs, table(spark, sf_dir, "labels")).where("not rejected").select("row.*")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id (a null id last).

    Rows are judged, not ids: repeated ids and null ids are rows like others. Their keys are a
    table, so all steps see the same ones.
    """
    rows = keep(docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "rows")
    found = near.near_duplicates(rows.select("key", "row.text"), id_col="key", width=5, percent=80)
    grouped = keep(found.select("key", "component_id"), "near-rows")
    groups = grouped.where("key != component_id").select("component_id").distinct()
    members = grouped.join(groups, "component_id").join(rows.select("key", F.col("row.doc_id").alias("doc_id")), "key")
    stays = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("least"))
    gone = members.select("key").join(stays.select(F.col("least.key").alias("key")), "key", "left_anti")
    return rows.join(gone, "key", "left_anti").select("row.*")


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat; n_chars follows the text, emptied texts go."""
    out = repeats.remove_repeats(docs, window=35, carry=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.where("trim(text) != ''").select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens; special tokens in texts are plain text."""
    return packing.pack(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"), length=2048, end_id=0, plain=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_stage),
    ("passages", passage_stage),
    ("packing", packing_stage),
]

# Neither the trained classifier nor the tokenizer can be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are a table before the next one starts."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = keep(docs, name)
    return docs
