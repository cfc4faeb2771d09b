"""Manifests: which files make up a table, with sizes, rows and checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.functions import ids
from floodmark.operators.keyed import first_per_key

FILE_KEY = ["dataset", "table", "path"]
FILE_STRUCT = "struct<path:string,size:bigint,row_count:bigint,sha256:string>"
MANIFEST = """dataset string, table string, schema_version int, run_id string,
 exported_at timestamp_ntz, path string, size bigint, row_count bigint, sha256 string"""
# Fixed value: version of the manifest format itself.
FORMAT_VERSION = "v1"


def build(stored: DataFrame, counted: DataFrame) -> DataFrame:
    """Manifest rows from the files in storage and the row counts of those files.

    Sizes and checksums come from storage after the write and row counts from reading
    the files, so nothing depends on what the writer believed it wrote. A stored file
    without rows is empty; rows of a file that is not in storage are an error.
    """
    rows = counted.groupBy("path").agg(F.sum("row_count").alias("row_count"))
    lost = F.raise_error(F.concat(F.lit("counted rows of a file that is not in storage: "), "path"))
    return stored.join(rows, "path", "full").withColumns(
        {
            "path": F.when(F.col("size").isNull(), lost).otherwise(F.col("path")),
            "row_count": F.coalesce("row_count", F.lit(0)),
        }
    )


def merge(*manifests: DataFrame) -> DataFrame:
    """Union by path; the earlier manifest wins a path that several of them list."""
    ranked = [m.withColumn("_rank", F.lit(i)) for i, m in enumerate(manifests)]
    everything = ranked[0]
    for m in ranked[1:]:
        everything = everything.unionByName(m)
    tie = [c for c in ("size", "row_count", "sha256") if c in everything.columns]
    return first_per_key(everything, FILE_KEY, ["_rank", *tie]).drop("_rank")


def totals(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("dataset", "table").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("row_count").alias("row_count"),
        F.sum("size").alias("stored_bytes"),
    )


def encode(manifest: DataFrame, exported_at: Column) -> DataFrame:
    """One JSON document per file.

    A document per table would hold its whole file list in one row; one per file lets
    any number of files be written and read in parallel.
    """
    document = F.struct(
        F.lit(FORMAT_VERSION).alias("schema_version"),
        ids.rfc3339(exported_at).alias("exported_at"),
        "dataset",
        "table",
        F.struct("path", "size", "row_count", "sha256").alias("file"),
    )
    return manifest.select(F.to_json(document).alias("value"))


def decode(documents: DataFrame) -> DataFrame:
    """Manifest rows from JSON documents with one ``file`` or an array of ``files``."""
    schema = (
        "schema_version string, exported_at string, dataset string, table string, "
        f"file {FILE_STRUCT}, files array<{FILE_STRUCT}>"
    )
    doc = documents.select(F.from_json("value", schema).alias("d")).select("d.*")
    one = F.when(F.col("file").isNotNull(), F.array("file"))
    listed = F.explode(F.coalesce("files", one)).alias("f")
    return doc.select("schema_version", "exported_at", "dataset", "table", listed).select(
        "schema_version", "exported_at", "dataset", "table", "f.*"
    )


def orphans(inventory: DataFrame, manifest: DataFrame, now: Column) -> DataFrame:
    """Files no manifest lists that are over a day old; younger ones may still be in use."""
    unlisted = inventory.join(manifest.select("path"), "path", "left_anti")
    return unlisted.where(F.col("modified") < now - F.expr("INTERVAL 24 HOURS"))


def check_files(stored: DataFrame, manifest: DataFrame) -> DataFrame:
    """Status of each file: ``ok``, ``changed``, ``missing`` or ``untracked``."""
    here = stored.select("path", F.col("size").alias("size_now"), F.col("sha256").alias("sha_now"))
    listed = manifest.select("path", "size", "sha256").withColumn("_listed", F.lit(True))
    status = (
        F.when(F.col("_listed").isNull(), "untracked")
        .when(F.col("sha_now").isNull(), "missing")
        .when((F.col("sha_now") == F.col("sha256")) & (F.col("size_now") == F.col("size")), "ok")
        .otherwise("changed")
    )
    return here.join(listed, "path", "full").select("path", status.alias("status"))
