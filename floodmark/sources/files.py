"""Inventories and checksums of data files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARQUET = "*.parquet"


def relative_path(path: Column, root: str) -> Column:
    """The part of a file path below ``root``, which it begins with.

    ``file:///a`` and ``file:/a`` name one folder, and a root without a scheme may be in
    any store. A path that does not begin with the root stays as it is.
    """
    scheme, _, rest = root.partition(":/") if re.match(r"[a-zA-Z][a-zA-Z0-9+.\-]*:/", root) else ("", "", root)
    store = f"{re.escape(scheme)}:/+" if scheme else r"(?:[a-zA-Z][a-zA-Z0-9+.\-]*:(?://[^/]*)?)?/*"
    return F.regexp_replace(path, f"^{store}{re.escape(rest.strip('/'))}/+", "")


def plain_text(path: Column) -> Column:
    """A path as stores know it: ``_metadata.file_path`` has blanks and others as %20."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _files(spark: SparkSession, root: str | list[str], pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )


def inventory(spark: SparkSession, root: str, pattern: str = PARQUET) -> DataFrame:
    """One row per file: path below ``root``, size and time. File contents are not read."""
    return _files(spark, root, pattern).select(
        relative_path(F.col("path"), root).alias("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def checksums(
    spark: SparkSession, root: str, below: Sequence[str] = (), pattern: str = PARQUET
) -> DataFrame:
    """Inventory with the SHA-256 of each file, of all of ``root`` or of some folders in it.

    Each file is one binary value in its task, so exports keep files well below 2 GiB;
    Spark refuses longer ones instead of skipping them.
    """
    return _files(spark, list(below) or root, pattern).select(
        relative_path(F.col("path"), root).alias("path"),
        F.col("length").alias("size"),
        F.sha2(F.col("content"), 256).alias("sha256"),
    )


def rows_per_file(df: DataFrame, root: str, *by: str) -> DataFrame:
    """Row counts by file of a frame that reads files, and by further columns if named.

    Only the named columns are read; without any, none is.
    """
    return (
        df.groupBy(F.col("_metadata.file_path").alias("_path"), *by)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("path", relative_path(plain_text(F.col("_path")), root))
        .drop("_path")
    )
