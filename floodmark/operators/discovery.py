"""Partitions of source tables with rows, bytes and last change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.functions import hashing, ids
from floodmark.sources.tables import TableSource, union_all

PARTITION_COLUMNS = [
    "project",
    "dataset",
    "table",
    "partition_id",
    "total_rows",
    "total_logical_bytes",
    "last_modified",
]


def logical_size(column: Column, dtype: T.DataType) -> Column:
    """Bytes of a value before encoding: 8 for numbers and times, 2 + UTF-8 bytes for text."""
    if isinstance(dtype, T.StringType):
        size = F.octet_length(column) + 2
    elif isinstance(dtype, T.BinaryType):
        size = F.octet_length(column) + 2
    elif isinstance(dtype, T.BooleanType):
        size = F.lit(1)
    elif isinstance(dtype, T.DecimalType):
        size = F.lit(16 if dtype.scale <= 9 else 32)
    elif isinstance(dtype, T.ArrayType):
        size = F.aggregate(
            column,
            F.lit(0).cast("bigint"),
            lambda total, x: total + logical_size(x, dtype.elementType),
        )
    elif isinstance(dtype, T.StructType):
        size = F.lit(0)
        for f in dtype.fields:
            size = size + logical_size(column[f.name], f.dataType)
    else:
        size = F.lit(8)
    return F.when(column.isNull(), F.lit(0)).otherwise(size).cast("bigint")


def row_size(df: DataFrame) -> Column:
    """Logical bytes of a row over all columns."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        total = total + logical_size(F.col(f"`{f.name}`"), f.dataType)
    return total


def discover(source: TableSource, with_bytes: bool = False) -> DataFrame:
    """Partitions of one table.

    Only the partitioning and modification columns are read, unless ``with_bytes`` asks
    for logical sizes. Rows are grouped by date; the id text is formatted once per group.
    """
    df = source.frame
    modified = F.max(F.col(source.modified_on)) if source.modified_on else F.lit(None)
    size = F.sum(row_size(df)) if with_bytes else F.lit(None)
    aggregates = [
        F.count(F.lit(1)).alias("total_rows"),
        size.cast("bigint").alias("total_logical_bytes"),
        modified.cast("timestamp_ntz").alias("last_modified"),
    ]
    if source.partition_on is None:
        grouped = df.agg(*aggregates).withColumn("partition_id", F.lit(ids.FULL))
    else:
        bucket = ids.partition_bucket(F.col(source.partition_on), source.granularity)
        grouped = (
            df.groupBy(bucket.alias("_bucket"))
            .agg(*aggregates)
            .withColumn("partition_id", ids.partition_id(F.col("_bucket"), source.granularity))
        )
    return grouped.withColumns(
        {
            "project": F.lit(source.project),
            "dataset": F.lit(source.dataset),
            "table": F.lit(source.table),
        }
    ).select(*PARTITION_COLUMNS)


def discover_shards(source: TableSource, with_bytes: bool = False) -> DataFrame:
    """Hash shards of a table without partitions, with the fingerprint of each one's content.

    All columns are read once; fingerprints are sums, so what is shuffled is one row per
    shard and task, and a shard with most of the rows costs no more than any other.
    """
    size = F.sum(row_size(source.frame)) if with_bytes else F.lit(None)
    grouped = source.frame.groupBy(source.partition_id().alias("partition_id")).agg(
        *hashing.fingerprint_aggregates(source.frame), size.cast("bigint").alias("total_logical_bytes")
    )
    return grouped.select(
        F.lit(source.project).alias("project"),
        F.lit(source.dataset).alias("dataset"),
        F.lit(source.table).alias("table"),
        "partition_id",
        F.col("row_count").alias("total_rows"),
        "total_logical_bytes",
        F.lit(None).cast("timestamp_ntz").alias("last_modified"),
        "fingerprint",
    )


def discover_all(
    sources: Sequence[TableSource],
    modified_since: Column | None = None,
    with_bytes: bool = False,
) -> DataFrame:
    """Partitions of many tables; optionally only those changed after one time."""
    parts = union_all([discover(s, with_bytes) for s in sources])
    if modified_since is not None:
        parts = parts.where(F.col("last_modified") > modified_since)
    return parts


def from_metadata(rows: DataFrame) -> DataFrame:
    """Partitions from a warehouse's own metadata rows; an unpartitioned table has a null id."""
    return rows.withColumn("partition_id", F.coalesce("partition_id", F.lit(ids.FULL)))


def discover_files(df: DataFrame, partition_on: str, dataset: str, table: str) -> DataFrame:
    """Partitions of a table in files: rows, stored bytes and newest file by partition."""
    per_file = df.groupBy(
        F.col(partition_on).alias("partition_id"),
        F.col("_metadata.file_path").alias("_path"),
    ).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max("_metadata.file_size").alias("_bytes"),
        F.max("_metadata.file_modification_time").alias("_time"),
    )
    return (
        per_file.groupBy("partition_id")
        .agg(
            F.sum("_rows").alias("total_rows"),
            F.sum("_bytes").alias("stored_bytes"),
            F.max("_time").alias("last_modified"),
        )
        .select(
            F.lit(dataset).alias("dataset"),
            F.lit(table).alias("table"),
            "partition_id",
            "total_rows",
            "stored_bytes",
            "last_modified",
        )
    )


def time_range(df: DataFrame, ts: str, *by: str, approximate: bool = False) -> DataFrame:
    """First and last time, rows and number of partition days."""
    day = F.to_date(ts)
    days = F.approx_count_distinct(day) if approximate else F.countDistinct(day)
    return df.groupBy(*by).agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("total_rows"),
        days.alias("partition_count"),
    )


def in_display_order(parts: DataFrame) -> DataFrame:
    return parts.orderBy("project", "dataset", "table", "partition_id")
