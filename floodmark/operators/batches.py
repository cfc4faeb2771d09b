"""Plan partitions into batches of N calendar days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.functions import ids
from floodmark.operators.keyed import join_per_key

TABLE_KEY = ["dataset", "table"]
DEFAULT_DAYS = 7
# Batch of the ids that are not days in a table whose first and last ids are.
OTHER = -1


def assign_batches(parts: DataFrame, days: int = DEFAULT_DAYS) -> DataFrame:
    """Add ``batch_idx`` to each partition.

    Batches start at the table's own first day, so neither the epoch nor the week moves
    their edges. If the smallest or the largest id of a table is not a day, the table is
    one batch. Ids between them that are not days get a batch of their own, so every
    partition is planned exactly once.
    """
    if days <= 0:
        days = DEFAULT_DAYS
    edges = (
        parts.groupBy(*TABLE_KEY)
        .agg(F.min("partition_id").alias("_lo"), F.max("partition_id").alias("_hi"))
        .select(
            *TABLE_KEY,
            ids.partition_day(F.col("_lo")).alias("_first"),
            ids.partition_day(F.col("_hi")).alias("_last"),
        )
    )
    day = ids.partition_day(F.col("partition_id"))
    index = (
        F.when(F.col("_first").isNull() | F.col("_last").isNull(), F.lit(0))
        .when(day.isNull(), F.lit(OTHER))
        .otherwise(F.floor(F.date_diff(day, F.col("_first")) / days))
    )
    return (
        join_per_key(parts, edges, TABLE_KEY, "inner")
        .withColumn("batch_idx", index.cast("bigint"))
        .drop("_first", "_last")
    )


def summarise_batches(assigned: DataFrame) -> DataFrame:
    """One row per batch: first and last partition, partitions, rows."""
    return assigned.groupBy(*TABLE_KEY, "batch_idx").agg(
        F.min("partition_id").alias("start_pid"),
        F.max("partition_id").alias("end_pid"),
        F.count(F.lit(1)).alias("n_partitions"),
        F.sum("total_rows").alias("total_rows"),
    )


def plan_batches(parts: DataFrame, days: int = DEFAULT_DAYS) -> DataFrame:
    return summarise_batches(assign_batches(parts, days))


def label_batches(assigned: DataFrame) -> DataFrame:
    """Add the ``<first>_<last>`` label of its batch to each partition."""
    key = [*TABLE_KEY, "batch_idx"]
    labels = assigned.groupBy(*key).agg(
        ids.batch_label(F.min("partition_id"), F.max("partition_id")).alias("batch")
    )
    return join_per_key(assigned, labels, key, "inner")
