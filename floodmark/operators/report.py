"""Summaries of ledgers: tables, runs, counters, durations, lag, ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.functions import classify

TABLE_KEY = ["dataset", "table"]

# Upper bounds in seconds of the duration buckets.
DURATION_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


def summary(tables: DataFrame, partitions: DataFrame) -> DataFrame:
    """Partitions, rows and bytes of each table, zeros where it has none.

    Partitions are summed before the join, so it meets one row per table on each side.
    """
    sums = partitions.groupBy(*TABLE_KEY).agg(
        F.count("partition_id").alias("_n"),
        F.sum("row_count").alias("_rows"),
        F.sum("bytes").alias("_bytes"),
    )
    zero = F.lit(0)
    return tables.join(sums, TABLE_KEY, "left").select(
        *tables.columns,
        F.coalesce("_n", zero).alias("partition_count"),
        F.coalesce("_rows", zero).alias("total_rows"),
        F.coalesce("_bytes", zero).alias("total_bytes"),
    )


def in_display_order(summaries: DataFrame) -> DataFrame:
    return summaries.orderBy(*TABLE_KEY)


def table_detail(
    versions: DataFrame, partitions: DataFrame, dataset: str, table: str
) -> tuple[DataFrame, DataFrame]:
    """Schema versions and partitions of one table."""
    only = (F.col("dataset") == dataset) & (F.col("table") == table)
    return (
        versions.where(only).orderBy("version"),
        partitions.where(only).orderBy("partition_id"),
    )


def counters(tasks: DataFrame, by: Sequence[str] = (*TABLE_KEY, "state")) -> DataFrame:
    """Tasks, rows and stored bytes by labels; rows and bytes are separate counters."""
    return tasks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.sum("rows").alias("rows_extracted"),
        F.sum("stored_bytes").alias("bytes_stored"),
    )


def compression_ratio(sizes: DataFrame, raw: str, stored: str, by: Sequence[str]) -> DataFrame:
    """Extracted over stored bytes; null where nothing is stored."""
    raw_sum, stored_sum = F.sum(raw), F.sum(stored)
    return sizes.groupBy(*by).agg(
        raw_sum.alias("raw_bytes"),
        stored_sum.alias("stored_bytes"),
        (raw_sum.cast("double") / F.nullif(stored_sum, F.lit(0))).alias("ratio"),
    )


def duration_histogram(
    tasks: DataFrame, seconds: str, by: Sequence[str], bounds: Sequence[float] = DURATION_BOUNDS
) -> DataFrame:
    """Cumulative counts of durations by upper bound, with count and sum by label.

    One pass counts every bound; the row per bound is unfolded after the aggregation.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(float(b)).alias("le"), F.count_if(F.col(seconds) <= F.lit(float(b))).alias("n")
            )
            for b in bounds
        ],
        F.struct(
            F.lit(float("inf")).alias("le"), F.count_if(F.col(seconds).isNotNull()).alias("n")
        ),
    )
    return (
        tasks.groupBy(*by)
        .agg(pairs.alias("_buckets"))
        .select(*by, F.explode("_buckets").alias("_b"))
        .select(*by, F.col("_b.le").alias("le"), F.col("_b.n").alias("cumulative_count"))
    )


def duration_percentiles(tasks: DataFrame, seconds: str, by: Sequence[str]) -> DataFrame:
    points = F.percentile_approx(seconds, [0.5, 0.9, 0.99])
    return (
        tasks.groupBy(*by)
        .agg(points.alias("_p"))
        .select(
            *by,
            F.col("_p")[0].alias("p50"),
            F.col("_p")[1].alias("p90"),
            F.col("_p")[2].alias("p99"),
        )
    )


def lag(partitions: DataFrame, synced: str, now: Column) -> DataFrame:
    """Seconds since each partition was last exported."""
    return partitions.withColumn("lag_seconds", F.timestamp_diff("SECOND", F.col(synced), now))


def run_totals(tasks: DataFrame) -> DataFrame:
    """Tasks of each run, and the run's state in view of those that failed."""
    done, failed = F.col("state") == "completed", F.col("state") == "failed"
    return (
        tasks.groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("total_tasks"),
            F.count_if(done).alias("completed_tasks"),
            F.count_if(failed).alias("failed_tasks"),
        )
        .withColumn(
            "run_state",
            F.when(F.col("completed_tasks") == F.col("total_tasks"), "completed")
            .when(F.col("completed_tasks") > 0, "partial")
            .otherwise("failed"),
        )
    )


def error_classes(log: DataFrame, message: str, by: Sequence[str] = ()) -> DataFrame:
    return log.groupBy(*by, classify.error_class(F.col(message)).alias("error_class")).agg(
        F.count(F.lit(1)).alias("n_errors")
    )


def rollup(df: DataFrame, levels: Sequence[str | Column], *aggregates: Column) -> DataFrame:
    """Aggregates at every level from the finest to the whole; ``level`` tells them apart."""
    return df.rollup(*levels).agg(F.grouping_id().alias("level"), *aggregates)
