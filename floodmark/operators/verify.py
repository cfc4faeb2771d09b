"""Compare what was exported with what should have been."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.functions import hashing
from floodmark.operators import discovery
from floodmark.sources.tables import TableSource


def count_rows(df: DataFrame, partition: Column) -> DataFrame:
    """Rows by the value of an expression; only what it needs is read."""
    return df.groupBy(partition.alias("partition_id")).agg(F.count(F.lit(1)).alias("row_count"))


def count_partitions(source: TableSource) -> DataFrame:
    """Rows by partition of a source, grouped by date before the id is printed."""
    found = discovery.discover(replace(source, modified_on=None))
    return found.select("partition_id", F.col("total_rows").alias("row_count"))


def compare_counts(
    source: DataFrame, exported: DataFrame, key: Sequence[str] = ("partition_id",)
) -> DataFrame:
    """Counts of both sides by partition with a match flag; a missing side does not match."""
    key = list(key)
    left = source.select(*key, F.col("row_count").alias("source_rows"))
    right = exported.select(*key, F.col("row_count").alias("exported_rows"))
    return left.join(right, key, "full").withColumn(
        "matches", F.col("source_rows").eqNullSafe(F.col("exported_rows"))
    )


def sampled(counts: DataFrame, rate: float, key: str = "partition_id") -> DataFrame:
    """The repeatable sample of partitions to verify. Whole partitions are taken."""
    return counts.where(hashing.in_sample(F.col(key), rate))


def fingerprint_by(
    df: DataFrame, partition: Column, columns: Sequence[str] | None = None
) -> DataFrame:
    """Row count and order-independent content fingerprint by partition."""
    return df.groupBy(partition.alias("partition_id")).agg(
        *hashing.fingerprint_aggregates(df, columns)
    )


def compare_content(source: DataFrame, exported: DataFrame) -> DataFrame:
    """Counts and fingerprints of both sides by partition."""
    left = source.select(
        "partition_id",
        F.col("row_count").alias("source_rows"),
        F.col("fingerprint").alias("source_fp"),
    )
    right = exported.select(
        "partition_id",
        F.col("row_count").alias("exported_rows"),
        F.col("fingerprint").alias("exported_fp"),
    )
    return left.join(right, "partition_id", "full").select(
        "partition_id",
        "source_rows",
        "exported_rows",
        (
            F.col("source_rows").eqNullSafe(F.col("exported_rows"))
            & F.col("source_fp").eqNullSafe(F.col("exported_fp"))
        ).alias("matches"),
    )


def value_diff(
    source: DataFrame,
    exported: DataFrame,
    key: str,
    columns: Sequence[str],
    rate: float = 1.0,
) -> DataFrame:
    """Rows of the sampled keys that differ, with the names of the differing columns.

    Both sides are put under each other and grouped by key, so a key that occurs many
    times is counted and reported as ``duplicate`` and never joined with itself.
    """
    sides = []
    for side, df in (("s", source), ("e", exported)):
        picked = df.where(hashing.in_sample(F.col(key), rate)) if rate < 1 else df
        sides.append(picked.select(key, F.struct(*columns).alias("row"), F.lit(side).alias("side")))
    src, exp = F.col("side") == "s", F.col("side") == "e"
    grouped = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(key)
        .agg(
            F.count_if(src).alias("ns"),
            F.count_if(exp).alias("ne"),
            F.max(F.when(src, F.col("row"))).alias("s"),
            F.max(F.when(exp, F.col("row"))).alias("e"),
        )
    )
    differing = F.filter(
        F.array(
            *[
                F.when(~F.col(f"s.`{c}`").eqNullSafe(F.col(f"e.`{c}`")), F.lit(c))
                for c in columns
            ]
        ),
        lambda x: x.isNotNull(),
    )
    status = (
        F.when((F.col("ns") > 1) | (F.col("ne") > 1), "duplicate")
        .when(F.col("ne") == 0, "missing")
        .when(F.col("ns") == 0, "extra")
        .when(F.size(differing) > 0, "changed")
        .otherwise("same")
    )
    return grouped.select(
        key,
        status.alias("status"),
        F.when(status == "changed", F.array_join(differing, ",")).otherwise("").alias("columns"),
    ).where(F.col("status") != "same")
