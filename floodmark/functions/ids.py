"""Partition ids, table names, paths and timestamps as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The id given to a table without partitions, and to rows whose
# partitioning column is null.
FULL = "full"
SHARD = "shard"
NULL_PARTITION = "__NULL__"

# Id patterns of time-partitioned tables by granularity.
ID_PATTERNS = {
    "hour": "yyyyMMddHH",
    "day": "yyyyMMdd",
    "month": "yyyyMM",
    "year": "yyyy",
}


def partition_day(pid: Column) -> Column:
    """Day of a ``yyyyMMdd`` id; null for every other shape and for days that do not exist."""
    return F.when(pid.rlike("^[0-9]{8}$"), F.try_to_date(pid, "yyyyMMdd"))


def partition_date_text(pid: Column) -> Column:
    """``yyyy-MM-dd`` text of an eight-character id; null for any other length."""
    return F.when(
        F.char_length(pid) == 8,
        F.concat_ws("-", F.substring(pid, 1, 4), F.substring(pid, 5, 2), F.substring(pid, 7, 2)),
    )


def partition_id(bucket: Column, granularity: str = "day") -> Column:
    """Partition id of a truncated date or timestamp."""
    return F.coalesce(F.date_format(bucket, ID_PATTERNS[granularity]), F.lit(NULL_PARTITION))


def partition_bucket(ts: Column, granularity: str = "day") -> Column:
    """What to group rows by before formatting the id: formatting then runs once per group."""
    if granularity == "day":
        return F.to_date(ts)
    if granularity not in ID_PATTERNS:
        raise ValueError(f"unknown granularity {granularity!r}")
    return F.date_trunc(granularity, ts)


def bucket_of_id(pid: Column, granularity: str = "day") -> Column:
    """The bucket that :func:`partition_id` printed; null for the id of null values."""
    if granularity == "day":
        return partition_day(pid)
    pattern = ID_PATTERNS[granularity]
    shape = pid.rlike(f"^[0-9]{{{len(pattern)}}}$")
    return F.when(shape, F.try_to_timestamp(pid, F.lit(pattern)))


def table_parts(name: Column) -> Column:
    """``struct(dataset, table)`` of ``dataset.table``; null when there is no dot.

    Only the first dot splits, so ``a.b.c`` is table ``b.c`` of dataset ``a``.
    """
    parts = F.split(name, r"\.", 2)
    return F.when(
        F.size(parts) == 2, F.struct(parts[0].alias("dataset"), parts[1].alias("table"))
    )


def shard_id(shard: Column, shards: int) -> Column:
    """Id of a hash shard. It names the number of shards: another number makes other ids."""
    return F.format_string(f"{SHARD}-{shards:05d}-%05d", shard)


def kind_of_id(pid: Column) -> Column:
    """Whether an id names a whole table, a hash shard or a span of time."""
    return (
        F.when(pid == FULL, F.lit("whole"))
        .when(pid.startswith(f"{SHARD}-"), F.lit("shards"))
        .otherwise(F.lit("times"))
    )


def batch_label(start: Column, end: Column) -> Column:
    return F.concat(start, F.lit("_"), end)


def export_path(dataset: Column, table: Column, version: Column, leaf: Column) -> Column:
    """Relative directory of an export, with the schema version in the path."""
    return F.format_string(
        "dataset=%s/table=%s/schema_version=v%d/%s", dataset, table, version.cast("int"), leaf
    )


def rfc3339(ts: Column) -> Column:
    """RFC 3339 text of a UTC wall-clock timestamp."""
    return F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_stamp(ts: Column) -> Column:
    """Directory-safe stamp of a full export."""
    return F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH-mm-ss")
