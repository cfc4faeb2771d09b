"""Source tables: what to read, which column partitions it, which column dates its changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.functions import ids
from floodmark.functions.hashing import hash_shard


@dataclass(frozen=True)
class TableSource:
    """A table to export. Without ``partition_on`` the whole table is one partition.

    With ``shard_on`` instead, the table is cut into hash shards of that column, and a run
    writes only the shards whose content changed.
    """

    dataset: str
    table: str
    frame: DataFrame
    partition_on: str | None = None
    modified_on: str | None = None
    project: str = "default"
    granularity: str = "day"
    cluster_by: tuple[str, ...] = ()
    shard_on: str | None = None
    shards: int = 16
    # Modes that a DataFrame cannot tell, such as REQUIRED, by dotted path.
    modes: dict[str, str] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.dataset}.{self.table}"

    def __post_init__(self) -> None:
        if self.shard_on is not None and self.partition_on is not None:
            raise ValueError("a table is cut by time or into shards, not both")
        if not 0 < self.shards < 100_000:
            raise ValueError("shards must lie between 1 and 99,999")

    @property
    def kind(self) -> str:
        return "times" if self.partition_on else "shards" if self.shard_on else "whole"

    def partition_id(self) -> Column:
        if self.shard_on is not None:
            shard = F.coalesce(hash_shard(F.col(self.shard_on), self.shards), F.lit(0))
            return ids.shard_id(shard, self.shards)
        if self.partition_on is None:
            return F.lit(ids.FULL)
        bucket = ids.partition_bucket(F.col(self.partition_on), self.granularity)
        return ids.partition_id(bucket, self.granularity)


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Full scan of a Parquet table; naming columns prunes the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df.select("*")


def scan_partition(source: TableSource, partition: str) -> DataFrame:
    """Rows of one partition.

    A day partition becomes a range on the raw column, which reaches the Parquet
    footers; an equality on the computed id would not.
    """
    if source.partition_on is None:
        return source.frame if partition == ids.FULL else source.frame.limit(0)
    column = F.col(source.partition_on)
    if partition == ids.NULL_PARTITION:
        return source.frame.where(column.isNull())
    if source.granularity == "day" and len(partition) == 8:
        start = F.to_timestamp_ntz(F.lit(partition), F.lit("yyyyMMdd"))
        dtype = source.frame.schema[source.partition_on].dataType.simpleString()
        end = start + F.expr("INTERVAL 1 DAY")
        return source.frame.where((column >= start.cast(dtype)) & (column < end.cast(dtype)))
    return source.frame.where(source.partition_id() == partition)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name, as a balanced tree: a chain is analysed once per frame again."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to unite")
    while len(frames) > 1:
        pairs = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = pairs + frames[len(frames) // 2 * 2 :]
    return frames[0]


def with_text(schema: T.StructType, *names: str) -> T.StructType:
    """Schema with text columns added, such as the names of partition directories."""
    return T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in names]])
