"""Compare two sides of a table top down by a tree of additive fingerprints.

The leaves are the fingerprints of key buckets inside partitions; a partition's fingerprint is
the sum of its buckets', the table's that of its partitions. Leaves are stored, so the levels
above them are sums of stored rows. Two tables are compared from the top: only partitions that
differ have their buckets compared, and only rows of buckets that differ are read again and
compared by value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.functions import hashing
from floodmark.operators import verify
from floodmark.operators.keyed import join_per_key
from floodmark.plans import export
from floodmark.session import stored
from floodmark.sources.tables import TableSource

BUCKETS = 256
LEAF = ["partition_id", "bucket"]


def _placed(source: TableSource, key: str, buckets: int) -> DataFrame:
    """Rows with the partition and the bucket they belong to; a null key is in bucket 0."""
    bucket = F.coalesce(hashing.hash_shard(F.col(key), buckets), F.lit(0)).cast("bigint")
    return source.frame.withColumns({"partition_id": source.partition_id(), "bucket": bucket})


def leaves(source: TableSource, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Stored fingerprints of the buckets of each partition, from one scan of the source.

    Sums combine before the shuffle; a partition or a bucket with most of the rows is one row
    of each task.
    """
    rows = _placed(source, key, buckets)
    found = rows.groupBy(*LEAF).agg(*hashing.fingerprint_aggregates(rows, [key, *columns]))
    return stored(found, "digests")


def level(leaf: DataFrame, *by: str) -> DataFrame:
    """Fingerprints of an upper level, summed from leaves; without columns that of the table."""
    total = F.coalesce(F.sum(F.col("fingerprint").cast("decimal(38,0)")), F.lit(0)).cast("string")
    return leaf.groupBy(*by).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), total.alias("fingerprint"))


def _unequal(one: DataFrame, other: DataFrame, by: Sequence[str]) -> DataFrame:
    """Nodes of a level that are missing on one side or differ."""
    told = F.struct("row_count", "fingerprint")
    joined = one.select(*by, told.alias("_one")).join(other.select(*by, told.alias("_other")), list(by), "full")
    return joined.where(~F.col("_one").eqNullSafe(F.col("_other"))).select(*by)


def differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """Leaves that differ, found from the top: equal tables and partitions are not looked into."""
    if level(one).first() == level(other).first():
        return one.select(*LEAF).limit(0)
    partitions = stored(_unequal(level(one, "partition_id"), level(other, "partition_id"), ["partition_id"]), "unequal")
    inside = [side.join(partitions, "partition_id", "left_semi") for side in (one, other)]
    return stored(_unequal(*inside, LEAF), "unequal")


def rows_of(source: TableSource, key: str, nodes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows of the given leaves. Ranges of the partitions' raw column reach the file statistics."""
    if source.partition_on is not None:
        spans = export.planned_spans(source, nodes.select("partition_id"))
        source = replace(source, frame=export.within_spans(source, spans))
    return join_per_key(_placed(source, key, buckets), nodes, LEAF, "left_semi")


def value_diff(
    source: TableSource,
    copy: TableSource,
    key: str,
    columns: Sequence[str],
    buckets: int = BUCKETS,
    trees: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Keys whose rows differ between two sides: key, status, columns (see verify.value_diff).

    ``trees`` are stored leaves of both sides, such as those of the day of an export.
    """
    one, other = trees or (leaves(source, key, columns, buckets), leaves(copy, key, columns, buckets))
    nodes = differing(one, other)
    return verify.value_diff(rows_of(source, key, nodes, buckets), rows_of(copy, key, nodes, buckets), key, columns)
