"""Which file each partition's rows go into, planned from bytes before anything is written.

A partition larger than a file is cut into pieces; partitions smaller than a file share files
with others of their batch. All of it works on one row per partition: rows are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIB = 1024 * 1024

# Bounds of a file.
TARGET_FILE_BYTES = 256 * MIB
SMALLEST_FILE_BYTES = 64 * MIB
LARGEST_FILE_BYTES = 2048 * MIB

# Partitions that are packed in one go, which bounds the lists of a packing.
PACKED_TOGETHER = 512

BATCH_KEY = ["dataset", "table", "batch"]


def file_count(
    stored_bytes: Column,
    target: int = TARGET_FILE_BYTES,
    smallest: int = SMALLEST_FILE_BYTES,
    largest: int = LARGEST_FILE_BYTES,
) -> Column:
    """Files for an amount of stored bytes, with the target kept between both bounds (64 MiB and 2 GiB)."""
    target = min(max(target, smallest), largest)
    return F.greatest(F.lit(1), F.ceil(stored_bytes / F.lit(target))).cast("int")


def first_fit(items: Column, room: int) -> Column:
    """Bins of sized items, taken in their order: each goes into the first bin with room for it.

    ``items`` is an array of structs whose field ``size`` is a BIGINT. The result has the bin
    number of each item, in the same order. An item beyond the room has a bin to itself.
    """

    def place(state: Column, item: Column) -> Column:
        size = item["size"]
        at = F.array_position(F.transform(state["free"], lambda free: free >= size), F.lit(True)) - 1
        filled = F.transform(state["free"], lambda free, i: F.when(i == at, free - size).otherwise(free))
        opened = F.concat(state["free"], F.array(F.lit(room).cast("bigint") - size))
        bin_no = F.when(at < 0, F.size(state["free"])).otherwise(at).cast("int")
        return F.struct(
            F.when(at < 0, opened).otherwise(filled).alias("free"),
            F.concat(state["bins"], F.array(bin_no)).alias("bins"),
        )

    start = F.struct(
        F.array().cast("array<bigint>").alias("free"), F.array().cast("array<int>").alias("bins")
    )
    return F.aggregate(items, start, place, lambda state: state["bins"])


def plan_files(
    parts: DataFrame,
    stored_bytes: Column,
    target: int = TARGET_FILE_BYTES,
    smallest: int = SMALLEST_FILE_BYTES,
    largest: int = LARGEST_FILE_BYTES,
) -> DataFrame:
    """Add ``pieces`` and ``first_file`` to each partition: its rows go into files
    ``first_file`` to ``first_file + pieces - 1`` of its table.

    ``parts`` has one row per partition with dataset, table, batch and partition_id. Partitions
    of one piece share files of their batch by first fit, largest first, among up to 512
    neighbours at a time. File numbers of a table begin at 0 and have no gaps; no file holds
    rows of two batches. Null or negative bytes count as none.
    """
    target = min(max(target, smallest), largest)
    size = F.greatest(F.coalesce(stored_bytes.cast("bigint"), F.lit(0)), F.lit(0).cast("bigint"))
    sized = parts.withColumn("_size", size).withColumn("pieces", file_count(F.col("_size"), target, smallest, largest))
    alone = sized.where("pieces > 1").withColumn("_unit", _unit(1, F.lit(0), F.lit(0), F.col("partition_id")))
    nth = F.row_number().over(Window.partitionBy(*BATCH_KEY).orderBy("partition_id")) - 1
    small = sized.where("pieces = 1").withColumn("_group", F.floor(nth / PACKED_TOGETHER).cast("int"))
    # Largest first; ties by id, so that a plan is the same whenever it is made.
    item = F.struct((-F.col("_size")).alias("order"), "partition_id", F.col("_size").alias("size"))
    packed = (
        small.groupBy(*BATCH_KEY, "_group")
        .agg(F.array_sort(F.collect_list(item)).alias("_items"))
        .select(*BATCH_KEY, "_group", F.explode(F.arrays_zip("_items", first_fit(F.col("_items"), target).alias("bins"))).alias("_p"))
        .select(
            *BATCH_KEY,
            F.col("_p._items.partition_id").alias("partition_id"),
            _unit(0, F.col("_group"), F.col("_p.bins"), F.lit("")).alias("_unit"),
        )
    )
    shared = small.drop("_group").join(packed, [*BATCH_KEY, "partition_id"])
    placed = alone.unionByName(shared)
    return placed.join(_numbered(placed), [*BATCH_KEY, "_unit"]).select(*parts.columns, "pieces", "first_file")


def _unit(kind: int, group: Column, number: Column, partition: Column) -> Column:
    """What files are numbered by: a shared file, or all files of a large partition."""
    return F.struct(
        F.lit(kind).alias("kind"), group.cast("int").alias("group"),
        number.cast("int").alias("number"), partition.alias("partition"),
    )


def _numbered(placed: DataFrame) -> DataFrame:
    """First file number of each unit: counted within batches, and over one row per batch of a table."""
    units = placed.groupBy(*BATCH_KEY, "_unit").agg(F.max("pieces").alias("_files"))
    before = Window.unboundedPreceding, -1
    inside = Window.partitionBy(*BATCH_KEY).orderBy("_unit").rowsBetween(*before)
    across = Window.partitionBy("dataset", "table").orderBy("batch").rowsBetween(*before)
    earlier = (
        units.groupBy(*BATCH_KEY)
        .agg(F.sum("_files").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(across), F.lit(0)))
        .drop("_n")
    )
    within = units.withColumn("_at", F.coalesce(F.sum("_files").over(inside), F.lit(0)))
    number = (F.col("_start") + F.col("_at")).cast("int")
    return within.join(earlier, BATCH_KEY).select(*BATCH_KEY, "_unit", number.alias("first_file"))
