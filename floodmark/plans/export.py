"""Write exports as Parquet: codec, file sizes, layout, and publication through the manifest."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.functions import ids
from floodmark.functions.hashing import hash_shard
from floodmark.operators.discovery import row_size
from floodmark.operators.filesizes import (
    LARGEST_FILE_BYTES,
    MIB,
    SMALLEST_FILE_BYTES,
    TARGET_FILE_BYTES,
    file_count as file_count,  # noqa: F401  (callers find it here)
)
from floodmark.operators.keyed import join_per_key
from floodmark.session import stored
from floodmark.sources.tables import TableSource, union_all, with_text

# Writer settings of an export.
ZSTD_LEVEL = 9
PAGE_BYTES = 1 * MIB
DICTIONARY_BYTES = 2 * MIB
GROUP_ROWS = 1_048_576
FORMAT = "v2"
CODECS = ("zstd", "snappy")

# Ranges in the filter of one scan; more ranges are read by more scans, never by a wider one.
RANGES_A_SCAN = 64

# Shuffled rows take about this many times the bytes of the Parquet files they become.
SHUFFLE_TO_FILE = 3

# Shuffled bytes that a task sorts at most: a file of the smallest size. Sorting takes some six times
# as much memory.
SORTED_BYTES = SMALLEST_FILE_BYTES * SHUFFLE_TO_FILE

# Directories that a task writes at once. A task of no more than these need not sort its rows by
# directory; Spark sorts what is left when there are more.
OPEN_FILES = 32

# Rows for each file that the cuts of a large partition are drawn from: pieces differ by some 6 %.
ROWS_A_CUT = 256


@dataclass(frozen=True)
class Layout:
    """How rows are spread over files.

    ``max_rows`` bounds a file whatever its bytes, ``group_rows`` a row group. ``smallest_bytes``
    and ``largest_bytes`` bound the target of files that are planned by size.
    """

    codec: str = "zstd"
    level: int = ZSTD_LEVEL
    target_bytes: int = TARGET_FILE_BYTES
    max_rows: int = 0
    group_rows: int = GROUP_ROWS
    cluster_by: tuple[str, ...] = ()
    smallest_bytes: int = SMALLEST_FILE_BYTES
    largest_bytes: int = LARGEST_FILE_BYTES

    def __post_init__(self) -> None:
        if self.codec not in CODECS:
            raise ValueError(f"unknown codec {self.codec!r}, use one of {', '.join(CODECS)}")


_SIZING = threading.Lock()
# Advisory sizes of the writes that go on in a session, and its settings before the first of them.
_WRITES: dict[SparkSession, list[int]] = {}
_BEFORE: dict[SparkSession, dict[str, str | None]] = {}


def task_bytes(layout: Layout) -> int:
    """Shuffled bytes for each task of a rebalanced write: those of a file, less where they are sorted."""
    wanted = layout.target_bytes * SHUFFLE_TO_FILE
    return min(wanted, SORTED_BYTES) if layout.cluster_by else wanted


@contextmanager
def file_sizing(spark: SparkSession, layout: Layout) -> Iterator[None]:
    """Let AQE cut and merge the tasks of a rebalanced write towards the target file size.

    Rows that are not clustered are not sorted either: a task keeps the files of its
    directories open side by side, so its memory is that of its row groups. Settings belong to
    the session: of writes that go on at once, the smallest size holds for all.
    """
    size = task_bytes(layout)

    def advise() -> None:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(_WRITES[spark])))

    with _SIZING:
        if spark not in _WRITES:
            wanted = {
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
                "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
                "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
            }
            _BEFORE[spark] = {key: spark.conf.get(key, None) for key in wanted}
            for key, value in wanted.items():
                spark.conf.set(key, value)
        _WRITES.setdefault(spark, []).append(size)
        advise()
    try:
        yield
    finally:
        with _SIZING:
            _WRITES[spark].remove(size)
            if _WRITES[spark]:
                advise()
            else:
                del _WRITES[spark]
                for key, value in _BEFORE.pop(spark).items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_parquet(
    df: DataFrame,
    path: str,
    layout: Layout = Layout(),
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    dynamic: bool = False,
) -> None:
    """Write with the export's codec and page settings.

    ``dynamic`` overwrites only the partitions that occur in ``df``.
    """
    writer = (
        df.write.mode(mode)
        .option("compression", layout.codec)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.dictionary.page.size", DICTIONARY_BYTES)
        .option("parquet.block.row.count.limit", layout.group_rows)
        .option("parquet.writer.version", FORMAT)
    )
    if layout.codec == "zstd":
        writer = writer.option("parquet.compression.codec.zstd.level", layout.level)
    if layout.max_rows:
        writer = writer.option("maxRecordsPerFile", layout.max_rows)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with file_sizing(df.sparkSession, layout):
        writer.parquet(path)


def write_counted(df: DataFrame, path: str, name: str, **options) -> int:
    """Write and return the number of rows that went into the files, from the same job."""
    seen = Observation(name)
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, **options)
    return seen.get["rows"]


def arrange(df: DataFrame, by: Sequence[str], layout: Layout = Layout()) -> DataFrame:
    """Bring the rows of each directory together in tasks of about one file each.

    A rebalance shuffles by the directory columns and lets AQE cut a large directory
    into several tasks and merge small ones, by measured bytes. A directory with a third
    of all rows is written by as many tasks as it needs. The cut follows map outputs,
    so a task that is run again after a lost executor gets the same rows.
    """
    spread = df.hint("rebalance", *by) if by else df.hint("rebalance")
    if layout.cluster_by:
        spread = spread.sortWithinPartitions(*by, *layout.cluster_by)
    return spread


@dataclass(frozen=True)
class Spans:
    """Ranges of adjacent planned buckets, both ends included, and whether null rows are planned."""

    ranges: tuple[tuple, ...]
    nulls: bool


def planned_spans(source: TableSource, plan: DataFrame) -> Spans:
    """Ranges of adjacent buckets of a plan that has one row per partition of one table.

    Buckets that were not planned are in no range, however many ranges that makes. What
    reaches the driver is one row per range, from one job.
    """
    step = F.expr(f"INTERVAL 1 {source.granularity.upper()}")
    bucket = ids.bucket_of_id(F.col("partition_id"), source.granularity).cast("timestamp_ntz")
    buckets = plan.select(bucket.alias("bucket")).distinct()
    order = Window.orderBy("bucket")
    opens = ~F.lag("bucket").over(order).eqNullSafe(F.col("bucket") - step)
    # Null buckets sort first and open nothing, so they are run 0, which no other bucket is in.
    runs = (
        buckets.withColumn("run", F.sum((opens & F.col("bucket").isNotNull()).cast("int")).over(order))
        .groupBy("run")
        .agg(F.min("bucket").alias("first"), F.max("bucket").alias("last"))
        .collect()
    )
    ranges = sorted((r["first"], r["last"]) for r in runs if r["first"] is not None)
    return Spans(tuple(ranges), len(ranges) < len(runs))


def within_spans(source: TableSource, spans: Spans) -> DataFrame:
    """Rows of a source that belong to the planned buckets.

    The filters are ranges on the raw partitioning column, so they reach the file
    statistics: exporting some changed days does not read the days between them.
    """
    column = F.col(source.partition_on)
    dtype = source.frame.schema[source.partition_on].dataType
    step = F.expr(f"INTERVAL 1 {source.granularity.upper()}")

    def one(first, last) -> Column:
        end = F.lit(last).cast("timestamp_ntz") + step
        return (column >= F.lit(first).cast(dtype)) & (column < end.cast(dtype))

    hits = [one(*r) for r in spans.ranges] + ([column.isNull()] if spans.nulls else [])
    scans = []
    for k in range(0, len(hits), RANGES_A_SCAN):
        some = hits[k : k + RANGES_A_SCAN]
        while len(some) > 1:  # a balanced tree, as a long chain of ORs nests too deep
            some = [a | b for a, b in zip(some[::2], some[1::2])] + some[len(some) // 2 * 2 :]
        scans.append(source.frame.where(some[0]))
    return union_all(scans) if scans else source.frame.where(F.lit(False))


def assign_rows(source: TableSource, plan: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of the planned partitions with their partition id and batch, and more of the plan's columns.

    ``plan`` has one row per partition. Rows meet it by date or truncated time, and take
    the id's text from it, so no text is made per row.
    """
    if source.shard_on is not None:
        known = plan.where("total_rows > 0").select("partition_id", "batch", *carry)
        return join_per_key(source.frame.withColumn("partition_id", source.partition_id()), known, ["partition_id"], "inner")
    if source.partition_on is None:
        label = ids.batch_label(F.lit(ids.FULL), F.lit(ids.FULL))
        rows = source.frame.withColumns({"partition_id": F.lit(ids.FULL), "batch": label})
        return join_per_key(rows, plan.select("partition_id", *carry), ["partition_id"], "inner") if carry else rows

    def keyed(bucket: Column) -> dict[str, Column]:
        # An equality join never matches nulls, so they get a flag of their own.
        zero = F.lit("1970-01-01").cast("timestamp_ntz")
        bucket = bucket.cast("timestamp_ntz")
        return {"_bucket": F.coalesce(bucket, zero), "_none": bucket.isNull()}

    rows = within_spans(source, planned_spans(source, plan)).withColumns(
        keyed(ids.partition_bucket(F.col(source.partition_on), source.granularity))
    )
    known = plan.select("partition_id", "batch", *carry).withColumns(
        keyed(ids.bucket_of_id(F.col("partition_id"), source.granularity))
    )
    key = ["_bucket", "_none"]
    return join_per_key(rows, known, key, "inner").drop(*key)


def safe_name(name: str) -> str:
    """Names become directories; refuse those that would need escaping."""
    if not re.fullmatch(r"[A-Za-z0-9_\-]+", name):
        raise ValueError(f"name {name!r} cannot be a directory")
    return name


def table_dir(root: str, dataset: str, table: str) -> str:
    return f"{root.rstrip('/')}/data/dataset={safe_name(dataset)}/table={safe_name(table)}"


def run_dir(root: str, dataset: str, table: str, version: int, run_id: str) -> str:
    """Directory that only this run writes. Nothing reads it before the run is closed."""
    return f"{table_dir(root, dataset, table)}/schema_version=v{version}/run={safe_name(run_id)}"


def export_batches(
    source: TableSource,
    plan: DataFrame,
    target: str,
    layout: Layout = Layout(),
) -> None:
    """Write the planned partitions, one directory per batch.

    The partition id stays in the files: a later run that exports one of the batch's
    partitions again replaces just those rows for readers. A plan that names files
    (``filesizes.plan_files``) is followed: each file is one task's work.
    """
    if "first_file" in plan.columns:
        files, rows, size = plan.agg(
            F.max(F.col("first_file") + F.col("pieces")), F.sum("total_rows"), F.sum("stored_bytes")
        ).first()
        if files is not None:
            write_planned(source, plan, files, target, _bounded(layout, rows, size))
            return
    rows = assign_rows(source, plan)
    # A table that is one partition is one batch: its input splits become its files.
    whole = source.kind == "whole" and not layout.cluster_by
    by = ["batch", "partition_id"] if source.kind == "shards" else ["batch"]
    arranged = rows if whole else arrange(rows, by, layout)
    write_parquet(arranged, target, layout, ["batch"])


def _bounded(layout: Layout, rows: int, size: int) -> Layout:
    """The layout with the rows of the largest file, should rows that are alike leave a piece too big."""
    most = max(1, layout.largest_bytes * max(rows, 1) // max(size, 1))
    return replace(layout, max_rows=min(layout.max_rows or most, most))


def row_place(frame: DataFrame, by: Sequence[str]) -> Column:
    """Where a row stands in its partition: by the clustering columns, then by a hash of the row.

    The hash parts rows of a clustering value that is more than a file holds, and orders
    partitions of tables that are not clustered. Nulls come first.
    """
    hashed = [F.col(f"`{f.name}`") for f in frame.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(by)], F.xxhash64(*hashed).alias("h"))


def cut_points(source: TableSource, plan: DataFrame, by: Sequence[str]) -> DataFrame:
    """Where the partitions of several pieces are cut: weighted quantiles of their rows' places.

    Each row weighs its logical bytes. The cuts are drawn from rows picked at a rate that gives
    each piece about ``ROWS_A_CUT`` of them, and from all rows of partitions that have no more;
    the rows that are written are all rows. One row per partition: ``cuts``, in order. Rows
    that are alike have one place and are never cut apart.
    """
    large = plan.where("pieces > 1").withColumn(
        "_rate", F.least(F.lit(1.0), F.lit(ROWS_A_CUT) * F.col("pieces") / F.col("total_rows"))
    )
    rows = assign_rows(source, large, ["pieces", "_rate"]).where(F.rand(7) <= F.col("_rate"))
    weighed = rows.select(
        "partition_id", "pieces",
        row_place(source.frame, by).alias("place"),
        (row_size(source.frame) + 1).alias("weight"),
    )
    whole = Window.partitionBy("partition_id")
    before = whole.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.sum("weight").over(before), F.lit(0))
    piece = F.floor(reached * F.col("pieces") / F.sum("weight").over(whole))
    opens = weighed.withColumn("piece", piece).groupBy("partition_id", "piece").agg(F.min("place").alias("place"))
    return opens.where("piece > 0").groupBy("partition_id").agg(F.array_sort(F.collect_list("place")).alias("cuts"))


def with_piece(rows: DataFrame, place: Column, most: int, out: str) -> DataFrame:
    """Rows with how many of their ordered ``cuts``, ``most`` of them at the most, are not beyond their place.

    A binary search, each step a projection of its own: Spark compiles them into one loop with the
    join that brings the cuts. A row only points to its partition's cuts, however many there are;
    a lambda function would not be compiled, and every row would get a copy of them.
    """
    rows = rows.withColumns({"_place": place, out: F.lit(0)})
    for k in reversed(range(most.bit_length())):
        there = F.col(out) + (1 << k)
        rows = rows.withColumn(out, F.when(F.get("cuts", there - 1) <= F.col("_place"), there).otherwise(F.col(out)))
    return rows.drop("_place")


def write_planned(source: TableSource, plan: DataFrame, n_files: int, target: str, layout: Layout) -> None:
    """Write the planned partitions into the files that the plan names, with one shuffle.

    The number of a row's file is the number of the task that writes it, so neither hash
    collisions nor merged tasks change a file's size, and a task that runs again gets the same
    rows. Pieces of a clustered partition are ranges of the clustering columns.
    """
    carry = ["first_file"]
    most = plan.agg(F.max("pieces")).first()[0]
    if most > 1:
        cuts = stored(cut_points(source, plan, layout.cluster_by), "cuts")
        # Written, so that its true size decides how rows meet it: the estimate of a join is a product.
        plan = stored(join_per_key(plan, cuts, ["partition_id"], "left"), "pieces")
        carry.append("cuts")
    rows = assign_rows(source, plan, carry)
    number = F.col("first_file")
    if "cuts" in carry:
        rows = with_piece(rows, row_place(source.frame, layout.cluster_by), most - 1, "_piece")
        number = number + F.col("_piece")
    dealt = rows.withColumn("first_file", number.cast("int")).drop("cuts", "_piece").repartitionById(n_files, F.col("first_file"))
    dealt = dealt.drop("first_file")
    if layout.cluster_by:  # a file is of one batch, so rows that are not clustered need no order
        dealt = dealt.sortWithinPartitions("batch", *layout.cluster_by)
    write_parquet(dealt, target, layout, ["batch"])


def export_partitions(
    df: DataFrame, partition: Column, target: str, layout: Layout = Layout()
) -> None:
    """Write one directory per partition and leave the target's other partitions alone."""
    rows = arrange(df.withColumn("partition_id", partition), ["partition_id"], layout)
    write_parquet(rows, target, layout, ["partition_id"], mode="overwrite", dynamic=True)


def export_full(df: DataFrame, target: str, layout: Layout = Layout()) -> None:
    """Write a whole table. Input splits become files, so nothing is shuffled."""
    write_parquet(df, target, layout)


def export_sharded(
    df: DataFrame, key: str, shards: int, target: str, layout: Layout = Layout()
) -> None:
    """Write a table without partitions in hash shards of its key."""
    rows = df.withColumn("shard", hash_shard(F.col(key), shards))
    write_parquet(arrange(rows, ["shard"], layout), target, layout, ["shard"])


def full_dir(root: str, source: TableSource, stamp: str) -> str:
    """Directory of a full export: one per run time."""
    prefix = f"{root.rstrip('/')}/project={safe_name(source.project)}"
    return f"{prefix}/dataset={safe_name(source.dataset)}/table={safe_name(source.table)}/{stamp}"


def read_published(
    spark: SparkSession,
    root: str,
    dataset: str,
    table: str,
    version: int,
    current: DataFrame,
    schema: T.StructType | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Present rows of a table in one schema version, from published runs only.

    ``current`` has one row per partition with the run that exported it last. The join on
    run and partition leaves out unpublished runs and replaced partitions; dynamic pruning
    skips the directories of runs it does not name. ``schema`` is the one recorded for the
    version; without it, it is that of the files. ``only`` names the files to read, below
    the root.
    """
    path = f"{table_dir(root, dataset, table)}/schema_version=v{version}"
    layout = {"run", "batch"}
    if schema is None:
        schema = spark.read.parquet(path).schema
    own = [f for f in schema.fields if f.name not in {*layout, "partition_id"}]
    # Directory names are text whatever they look like.
    typed = with_text(T.StructType(own), "partition_id", *sorted(layout))
    paths = [path] if only is None else [f"{root}/{p}" for p in only]
    files = spark.read.schema(typed).option("basePath", path).parquet(*paths)
    keep = current.where(
        (F.col("dataset") == dataset)
        & (F.col("table") == table)
        & (F.col("schema_version") == version)
    ).select(F.col("run_id").alias("run"), "partition_id")
    rows = join_per_key(files, keep, ["run", "partition_id"], "left_semi")
    return rows.drop(*layout, "partition_id")
