"""Which partitions to export, and how far a table has come."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.operators.keyed import join_per_key

TABLE_KEY = ["dataset", "table"]
PARTITION_KEY = ["dataset", "table", "partition_id"]


def changed_since(parts: DataFrame, tables: DataFrame) -> DataFrame:
    """Partitions modified strictly after their table's watermark.

    A table without a watermark, or a partition without a modification time, is kept.
    ``tables`` has one row per table with ``watermark``.
    """
    marks = tables.select(*TABLE_KEY, F.col("watermark").alias("_mark"))
    joined = join_per_key(parts, marks, TABLE_KEY)
    keep = (
        F.col("_mark").isNull()
        | F.col("last_modified").isNull()
        | (F.col("last_modified") > F.col("_mark"))
    )
    return joined.where(keep).drop("_mark")


def skip_exported(
    parts: DataFrame, state: DataFrame, inventory: DataFrame | None = None
) -> DataFrame:
    """Drop partitions already exported in their present form.

    ``state`` has one row per partition with ``exported_modified`` and ``exported_path``.
    A partition without a change time cannot be known to be the same, and is kept. With an inventory, a state row counts only while its file is still there.
    """
    done = state.where(F.col("exported_path").isNotNull() & (F.col("exported_path") != ""))
    if inventory is not None:
        there = inventory.select(F.col("path").alias("exported_path"))
        done = done.join(there, "exported_path", "left_semi")
    done = done.select(*PARTITION_KEY, "exported_modified")
    joined = parts.join(done, PARTITION_KEY, "left")
    fresh = (
        F.col("exported_modified").isNull()
        | F.col("last_modified").isNull()
        | (F.col("last_modified") > F.col("exported_modified"))
    )
    return joined.where(fresh).drop("exported_modified")


def partition_lookup(parts: DataFrame, state: DataFrame) -> DataFrame:
    """Partitions with their stored state, or the defaults of a partition never seen."""
    known = state.select(*PARTITION_KEY, "schema_version", "exported_path")
    return parts.join(known, PARTITION_KEY, "left").withColumns(
        {
            "schema_version": F.coalesce("schema_version", F.lit(1)),
            "exported_path": F.coalesce("exported_path", F.lit("")),
        }
    )


def suppress_unchanged(parts: DataFrame, previous: DataFrame) -> DataFrame:
    """Drop partitions whose rows and content fingerprint equal the stored ones."""
    same = [*PARTITION_KEY, "row_count", "fingerprint"]
    return parts.join(previous.select(*same), same, "left_anti")


def changed_shards(found: DataFrame, state: DataFrame) -> DataFrame:
    """Hash shards to export: those whose rows or fingerprint differ from what is exported.

    A shard that was exported with rows and is not found any more comes with no rows, so
    that its rows can be retired. ``state`` has the latest row of each exported shard.
    """
    before = state.where(F.col("row_count") > 0).select(
        *PARTITION_KEY, F.col("row_count").alias("total_rows"), "fingerprint", "project"
    )
    same = [*PARTITION_KEY, "total_rows", "fingerprint"]
    changed = found.join(before.select(*same), same, "left_anti")
    gone = before.join(found.select(*PARTITION_KEY), PARTITION_KEY, "left_anti").select(
        "project", *PARTITION_KEY, F.lit(0).cast("bigint").alias("total_rows")
    )
    return changed.unionByName(gone, allowMissingColumns=True)


def mark_unchanged(parts: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``unchanged``: rows and logical bytes are those of the exported partition.

    A change time also moves when only metadata changed; such partitions need no new export.
    Partitions without logical bytes (nobody asked for them) count as changed.
    """
    known = state.select(
        *PARTITION_KEY, F.col("row_count").alias("_rows"), F.col("logical_bytes").alias("_bytes")
    )
    same = (F.col("total_rows") == F.col("_rows")) & (F.col("total_logical_bytes") == F.col("_bytes"))
    return (
        parts.join(known, PARTITION_KEY, "left")
        .withColumn("unchanged", F.coalesce(same, F.lit(False)))
        .drop("_rows", "_bytes")
    )


def advance_watermark(outcome: DataFrame) -> DataFrame:
    """New watermark by table from partition outcomes with ``committed`` and ``last_modified``.

    It is the newest change that was committed. If a partition failed, it stays below the
    oldest failed one, so that the next run finds it again. It never moves backwards when
    ``outcome`` carries the previous ``watermark``.
    """
    ok, failed = F.col("committed"), ~F.col("committed")
    reached = F.max(F.when(ok, F.col("last_modified")))
    missed = F.min(F.when(failed, F.col("last_modified")))
    # least and greatest pass over nulls: without a failure the first term stands alone.
    mark = F.when(reached.isNotNull(), F.least(reached, missed - F.expr("INTERVAL 1 MICROSECOND")))
    if "watermark" in outcome.columns:
        mark = F.greatest(F.max("watermark"), mark)
    return outcome.groupBy(*TABLE_KEY).agg(mark.alias("watermark"))


def is_late(last_modified: Column, snapshot: Column) -> Column:
    """Whether a partition changed after the snapshot it was read at."""
    return last_modified > snapshot


def late_partitions(parts: DataFrame, state: DataFrame) -> DataFrame:
    """Exported partitions that changed after their snapshot and must be exported again."""
    known = state.select(*PARTITION_KEY, "snapshot_time")
    return parts.join(known, PARTITION_KEY).where(is_late(F.col("last_modified"), F.col("snapshot_time")))


@dataclass(frozen=True)
class Rule:
    """Strategy of the tables whose ``dataset.table`` matches a pattern with ``*`` and ``?``.

    With ``skip_unchanged`` partitions with a new change time, but the same rows and logical
    bytes as exported, are not exported again; finding that out reads all their columns.
    With ``sized_files`` files are planned from bytes, which reads all columns as well: large
    partitions are cut where their clustering columns cut them evenly, small ones share files.
    """

    pattern: str
    strategy: str = "partition"
    batch_days: int = 7
    include: bool = True
    skip_unchanged: bool = False
    sized_files: bool = False

    def __post_init__(self) -> None:
        if self.strategy not in ("partition", "full_refresh"):
            raise ValueError(f"unknown strategy {self.strategy!r}")


def rule_for(name: str, rules: Sequence[Rule], default: Rule = Rule("*")) -> Rule:
    """The first rule that matches a ``dataset.table`` name."""
    return next((r for r in rules if re.fullmatch(_glob(r.pattern), name)), default)


def _glob(pattern: str) -> str:
    parts = [{"*": ".*", "?": "."}.get(ch, re.escape(ch)) for ch in pattern]
    return "^" + "".join(parts) + "$"


def apply_rules(tables: DataFrame, rules: Sequence[Rule], default: Rule = Rule("*")) -> DataFrame:
    """Add strategy and batch size by the first rule that matches; drop excluded tables.

    Rules are a short configured list, so they become one CASE and need no join.
    """
    name = F.concat_ws(".", "dataset", "table")

    def pick(value) -> Column:
        result = None
        for rule in rules:
            hit = name.rlike(_glob(rule.pattern))
            result = F.when(hit, value(rule)) if result is None else result.when(hit, value(rule))
        return value(default) if result is None else result.otherwise(value(default))

    return tables.where(pick(lambda r: F.lit(r.include))).withColumns(
        {
            "strategy": pick(lambda r: F.lit(r.strategy)),
            "batch_days": pick(lambda r: F.lit(r.batch_days)),
        }
    )
