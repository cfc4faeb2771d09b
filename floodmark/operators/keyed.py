"""Joins, latest-row views and ordered counts that hold up when one key owns most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_HASH = "_key_hash"


def join_per_key(many: DataFrame, one: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``many`` rows per key with at most ``one`` row per key.

    A plain equality join without a hint. The side with one row per key is broadcast only
    when Spark has measured it below the session's threshold; otherwise both sides are
    shuffled and AQE cuts the partition of a hot key by measured bytes into as many tasks
    as it needs, each of which meets the key's one row.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} cannot be split on the left side")
    return many.join(one, list(on), how)


def with_key_hash(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The frame with a hash of its key columns, ``KEY_HASH``, to be joined on before the columns themselves.

    Sort-merge joins sort by their first column first: eight bytes that differ between keys
    settle nearly all comparisons, where names that begin alike settle none.
    """
    return df.withColumn(KEY_HASH, F.xxhash64(*on))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key in the given order.

    ``max_by`` keeps one row per key and task before the shuffle, so a hot key sends
    only a few rows. Give enough order columns to settle ties.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), rank).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order; see :func:`latest_per_key`."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), rank).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def count_changes(
    df: DataFrame, keys: Sequence[str], order: str, value: str, bucket: Column, out: str
) -> DataFrame:
    """Number the runs of equal ``value`` along ``order`` within each key, from 1.

    A window over the key alone would sort a hot key in one task. Rows are numbered
    inside ``(key, bucket)`` first; only one summary row per bucket then goes through a
    window over the key, and its offset is joined back. ``bucket`` must not decrease
    along ``order``, and ``order`` must be unique within a key. The result also has
    ``is_change``: true on the first row of each run.
    """
    cells = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.row_number().over(inside) == 1
    numbered = cells.withColumn(
        "_turn", ~first & ~F.col(value).eqNullSafe(F.lag(value).over(inside))
    ).withColumns(
        {
            "_opens": first,
            "_inner": F.sum(F.col("_turn").cast("bigint")).over(so_far),
        }
    )
    summary = numbered.groupBy(*keys, "_bucket").agg(
        F.min_by(F.struct(F.col(value).alias("v")), order)["v"].alias("_head"),
        F.max_by(F.struct(F.col(value).alias("v")), order)["v"].alias("_tail"),
        F.max("_inner").alias("_turns"),
    )
    over_key = Window.partitionBy(*keys).orderBy("_bucket")
    before = over_key.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        summary.withColumn(
            "_seam",
            (F.row_number().over(over_key) == 1)
            | ~F.col("_head").eqNullSafe(F.lag("_tail").over(over_key)),
        )
        .withColumn(
            "_offset",
            F.coalesce(F.sum(F.col("_turns") + F.col("_seam").cast("bigint")).over(before), F.lit(0))
            + F.col("_seam").cast("bigint"),
        )
        .select(*keys, "_bucket", "_offset", "_seam")
    )
    return numbered.join(offsets, [*keys, "_bucket"]).select(
        *df.columns,
        (F.col("_offset") + F.col("_inner")).alias(out),
        F.when(F.col("_opens"), F.col("_seam")).otherwise(F.col("_turn")).alias("is_change"),
    )
