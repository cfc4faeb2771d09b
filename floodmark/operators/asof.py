"""Reads as of a past time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.operators.keyed import latest_per_key


def snapshot_as_of(
    changes: DataFrame, keys: Sequence[str], ts: str, at: Column, ties: Sequence[str] = ()
) -> DataFrame:
    """State of each key at a time, from a log of changes."""
    return latest_per_key(changes.where(F.col(ts) <= at), keys, [ts, *ties])


def exports_as_of(manifest: DataFrame, at: Column) -> DataFrame:
    """Files that readers saw at a time."""
    return manifest.where(F.col("exported_at") <= at)
