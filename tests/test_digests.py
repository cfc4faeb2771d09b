"""Comparison of two sides of a table by a tree of fingerprints."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from floodmark.operators import verify
from floodmark.plans import digests
from floodmark.sources.tables import TableSource

COLUMNS = ["v"]


def side(spark, path, edits=(), lost=(), extra=()):
    rows = [(d * 1000 + i, dt.datetime(2025, 1, d, i % 24), f"v{i}") for d in range(1, 11) for i in range(200)]
    rows = [(k, t, "edited" if k in edits else v) for k, t, v in rows if k not in lost] + list(extra)
    spark.createDataFrame(rows, "id bigint, ts timestamp_ntz, v string").sort("ts").coalesce(1).write.option("parquet.block.row.count.limit", 200).parquet(path)
    return TableSource("shop", "events", spark.read.parquet(path), "ts")


def test_finds_what_a_full_comparison_finds_and_reads_little(spark, tmp_path):
    one = side(spark, f"{tmp_path}/one")
    moved = [(5000, dt.datetime(2025, 1, 9, 1), "v0"), (None, None, "new"), (-1, dt.datetime(2025, 2, 1), "v")]
    other = side(spark, f"{tmp_path}/other", edits={3005, 3006}, lost={4007, 5000}, extra=moved)
    trees = digests.leaves(one, "id", COLUMNS, 16), digests.leaves(other, "id", COLUMNS, 16)
    nodes = digests.differing(*trees)
    assert {r.partition_id for r in nodes.collect()} == {"20250103", "20250104", "20250105", "20250109", "20250201", "__NULL__"}
    assert nodes.count() <= 7
    got = {tuple(r) for r in digests.value_diff(one, other, "id", COLUMNS, 16, trees).collect()}
    assert got == {tuple(r) for r in verify.value_diff(one.frame, other.frame, "id", COLUMNS).collect()} | {
        r for r in got if r[0] == 5000  # a row that moved to another day has equal values
    }
    assert {(3005, "changed", "v"), (4007, "missing", ""), (-1, "extra", ""), (None, "extra", "")} <= got
    # Only rows of buckets that differ are compared: some 200 / 16 of each of those days.
    rows = digests.rows_of(one, "id", nodes, 16)
    seen = Observation("rows")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert 0 < seen.get["n"] <= 200
    # The scan reads the row groups of those days alone.
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or" in plan or "GreaterThanOrEqual(ts" in plan


def test_equal_sides_and_empty_sides(spark, tmp_path):
    one = side(spark, f"{tmp_path}/one")
    again = TableSource("shop", "events", one.frame.orderBy(F.desc("id")), "ts")
    assert digests.value_diff(one, again, "id", COLUMNS, 8).count() == 0
    none = TableSource("shop", "events", one.frame.limit(0), "ts")
    assert digests.value_diff(none, none, "id", COLUMNS, 8).count() == 0
    lost = digests.value_diff(one, none, "id", COLUMNS, 8)
    assert lost.count() == 2000 and {r.status for r in lost.select("status").distinct().collect()} == {"missing"}


def test_levels_are_sums_of_the_leaves(spark, tmp_path):
    one = side(spark, f"{tmp_path}/one")
    leaf = digests.leaves(one, "id", COLUMNS, 8)
    assert leaf.count() == 80
    whole = verify.fingerprint_by(one.frame, F.lit("all"), ["id", *COLUMNS]).first()
    assert tuple(digests.level(leaf).first()) == (whole["row_count"], whole["fingerprint"])
