"""Sketches of partitions: what they estimate, and which rows are read for them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from floodmark.operators import sketches
from floodmark.plans.sync import Lake
from floodmark.sources.tables import TableSource


def test_odd_values(spark):
    """Nulls, NaN, both zeros, empty groups of values and an empty table."""
    nan = float("nan")
    rows = [("a", 0.0, "x"), ("a", -0.0, None), ("a", nan, ""), ("a", nan, ""), ("b", None, None), ("c", 5.0, "x")]
    df = spark.createDataFrame(rows, "g string, v double, `t` string")
    built = sketches.build(df, ["g"], ["v", "t"])
    counts = {(r["g"], r["column"]): (r["row_count"], r["nulls"], r["n_distinct"]) for r in sketches.distinct_counts(built, ["g"]).collect()}
    assert counts == {
        ("a", "v"): (4, 0, 2), ("a", "t"): (4, 1, 2), ("b", "v"): (1, 1, 0),
        ("b", "t"): (1, 1, 0), ("c", "v"): (1, 0, 1), ("c", "t"): (1, 0, 1),
    }
    found = {(r["g"], r["fraction"]): (r["n"], r["value"]) for r in sketches.quantiles(built, ["g"], [0.0, 1.0]).collect()}
    assert found == {("a", 0.0): (2, 0.0), ("a", 1.0): (2, 0.0), ("c", 0.0): (1, 5.0), ("c", 1.0): (1, 5.0)}
    assert sketches.distinct_counts(sketches.build(df.limit(0), ["g"], ["v"]), ["g"]).count() == 0
    with pytest.raises(ValueError):
        sketches.build(df.select("g", F.array("v").alias("v")), ["g"], ["v"])


def test_union_is_within_its_error(spark):
    """Values shared by groups count once; a third of the rows are one value."""
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("g"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20_000).alias("v")
    )
    built = sketches.build(df, ["g"], ["v"])
    exact = df.agg(F.countDistinct("v")).first()[0]
    got = sketches.distinct_counts(built, []).first()
    assert got["row_count"] == 60_000 and abs(got["n_distinct"] - exact) <= 4 * sketches.DISTINCT_ERROR * exact
    for r in sketches.quantiles(built, [], [0.2, 0.5, 0.95]).collect():
        below, upto = df.agg(F.count_if(F.col("v") < r["value"]), F.count_if(F.col("v") <= r["value"])).first()
        slack = 2 * sketches.RANK_ERROR
        assert below / 60_000 <= r["fraction"] + slack and upto / 60_000 >= r["fraction"] - slack


def test_only_new_exports_are_sketched(spark, tmp_path):
    def source(rows):
        df = spark.createDataFrame(rows, "v bigint, ts timestamp_ntz, changed timestamp_ntz")
        return TableSource("d", "t", df, "ts", "changed")

    rows = [(i % 5, dt.datetime(2025, 1, d), dt.datetime(2025, 1, d)) for d in (1, 2, 3) for i in range(10)]
    lake = Lake(spark, str(tmp_path))
    assert lake.sketches(source(rows)).count() == 0
    lake.sync([source(rows)], "r1", "2025-02-01")
    lake.sketch(source(rows), ["v"])
    rows = [r for r in rows if r[1].day != 2] + [(100 + i, dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 9)) for i in range(4)]
    lake.sync([source(rows)], "r2", "2025-02-02")
    assert {r["partition_id"] for r in lake.sketches(source(rows)).collect()} == {"20250101", "20250103"}
    for _ in range(2):  # the second call finds nothing to do
        lake.sketch(source(rows), ["v"])
    every = spark.read.parquet(f"{tmp_path}/sketches/d/t")
    assert sorted((r["run_id"], r["partition_id"], r["row_count"]) for r in every.collect()) == [
        ("r1", "20250101", 10), ("r1", "20250102", 10), ("r1", "20250103", 10), ("r2", "20250102", 4)
    ]
    assert sketches.distinct_counts(lake.sketches(source(rows)), []).first()["n_distinct"] == 9
