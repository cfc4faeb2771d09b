"""Files skipped by bounds and filters: rows stay those of a full read, and files that cannot matter are not opened."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from floodmark.operators import zonemaps
from floodmark.operators.zonemaps import Need
from floodmark.plans.sync import Lake
from floodmark.sources.tables import TableSource

DAYS = 6


def _rows(spark, n=600, extra=None):
    day = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(cast(id % 6 as int))")
    df = spark.range(n).select(
        day.alias("ts"),
        (F.col("id") * 7919 % 100_003 + F.lit(2**60)).alias("key"),
        F.when(F.col("id") % 6 == 2, None).otherwise(F.concat(F.lit("x" * 70), F.col("id").cast("string"))).alias("t"),
        (F.col("id") % 6 + F.lit(0.5)).cast("decimal(12,3)").alias("d"),
        F.when(F.col("id") % 6 == 5, float("nan")).otherwise(F.col("id") % 6).cast("double").alias("v"),
    )
    return df.withColumns(extra) if extra else df


def _same(lake, source, *needs):
    """Rows equal those of a filtered full read; gives the number of files opened."""
    full = lake.read(source)
    for need in needs:
        full = full.where(need.matches(full.schema[need.column].dataType))
    got = lake.read_where(source, *needs)
    assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))
    return lake.files_for(source, *needs).count()


def test_bounds_and_filters(spark, tmp_path):
    root = str(tmp_path)
    _rows(spark).repartition(DAYS, "ts").withColumn("day", F.col("ts").cast("date")).write.partitionBy("day").parquet(f"{root}/x")
    rows = spark.read.parquet(f"{root}/x").drop("day")
    found = zonemaps.bounds(rows, root, ["v", "d", "ts", "t", "key"], ["key", "t"]).cache()
    pages = zonemaps.filters(rows, found, "key").unionByName(zonemaps.filters(rows, found, "t")).cache()
    paths = found.select("path").distinct().cache()

    def left(need):
        """Files left, which hold all rows that match."""
        dtype = rows.schema[need.column].dataType
        kept = {r[0] for r in zonemaps.prune(paths, found, pages, need, dtype).collect()}
        held = rows.where(need.matches(dtype)).select("_metadata.file_path").distinct().collect()
        assert {r[0].split(f"{root}/")[1] for r in held} <= kept
        return len(kept)

    assert paths.count() == DAYS
    assert left(Need("v", low=1, high=2)) == 2
    assert left(Need("v", low=4)) == 2  # NaN is above all numbers
    assert left(Need("v", values=(float("nan"),))) == 1
    assert left(Need("d", high="1.500")) == 2
    assert left(Need("ts", low=dt.datetime(2024, 1, 3), high=dt.datetime(2024, 1, 4))) == 2
    assert left(Need("t", low="")) == DAYS - 1  # a file of nulls holds nothing a comparison wants
    assert 1 <= left(Need("key", values=(2**60 + 7919,))) <= 2  # all files have these bounds, one the value
    assert left(Need("key", values=(2**60 + 1, None))) <= 1
    assert 1 <= left(Need("t", values=("x" * 70 + "13",))) <= 2  # texts differ after the part that bounds keep
    assert left(Need("key", values=())) == 0
    with pytest.raises(ValueError):
        Need("v")
    for df in (found, pages, paths):
        df.unpersist()


def test_only_new_files_are_mapped(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    first = TableSource("a", "b", _rows(spark, 300), "ts", "changed")
    first = TableSource("a", "b", first.frame.withColumn("changed", F.col("ts")), "ts", "changed")
    lake.sync([first], "r1", "2024-02-01 00:00:00", days=1)
    lake.map_zones(first, ["v"])
    # Day 0 is exported again with other values and a wider schema; its old file is no longer listed.
    newer = F.when(F.col("ts") == F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz")).otherwise(F.col("ts"))
    moved = _rows(spark, 300, {"v": F.col("v") + F.when(F.col("v") == 0, 50).otherwise(0), "more": F.lit("m")})
    second = TableSource("a", "b", moved.withColumn("changed", newer), "ts", "changed")
    lake.sync([second], "r2", "2024-02-02 00:00:00", days=1)
    assert _same(lake, second, Need("v", low=40, high=60)) == 1  # the new file, which is not mapped; that of NaN alone is above
    lake.map_zones(second, ["v", "more"], filtered=["more"])
    assert _same(lake, second, Need("v", low=-1, high=0)) == 0
    assert _same(lake, second, Need("v", low=40, high=60), Need("more", values=("m",))) == 1
    with pytest.raises(ValueError):
        lake.files_for(second, Need("none", low=1))
    before = lake._zones(second)[0].count()
    lake.map_zones(second, ["v", "more"], filtered=["more"])
    assert lake._zones(second)[0].count() == before


def test_filter_errs_one_way(spark, tmp_path):
    """A filter of many pages holds each value put in, and few others."""
    root = str(tmp_path)
    spark.range(40_000).select((F.col("id") * 3).alias("k")).coalesce(1).write.parquet(f"{root}/x")
    rows = spark.read.parquet(f"{root}/x")
    found = zonemaps.bounds(rows, root, ["k"], ["k"])
    assert found.first()["pages"] == 5
    pages = zonemaps.filters(rows, found, "k").cache()
    paths = found.select("path").cache()
    dtype = rows.schema["k"].dataType
    for v in (0, 3, 59_997, 119_997):
        assert zonemaps.prune(paths, found, pages, Need("k", values=(v,)), dtype).count() == 1
    wrong = sum(zonemaps.prune(paths, found, pages, Need("k", values=(v,)), dtype).count() for v in range(1, 119_000, 9_001) if v % 3)
    assert wrong <= 2
    pages.unpersist()
    paths.unpersist()
