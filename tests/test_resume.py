"""Runs that die and go on, and tables of which a part changes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from floodmark.functions import hashing
from floodmark.operators.incremental import Rule
from floodmark.plans.sync import Lake
from floodmark.sources.tables import TableSource

TS = "timestamp_ntz"


class Killed(BaseException):
    pass


def times(spark, name="events", changed=0):
    rows = [(d * 100 + i, dt.datetime(2025, 1, d, i), dt.datetime(2025, 1, d + changed)) for d in range(1, 5) for i in range(10)]
    return TableSource("shop", name, spark.createDataFrame(rows, f"id bigint, ts {TS}, changed {TS}"), "ts", "changed")


def shards(spark, rows, n=4):
    return TableSource("shop", "users", spark.createDataFrame(rows, "id bigint, v string"), shard_on="id", shards=n)


def contents(df):
    return tuple(df.agg(*hashing.fingerprint_aggregates(df)).first())


def die(*_, **__):
    raise Killed


@pytest.mark.parametrize("stage", ["_plan", "_count_written", "partitions", "_record_tables"])
def test_a_killed_run_goes_on(spark, tmp_path, stage):
    sources = [times(spark), shards(spark, [(k, f"v{k}") for k in range(40)])]
    lake = Lake(spark, str(tmp_path))
    if stage == "partitions":  # the manifest is written then, the ledger not
        append = lake.ledgers.append
        lake.ledgers.append = lambda name, rows: die() if name == stage else append(name, rows)
    else:
        setattr(lake, stage, die)
    with pytest.raises(Killed):
        lake.sync(sources, "r1", "2025-02-01")
    lake = Lake(spark, str(tmp_path))
    assert lake.read(sources[0]).count() == 0  # nothing of it is published
    noted = {(r.name, r.step) for r in lake.unfinished().collect()}
    assert (("shop.users", "written") in noted) == (stage != "_plan")
    calls, write = [], lake._write
    lake._write = lambda source, *rest: calls.append(source.name) or write(source, *rest)
    result = lake.sync(sources, "r1", "2025-02-01")
    assert (result.state, result.tables) == ("completed", 2)
    assert sorted(calls) == (["shop.events", "shop.users"] if stage == "_plan" else [])
    assert lake.unfinished().count() == 0
    for source in sources:
        assert contents(lake.read(source)) == contents(source.frame)
    assert {(r.table, r.n) for r in lake.manifest().groupBy("table").agg(F.sum("row_count").alias("n")).collect()} == {("events", 40), ("users", 40)}
    for name, keys in (("partitions", ["table", "partition_id"]), ("versions", ["table", "version"]), ("tables", ["table"]), ("fields", ["table", "path"])):
        rows = lake.ledgers.read(name)
        assert rows.count() == rows.select(*keys).distinct().count(), name
    with pytest.raises(ValueError):  # it is closed now
        lake.sync(sources, "r1", "2025-02-02")


def test_a_failed_run_goes_on_later_with_the_same_tables(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    broken = times(spark)
    broken = TableSource("shop", "events", broken.frame.withColumn("id", F.when(F.col("id") == 205, F.raise_error(F.lit("gone"))).otherwise(F.col("id"))), "ts", "changed")
    assert lake.sync([broken], "r1", "2025-02-01").state == "failed"
    with pytest.raises(ValueError):  # not at the time at which it was closed
        lake.sync([times(spark)], "r1", "2025-02-01")
    with pytest.raises(ValueError):  # a table of the plan is missing
        lake.sync([times(spark, "other")], "r1", "2025-02-02")
    assert lake.sync([times(spark), times(spark, "other")], "r1", "2025-02-03").tables == 1
    assert contents(lake.read(times(spark))) == contents(times(spark).frame)


def test_only_changed_shards_are_written(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = [(k, f"v{k}") for k in range(200)] + [(None, "none")] * 3 + [(7, "v7")] * 100
    lake.sync([shards(spark, rows)], "r1", "2025-02-01")
    state = lambda: {r.partition_id: (r.run_id, r.row_count) for r in lake.ledgers.latest("partitions").collect()}
    first = state()
    assert len(first) == 4 and sum(n for _, n in first.values()) == len(rows)
    assert lake.sync([shards(spark, list(reversed(rows)))], "r2", "2025-02-02").tables == 0  # another order only
    assert state() == first
    edited = [(k, "new" if k == 5 else v) for k, v in rows]
    lake.sync([shards(spark, edited)], "r3", "2025-02-03")
    assert sorted(r for r, _ in state().values()) == ["r1", "r1", "r1", "r3"]
    assert contents(lake.read(shards(spark, edited))) == contents(shards(spark, edited).frame)
    fewer = shards(spark, [(k, v) for k, v in edited if k == 7])  # all other shards are empty now
    lake.sync([fewer], "r4", "2025-02-04")
    assert contents(lake.read(fewer)) == contents(fewer.frame)
    assert sorted(n for _, n in state().values())[:3] == [0, 0, 0]
    refused = lake.sync([TableSource("shop", "users", fewer.frame)], "r5", "2025-02-05")
    assert refused.state == "failed"
    assert contents(lake.read(fewer)) == contents(fewer.frame)


def test_partitions_with_the_same_rows_and_bytes_are_not_written_again(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rule = [Rule("*", skip_unchanged=True)]
    lake.sync([times(spark)], "r1", "2025-02-01", rules=rule)
    later = times(spark, changed=20)  # new change times, the same rows and bytes
    assert lake.sync([later], "r2", "2025-02-02", rules=rule).tables == 0
    longer = TableSource("shop", "events", later.frame.unionAll(later.frame.where("id = 205")).withColumn("changed", F.col("changed") + F.expr("INTERVAL 30 DAYS")), "ts", "changed")
    lake.sync([longer], "r3", "2025-02-03", rules=rule)
    assert {r.partition_id: r.run_id for r in lake.ledgers.latest("partitions").collect()} == {"20250101": "r1", "20250102": "r3", "20250103": "r1", "20250104": "r1"}


def test_types_are_stored_as_files_hold_them(spark, tmp_path):
    frame = spark.sql("select id, interval '3' day as d, cast(id as decimal(38, 12)) as n from range(5)")
    lake = Lake(spark, str(tmp_path), big_decimals="string")
    source = TableSource("shop", "odd", frame)
    assert lake.sync([source], "r1", "2025-02-01").state == "completed"
    assert dict(lake.read(source).dtypes) == {"id": "bigint", "d": "struct<months:int,days:int,micros:bigint>", "n": "string"}
    assert {r.d.days for r in lake.read(source).collect()} == {3}


def test_a_source_is_cut_one_way_only(spark):
    with pytest.raises(ValueError):
        TableSource("a", "b", spark.range(1), partition_on="id", shard_on="id")
    with pytest.raises(ValueError):
        TableSource("a", "b", spark.range(1), shard_on="id", shards=0)
