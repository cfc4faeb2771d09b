"""Ledgers whose present state is written once, so that reads of it do not grow with history."""

import random

import pytest
from pyspark.sql import functions as F

from floodmark.operators.ledger import COMPACTED, Ledgers
from floodmark.plans.sync import Lake
from floodmark.sources.tables import TableSource


class Killed(BaseException):
    pass


def rows(df):
    return sorted(map(str, df.collect()))


def fill(ledgers, spark, run, chance):
    """What a run appends; some runs fail, die or go on later."""
    at = f"2025-01-{run:02} 00:00:00"
    run_id = f"r{run:02}"
    parts = [
        ("d", "t", f"p{k}", chance.choice(["completed", "completed", "failed"]), run * 100 + k)
        for k in range(6) if chance.random() < 0.5
    ]
    df = spark.createDataFrame(parts, "dataset string, `table` string, partition_id string, state string, row_count bigint")
    stamp = {"run_id": F.lit(run_id), "at": F.lit(at).cast("timestamp_ntz")}
    ledgers.append("partitions", df.withColumns(stamp))
    ledgers.append("tables", spark.createDataFrame([("d", chance.choice("tu"), run)], "dataset string, `table` string, schema_version int").withColumns(stamp))
    ledgers.append_run(run_id, "running", at, at)
    state = chance.choice(["completed", "partial", "failed", None])
    if state:
        ledgers.append_run(run_id, state, at, at)
    return run_id if state in (None, "failed") else None


def test_state_is_that_of_the_whole_history(spark, tmp_path):
    """The same appends with and without compactions, one of which dies, give the same state at each point."""
    plain, packed = Ledgers(spark, str(tmp_path / "a")), Ledgers(spark, str(tmp_path / "b"))
    assert packed.generation() == 0
    going = []
    for run in range(1, 7):
        assert fill(plain, spark, run, random.Random(run)) == (left := fill(packed, spark, run, random.Random(run)))
        going += [left] if left else []
        if run == 2:
            seal, packed._seal = packed._seal, lambda generation: (_ for _ in ()).throw(Killed)
            with pytest.raises(Killed):
                packed.compact()
            packed._seal = seal
            assert packed.generation() == 0
        if run in (3, 5):
            assert packed.compact() == packed.generation() == (1 if run == 3 else 2)
    for one in going:  # runs that were open or failed when their rows were compacted
        for ledgers in (plain, packed):
            ledgers.append_run(one, "completed", "2025-02-01 00:00:00", "2025-01-01 00:00:00")
    assert going
    for name in COMPACTED:
        assert rows(packed.latest(name)) == rows(plain.latest(name)), name
        assert rows(packed.read(name)) == rows(plain.read(name)), name
    assert rows(packed.committed("partitions")) == rows(plain.committed("partitions"))
    assert packed.live("partitions").count() < packed.read("partitions").count()


def test_runs_compact_by_themselves_and_read_no_old_file(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), compact_every=2)
    def source(n):
        return TableSource("d", "t", spark.range(n), shard_on="id", shards=2)

    for k in range(1, 4):
        assert lake.sync([source(10 * k)], f"r{k}", f"2025-02-0{k}").state == "completed"
    assert lake.ledgers.generation() == 1 and lake.ledgers.closed_since() == 1
    read = lake.ledgers.latest("partitions").inputFiles()
    assert read and all("/generation-1/" in f for f in read)
    assert lake.read(source(30)).count() == 30
    assert lake.manifest().agg(F.sum("row_count")).first()[0] == 30
    with pytest.raises(ValueError):  # closed in the base
        lake.sync([source(30)], "r1", "2025-02-09")
