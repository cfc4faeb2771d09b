"""Files planned from bytes: bounds, packing, cuts, and the runs that follow the plan."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from floodmark.functions import hashing
from floodmark.operators import filesizes
from floodmark.operators.incremental import Rule
from floodmark.plans import export
from floodmark.plans.sync import Lake
from floodmark.sources.tables import TableSource


def plain_first_fit(sizes, room):
    free, bins = [], []
    for size in sizes:
        at = next((i for i, f in enumerate(free) if f >= size), len(free))
        if at == len(free):
            free.append(room)
        free[at] -= size
        bins.append(at)
    return bins


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.integers(0, 130), max_size=20), min_size=1, max_size=5))
def test_first_fit_is_the_plain_one(spark, lists):
    rows = [(k, [(x,) for x in xs]) for k, xs in enumerate(lists)]
    df = spark.createDataFrame(rows, "k int, items array<struct<size:bigint>>")
    got = {r["k"]: r["bins"] for r in df.select("k", filesizes.first_fit(F.col("items"), 100).alias("bins")).collect()}
    assert got == {k: plain_first_fit(xs, 100) for k, xs in enumerate(lists)}


def plan(spark, rows, **sizes):
    df = spark.createDataFrame([("d", t, b, p, n) for t, b, p, n in rows], "dataset string, `table` string, batch string, partition_id string, n bigint")
    return filesizes.plan_files(df, F.col("n"), **{"target": 100, "smallest": 10, "largest": 1000, **sizes})


def test_numbers_have_no_gaps_and_batches_share_no_file(spark):
    rows = [(t, f"b{b}", f"p{b}{p:03}", (p * 37 + b) % 260 if p else 1001) for t in "xy" for b in range(3) for p in range(40)]
    rows += [("x", "b3", "nulls", None), ("x", "b4", "empty", 0), ("x", "b4", "less", -5)]
    got = plan(spark, rows).collect()
    assert len(got) == len(rows)
    for t in "xy":
        files = {}
        for r in got:
            if r["table"] == t:
                assert r["pieces"] == max(1, -(-(r["n"] or 0) // 100))
                for k in range(r["pieces"]):
                    files.setdefault(r["first_file"] + k, []).append(r)
        assert sorted(files) == list(range(len(files)))
        for held in files.values():
            assert len({r["batch"] for r in held}) == 1
            assert len(held) == 1 or sum(r["n"] or 0 for r in held) <= 100
    assert plan(spark, []).count() == 0


def test_packing_beyond_one_group(spark, monkeypatch):
    monkeypatch.setattr(filesizes, "PACKED_TOGETHER", 8)
    got = plan(spark, [("x", "b", f"p{k:02}", 25) for k in range(30)]).collect()
    held = {}
    for r in got:
        held.setdefault(r["first_file"], []).append(r["partition_id"])
    assert sorted(held) == list(range(8)) and max(map(len, held.values())) == 4


def test_target_is_kept_within_the_bounds(spark):
    assert [r["pieces"] for r in plan(spark, [("x", "b", "p", 95)], target=1).collect()] == [10]
    assert [r["pieces"] for r in plan(spark, [("x", "b", "p", 5000)], target=10**9).collect()] == [5]


@pytest.mark.parametrize("by", [(), ("k", "v")])
def test_pieces_are_even_and_ranges_of_the_clustering(spark, tmp_path, by):
    """A third of the rows share one clustering value, some are null: pieces stay even."""
    n = 6000
    frame = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") * 7919 % 1000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.array(F.struct(F.col("id").alias("x"))).alias("m"),
        F.when(F.col("id") >= 5400, F.lit("2025-01-02")).otherwise("2025-01-01").cast("timestamp_ntz").alias("ts"),
    )
    source = TableSource("d", "t", frame, "ts", cluster_by=by)
    layout = export.Layout(target_bytes=40_000, smallest_bytes=1000)
    lake = Lake(spark, str(tmp_path), layout)
    lake.sync([source], "r1", "2025-02-01", rules=[Rule("*", sized_files=True)])
    planned = {r["partition_id"]: r for r in spark.read.parquet(f"{tmp_path}/runs/r1/plan").collect()}
    rows = planned["20250101"]["total_rows"]
    pieces = planned["20250101"]["pieces"]
    assert pieces >= 4 and planned["20250102"]["pieces"] == 1
    found = [r for r in lake.written_files().collect() if r["partition_id"] == "20250101"]
    assert len(found) == pieces
    for r in found:
        assert 0.75 * rows / pieces < r["row_count"] < 1.25 * rows / pieces
    assert sorted(r[0] for r in lake.read(source).select("v").collect()) == sorted(r[0] for r in frame.select("v").collect())
    if by:
        read = spark.read.parquet(*[f"{tmp_path}/{r['path']}" for r in found])
        spans = read.groupBy(F.input_file_name()).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo", "hi").collect()
        for a, b in zip(spans, spans[1:]):
            assert a["hi"] <= b["lo"]


def test_alike_rows_are_cut_by_rows(spark, tmp_path):
    frame = spark.range(4000).select(F.lit(1).alias("k"), F.lit("same text").alias("v"))
    layout = export.Layout(target_bytes=4000, smallest_bytes=1000, largest_bytes=8000)
    lake = Lake(spark, str(tmp_path), layout)
    source = TableSource("d", "t", frame, cluster_by=("k",))
    lake.sync([source], "r1", "2025-02-01", rules=[Rule("*", sized_files=True)])
    found = [r["row_count"] for r in lake.written_files().collect()]
    assert sum(found) == 4000 and len(found) > 1 and max(found) <= 8000 * 3 / 18


def test_later_runs_use_what_files_took(spark, tmp_path):
    """Shards, a whole table, an empty one and an unsized one in one run; the ratio of run 1 plans run 2."""
    ids = spark.range(2000)
    text = F.repeat(F.lit("abc"), 30).alias("v")
    sources = [
        TableSource("d", "shards", ids.select("id", text), shard_on="id", shards=8),
        TableSource("d", "whole", ids.select("id", text)),
        TableSource("d", "empty", ids.select("id").where("id < 0").withColumn("ts", F.lit(dt.datetime(2025, 1, 1))), "ts"),
        TableSource("d", "plain", ids.select("id")),
    ]
    rules = [Rule("d.plain"), Rule("*", sized_files=True)]
    lake = Lake(spark, str(tmp_path), export.Layout(target_bytes=20_000, smallest_bytes=1000))
    result = lake.sync(sources, "r1", "2025-02-01", rules=rules)
    assert result.state == "completed", result
    ratios = {r["table"]: r["ratio"] for r in lake.stored_ratio().collect()}
    assert ratios.keys() == {"shards", "whole"} and all(0 < r < 1 / 3 for r in ratios.values())
    later = [sources[0].__class__("d", "shards", ids.select("id", F.repeat(F.lit("abd"), 30).alias("v")), shard_on="id", shards=8), *sources[1:]]
    assert lake.sync(later, "r2", "2025-02-02", rules=rules).state == "completed"
    for source in later:
        assert tuple(lake.read(source).agg(*hashing.fingerprint_aggregates(source.frame)).first()) == tuple(
            source.frame.agg(*hashing.fingerprint_aggregates(source.frame)).first()
        )
    first, second = (
        spark.read.parquet(f"{tmp_path}/runs/{r}/plan").where("table = 'shards'").agg(F.max("first_file")).first()[0] for r in ("r1", "r2")
    )
    assert second < first  # the texts compress better than the default takes for granted


def test_pieces_are_found_by_compiled_steps(spark, tmp_path):
    """Rows only point to their partition's cuts: no step leaves the compiled loop, which would copy them."""
    lists = {0: None, 1: [], 2: [4], 3: [1, 3, 3, 8], 4: list(range(0, 60, 2))}
    rows = [(n, k) for n in lists for k in (None, -1, 0, 1, 3, 4, 8, 57, 58, 99)]
    cuts = [(n, [(c,) for c in cs] if cs is not None else None) for n, cs in lists.items()]
    spark.createDataFrame(rows, "n int, k int").write.parquet(f"{tmp_path}/rows")
    spark.createDataFrame(cuts, "n int, cuts array<struct<k0: int>>").write.parquet(f"{tmp_path}/cuts")
    joined = spark.read.parquet(f"{tmp_path}/rows").join(spark.read.parquet(f"{tmp_path}/cuts"), "n", "left")
    found = export.with_piece(joined, F.struct(F.col("k").alias("k0")), 30, "piece")
    for n, k, piece in found.select("n", "k", "piece").collect():
        assert piece == (0 if k is None else sum(c <= k for c in lists[n] or [])), (n, k)
    final = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrayAggregate" not in final and "lambda" not in final
    spark.createDataFrame([], joined.schema).write.parquet(f"{tmp_path}/joined")
    plain = export.with_piece(spark.read.parquet(f"{tmp_path}/joined"), F.struct(F.col("k").alias("k0")), 30, "piece")
    steps = [s for s in plain._jdf.queryExecution().executedPlan().toString().split("\n") if "Project" in s]
    assert len(steps) >= 5 and all("*(" in s for s in steps), steps
