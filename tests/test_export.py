"""Writing, publishing, reading back, and whole runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from floodmark.functions import hashing
from floodmark.operators import incremental, registry
from floodmark.plans import export
from floodmark.plans.sync import Lake
from floodmark.sources import files
from floodmark.sources.tables import TableSource
from floodmark.streaming import export as streaming

TS = "timestamp_ntz"


def table(spark, days=range(1, 21), bump=(), extra=0):
    """A hundred rows a day; bumped days look modified later and may have more rows."""
    rows = []
    for d in days:
        for i in range(100 + (extra if d in bump else 0)):
            at = dt.datetime(2025, 1, d, i % 24)
            rows.append((d * 1000 + i, at, at + dt.timedelta(days=100 if d in bump else 0), f"v{i}"))
    return spark.createDataFrame(rows, f"id bigint, ts {TS}, changed {TS}, v string")


def source(df, **options):
    return TableSource("shop", "events", df, "ts", "changed", **options)


def fingerprint(df):
    return tuple(df.agg(*hashing.fingerprint_aggregates(df)).first())


def runs_of(lake):
    return {r["partition_id"]: r["run_id"] for r in lake.ledgers.latest("partitions").collect()}


def test_write_and_count(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit("n"), "id").alias("name"))
    for codec in ("zstd", "snappy"):
        path = str(tmp_path / codec)
        assert export.write_counted(df, path, f"w{codec}", layout=export.Layout(codec=codec)) == 100
        assert fingerprint(spark.read.parquet(path)) == fingerprint(df)
        assert files.inventory(spark, path).where(F.contains("path", F.lit(codec))).count() > 0
    with pytest.raises(ValueError):
        export.Layout(codec="lzo")


def test_file_counts(spark):
    mib = export.MIB
    df = spark.createDataFrame([(1,), (256 * mib,), (256 * mib + 1,)], "b bigint")
    assert [r[0] for r in df.select(export.file_count(F.col("b"))).collect()] == [1, 1, 2]
    small = df.select(export.file_count(F.col("b"), target=1)).collect()
    assert [r[0] for r in small] == [1, 4, 5]


def test_hot_directory_is_cut_into_files(spark, tmp_path):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"),
    )
    layout = export.Layout(target_bytes=200_000)
    export.write_parquet(export.arrange(df, ["k"], layout), str(tmp_path / "t"), layout, ["k"])
    per_key = files.inventory(spark, str(tmp_path / "t")).groupBy(F.regexp_extract("path", "k=([^/]+)/", 1).alias("k")).count()
    counts = {r["k"]: r["count"] for r in per_key.collect()}
    assert counts["hot"] > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_writes_by_directory_do_not_sort(spark, tmp_path):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 90).alias("k"), "id")
    writers, size = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = [spark.conf.get(key, None) for key in (writers, size)]
    plain, clustered = export.Layout(), export.Layout(cluster_by=("id",))
    with export.file_sizing(spark, plain):
        assert int(spark.conf.get(writers)) == export.OPEN_FILES
        for layout, name in ((plain, "plain"), (clustered, "clustered")):
            # More directories than are open at once: what is left is sorted, nothing is lost.
            path = str(tmp_path / name)
            export.write_parquet(export.arrange(df, ["k"], layout), path, layout, ["k"])
            assert fingerprint(spark.read.parquet(path).select("k", "id")) == fingerprint(df)
        assert int(spark.conf.get(size)) == plain.target_bytes * export.SHUFFLE_TO_FILE
    assert [spark.conf.get(key, None) for key in (writers, size)] == before


def test_tasks_that_sort_are_smaller(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    plain, clustered = export.Layout(), export.Layout(cluster_by=("id",))
    one, two = export.file_sizing(spark, plain), export.file_sizing(spark, clustered)
    one.__enter__()
    two.__enter__()  # a table of the same run, written by another thread
    assert int(spark.conf.get(key)) == export.SORTED_BYTES < plain.target_bytes * export.SHUFFLE_TO_FILE
    one.__exit__(None, None, None)
    assert int(spark.conf.get(key)) == export.SORTED_BYTES
    two.__exit__(None, None, None)
    with export.file_sizing(spark, export.Layout(target_bytes=1000, cluster_by=("id",))):
        assert int(spark.conf.get(key)) == 1000 * export.SHUFFLE_TO_FILE


def test_second_run_exports_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    src = source(table(spark))
    assert lake.sync([src], "r1", "2025-02-01").state == "completed"
    again = lake.sync([src], "r2", "2025-02-02")
    assert (again.state, again.tables) == ("completed", 0)
    assert set(runs_of(lake).values()) == {"r1"}
    assert fingerprint(lake.read(src)) == fingerprint(src.frame)
    assert lake.summary().first()["total_rows"] == 2000


def test_modified_day_replaces_only_itself(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.sync([source(table(spark))], "r1", "2025-02-01")
    after = source(table(spark, bump=(5,), extra=7))
    lake.sync([after], "r2", "2025-02-02")
    runs = runs_of(lake)
    assert [p for p, r in runs.items() if r == "r2"] == ["20250105"]
    assert fingerprint(lake.read(after)) == fingerprint(after.frame)


@pytest.mark.parametrize("kind", ["timestamp", TS, "date"])
def test_only_planned_days_are_read(spark, tmp_path, kind):
    from floodmark.operators import batches, discovery

    path = str(tmp_path / "source")
    nulls = spark.sql(f"select 1L as id, cast(null as {TS}) as ts, cast(null as {TS}) as changed, 'n' as v")
    rows = table(spark).unionByName(nulls).withColumn("ts", F.col("ts").cast(kind))
    rows.write.parquet(path)
    src = source(spark.read.parquet(path))
    plan = batches.label_batches(batches.assign_batches(discovery.discover(src), 7))
    for wanted, count in ((["20250103", "20250115"], 200), (["__NULL__"], 1), (["20250120", "__NULL__"], 101)):
        picked = plan.where(F.col("partition_id").isin(wanted))
        got = export.assign_rows(src, picked)
        counts = {r["partition_id"]: r["count"] for r in got.groupBy("partition_id").count().collect()}
        assert set(counts) == set(wanted) and sum(counts.values()) == count
    text = export.assign_rows(src, plan.where("partition_id = '20250103'"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_hourly_partitions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    src = source(table(spark, days=(1, 2)), granularity="hour")
    lake.sync([src], "r1", "2025-02-01")
    assert len(runs_of(lake)) == 48
    assert fingerprint(lake.read(src)) == fingerprint(src.frame)


def test_unfinished_run_stays_invisible(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    src = source(table(spark))
    lake.sync([src], "r1", "2025-02-01")
    before = fingerprint(lake.read(src))
    changed = source(table(spark, bump=(5, 6), extra=3))

    class Killed(BaseException):
        pass

    def die(*_):
        raise Killed

    lake._publish = die
    with pytest.raises(Killed):
        lake.sync([changed], "r2", "2025-02-02")
    lake = Lake(spark, str(tmp_path))
    assert fingerprint(lake.read(src)) == before
    assert lake.orphans("2000-01-01").count() == 0
    assert lake.remove_orphans("2100-01-01") == 1
    assert {r["partition_id"] for r in lake.late([changed]).collect()} == {"20250105", "20250106"}
    lake.sync([changed], "r3", "2025-02-05")
    assert lake.verify(changed).where("matches").count() == 20
    assert 0 < lake.verify(changed, rate=0.3).count() < 20
    assert fingerprint(lake.read(changed)) == fingerprint(changed.frame)
    states = {r["run_id"]: r["state"] for r in lake.ledgers.latest("runs").collect()}
    assert states == {"r1": "completed", "r2": "aborted", "r3": "completed"}


def test_failed_table_is_found_again(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    good = source(table(spark))
    broken = F.when(F.col("v") == "v7", F.raise_error(F.lit("source went away"))).otherwise(F.col("v"))
    bad = TableSource("shop", "bad", table(spark).withColumn("v", broken), "ts", "changed")
    result = lake.sync([good, bad], "r1", "2025-02-01")
    assert result.state == "partial" and set(result.failed) == {"shop.bad"}
    failed = lake.ledgers.committed("partitions").where("state = 'failed'")
    assert failed.count() == 20
    repaired = TableSource("shop", "bad", table(spark), "ts", "changed")
    assert lake.sync([good, repaired], "r2", "2025-02-02").tables == 1
    assert fingerprint(lake.read(repaired)) == fingerprint(repaired.frame)


def test_new_column_gets_a_version(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    old = source(table(spark).drop("v"))
    lake.sync([old], "r1", "2025-02-01")
    new = source(table(spark, bump=(3,)))
    lake.sync([new], "r2", "2025-02-02")
    versions = {r["version"]: r["change_type"] for r in lake.ledgers.read("versions").collect()}
    assert versions == {1: "INITIAL", 2: "ADDITIVE"}
    assert lake.current_versions().first()["current_version"] == 2
    rows = lake.read(new)
    assert rows.count() == 2000 and rows.where("v is not null").count() == 100


def test_dropped_column_waits_for_acknowledgement(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.sync([source(table(spark))], "r1", "2025-02-01")
    lake.sync([source(table(spark, bump=(3,)).drop("v"))], "r2", "2025-02-02")
    now = lake.current_versions().first()
    assert (now["current_version"], now["latest_version"]) == (1, 2)
    lake.acknowledge("shop", "events", 2, "2025-02-03")
    assert lake.current_versions().first()["current_version"] == 2


def test_rules_choose_strategy(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    src = source(table(spark))
    skipped = TableSource("tmp", "scratch", table(spark), "ts", "changed")
    rules = [incremental.Rule("tmp.*", include=False), incremental.Rule("shop.*", strategy="full_refresh")]
    lake.sync([src, skipped], "r1", "2025-02-01", rules=rules)
    fewer = source(table(spark, days=range(1, 6)))
    lake.sync([fewer, skipped], "r2", "2025-02-02", rules=rules)
    assert runs_of(lake) == {"full": "r2"}
    assert fingerprint(lake.read(fewer)) == fingerprint(fewer.frame)
    # Partitions next to a full export would be read twice, so the switch is refused.
    refused = lake.sync([source(table(spark, bump=(3,)))], "r3", "2025-02-03")
    assert refused.state == "failed" and set(refused.failed) == {"shop.events"}
    assert fingerprint(lake.read(fewer)) == fingerprint(fewer.frame)


def test_manifest_matches_storage(spark, tmp_path):
    from floodmark.operators import manifest

    lake = Lake(spark, str(tmp_path))
    src = source(table(spark))
    lake.sync([src], "r1", "2025-02-01")
    listed = lake.manifest()
    stored = files.checksums(spark, str(tmp_path), [str(tmp_path / "data")])
    assert {r["status"] for r in manifest.check_files(stored, listed).collect()} == {"ok"}
    assert manifest.totals(listed).first()["row_count"] == 2000


def test_full_export_has_its_own_directory(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    src = source(table(spark))
    path = lake.export_full(src, "2025-02-01 03:04:05")
    assert path.endswith("project=default/dataset=shop/table=events/2025-02-01T03-04-05")
    assert fingerprint(spark.read.parquet(path)) == fingerprint(src.frame)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        lake.export_full(src, "2025-02-01 03:04:05")


def test_names_that_cannot_be_directories(spark):
    with pytest.raises(ValueError):
        export.table_dir("/x", "a/b", "t")


def test_clustered_files_are_sorted(spark, tmp_path):
    layout = export.Layout(cluster_by=("v", "id"))
    df = table(spark).withColumn("k", F.dayofmonth("ts") % 2)
    export.write_parquet(export.arrange(df, ["k"], layout), str(tmp_path / "t"), layout, ["k"])
    rows = spark.read.parquet(str(tmp_path / "t")).select("v", "id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    per_file = {}
    for r in rows.collect():
        per_file.setdefault(r["f"], []).append((r["i"], r["v"], r["id"]))
    for content in per_file.values():
        ordered = [x[1:] for x in sorted(content)]
        assert ordered == sorted(ordered)


def test_observed_schema_of_real_tables(spark):
    rows = registry.registry_rows(spark, [("d", "t", 1, table(spark).schema)])
    assert {r["path"]: r["type"] for r in rows.collect()} == {"id": "INT64", "ts": "DATETIME", "changed": "DATETIME", "v": "STRING"}


def start(spark, schema, tmp_path):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streaming.start_export(stream, "ts", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()


def test_stream_resumes_and_sets_late_rows_aside(spark, tmp_path):
    early, late = table(spark, days=range(10, 15)), table(spark, days=(2,))
    early.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    start(spark, early.schema, tmp_path)
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table(spark, days=(15,)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    start(spark, early.schema, tmp_path)
    start(spark, early.schema, tmp_path)
    out = str(tmp_path / "out")
    assert streaming.read_exported(spark, out, early.schema).count() == 700
    assert streaming.read_exported(spark, out, early.schema, "late").count() == 100
    assert streaming.commits(spark, out).count() == 3


def test_stream_batch_without_commit_is_invisible(spark, tmp_path):
    rows = table(spark, days=(1,))
    rows.write.parquet(str(tmp_path / "in"))
    start(spark, rows.schema, tmp_path)
    out = str(tmp_path / "out")
    before = streaming.read_exported(spark, out, rows.schema).count()
    rows.withColumns({"partition_id": F.lit("x"), "kind": F.lit("on_time")}).write.partitionBy("kind").parquet(f"{out}/data/batch_id=99")
    assert streaming.read_exported(spark, out, rows.schema).count() == before == 100


def test_scattered_days_are_read_alone(spark, tmp_path):
    from floodmark.operators import batches, discovery

    path = str(tmp_path / "source")
    days = spark.range(1, 181).selectExpr("id", f"cast(date_add(date'2024-12-31', cast(id as int)) as {TS}) as ts", "'v' as v")
    days = days.withColumn("changed", F.col("ts"))
    days.repartitionByRange(60, "ts").write.parquet(path)
    src = source(spark.read.parquet(path))
    plan = batches.label_batches(batches.assign_batches(discovery.discover(src), 7))
    wanted = [f"{d:%Y%m%d}" for d in (dt.date(2025, 1, 1) + dt.timedelta(days=2 * k) for k in range(70))]
    picked = plan.where(F.col("partition_id").isin(wanted))
    spans = export.planned_spans(src, picked)
    assert len(spans.ranges) == 70 and not spans.nulls
    read = export.within_spans(src, spans)
    assert read.count() == 70  # not the days between them
    assert sorted(r["partition_id"] for r in export.assign_rows(src, picked).collect()) == wanted
    assert "PushedFilters: [Or(" in read._jdf.queryExecution().executedPlan().toString()


def test_exported_again_counts_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "a lake"))  # a blank is %20 in the names that Spark reports
    before = source(table(spark))
    lake.sync([before], "r1", "2025-02-01")
    after = source(table(spark, bump=(5,), extra=7))
    lake.sync([after], "r2", "2025-02-02")
    listed = lake.manifest()
    assert listed.agg(F.sum("row_count")).first()[0] == after.frame.count() == lake.read(after).count()
    assert listed.agg(F.sum("superseded")).first()[0] == 100
    assert lake.published().agg(F.sum("row_count")).first()[0] == after.frame.count() + 100


@pytest.mark.parametrize("kinds", [("int", "bigint"), ("float", "double"), ("decimal(9,2)", "decimal(12,2)")])
def test_wider_stored_types_make_a_version(spark, tmp_path, kinds):
    lake = Lake(spark, str(tmp_path))
    for k, kind in enumerate(kinds):
        frame = spark.sql(f"select cast(id as {kind}) as n, cast('2025-01-0{k + 1}' as {TS}) as ts, cast('2025-01-0{k + 1}' as {TS}) as changed from range(5)")
        src = source(frame)
        lake.sync([src], f"r{k}", f"2025-02-0{k + 1}")
    versions = {r["version"]: (r["change_type"], r["widened"]) for r in lake.ledgers.read("versions").collect()}
    assert versions == {1: ("INITIAL", False), 2: ("ADDITIVE", True)}
    rows = lake.read(src)
    assert rows.schema["n"].dataType == src.frame.schema["n"].dataType and rows.count() == 10 - 5 * (k == 0)


def test_acknowledged_version_is_what_readers_get(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    make = lambda value, day_: spark.sql(f"select {value} as n, cast('2025-01-0{day_}' as {TS}) as ts, cast('2025-01-0{day_}' as {TS}) as changed")
    lake.sync([source(make("'x'", 1))], "r1", "2025-02-01")
    src = source(make("5L", 2))
    lake.sync([src], "r2", "2025-02-02")
    assert sorted(r["n"] for r in lake.read(src).collect()) == ["5", "x"]
    lake.acknowledge(src.dataset, src.table, 2, "2025-02-03")
    assert sorted((r["n"] for r in lake.read(src, strict=False).collect()), key=str) == [5, None]


def test_dead_runs_leave_no_version_and_are_closed(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    src = source(table(spark))
    lake.sync([src], "r1", "2025-02-01")
    wider = source(table(spark).withColumn("more", F.lit(1)))
    with monkeypatch.context() as m:
        m.setattr(Lake, "_plan", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.sync([wider], "r2", "2025-02-02")
    assert {r["run_id"]: r["state"] for r in lake.ledgers.latest("runs").collect()} == {"r1": "completed", "r2": "failed"}
    assert lake.current_versions().first()["latest_version"] == 1
    assert fingerprint(lake.read(src)) == fingerprint(src.frame)


def test_rules_that_leave_nothing(spark, tmp_path):
    from floodmark.operators.incremental import Rule

    lake = Lake(spark, str(tmp_path))
    src = source(table(spark))
    assert lake.sync([src], "r1", "2025-02-01", rules=[Rule("*", include=False)]).state == "completed"
    assert lake.read(src).count() == 0


@pytest.mark.parametrize(
    "root, path, want",
    [
        ("s3a://lake", "s3a://lake/data/dataset=lake/table=t/x.parquet", "data/dataset=lake/table=t/x.parquet"),
        ("s3a://lake", "s3a://lake/data/dataset=datalake/table=t/x.parquet", "data/dataset=datalake/table=t/x.parquet"),
        ("/tmp/a", "file:///tmp/a/data/tmp/a/x.parquet", "data/tmp/a/x.parquet"),
        ("file:///tmp/a", "file:/tmp/a/x.parquet", "x.parquet"),
        ("/lake/", "hdfs://host:8020/lake/lake/x.parquet", "lake/x.parquet"),
        ("/lake", "file:/other/lake/x.parquet", "file:/other/lake/x.parquet"),
    ],
)
def test_relative_paths_are_anchored(spark, root, path, want):
    from floodmark.sources.files import relative_path

    assert spark.range(1).select(relative_path(F.lit(path), root)).first()[0] == want


def test_row_groups_are_bounded_in_rows(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "rows")
    export.write_parquet(spark.range(0, 50_000, 1, 1), path, export.Layout(group_rows=10_000))
    (file,) = (tmp_path / "rows").glob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    sizes = [groups.row_group(k).num_rows for k in range(groups.num_row_groups)]
    assert sum(sizes) == 50_000 and max(sizes) <= 10_000
    # Version 2 writes sorted numbers as differences.
    assert "DELTA_BINARY_PACKED" in groups.row_group(0).column(0).encodings
    assert spark.read.parquet(path).count() == 50_000


def test_later_runs_and_samples_read_some_ranges(spark, tmp_path):
    path = str(tmp_path / "source")
    rows = table(spark, range(1, 29))
    rows.repartitionByRange(28, "ts").write.parquet(path)
    lake = Lake(spark, str(tmp_path / "lake"))
    src = source(spark.read.parquet(path))
    lake.sync([src], "r1", "2025-02-01")
    mark = lake.ledgers.latest("tables").first()["watermark"]
    # Rows changed at the watermark itself are looked at again: one day of 28.
    text = lake._touched(src, mark).frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and lake._touched(src, mark).frame.count() == 100
    assert lake._touched(src, None) is src
    checked = lake.verify(src, rate=0.3)
    found = checked.collect()
    assert 0 < len(found) < 28 and all(r["matches"] for r in found)
    pushed = [line for line in checked._jdf.queryExecution().executedPlan().toString().split("\n") if "PushedFilters" in line and "ts" in line]
    assert len(pushed) >= 2 and all("GreaterThanOrEqual(ts" in line for line in pushed)
