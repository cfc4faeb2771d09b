"""Operators on small literal frames."""

import datetime as dt
import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from floodmark.functions import classify, hashing, ids
from floodmark.operators import (
    asof,
    batches,
    discovery,
    incremental,
    keyed,
    ledger,
    manifest,
    report,
    unify,
    verify,
)
from floodmark.sources.tables import TableSource, scan_partition

TS = "timestamp_ntz"


def day(n):
    return dt.datetime(2025, 1, n)


# -- ids -----------------------------------------------------------------------------


def test_partition_ids(spark):
    cases = {
        "20240229": (dt.date(2024, 2, 29), "2024-02-29"),
        "20240230": (None, "2024-02-30"),
        "2024022905": (None, None),
        "202402": (None, None),
        "__NULL__": (None, "__NU-LL-__"),
        "full": (None, None),
    }
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    p = F.col("p")
    for r in df.select("p", ids.partition_day(p).alias("d"), ids.partition_date_text(p).alias("t")).collect():
        assert (r["d"], r["t"]) == cases[r["p"]], r


def test_table_names(spark):
    df = spark.createDataFrame([("a.b",), ("a.b.c",), ("ab",)], "n string")
    got = [r[0] for r in df.select(ids.table_parts(F.col("n"))).collect()]
    assert [tuple(g) if g else None for g in got] == [("a", "b"), ("a", "b.c"), None]


def test_paths_and_times(spark):
    one = spark.range(1)
    at = F.lit("2025-01-02 03:04:05").cast(TS)
    r = one.select(
        ids.export_path(F.lit("d"), F.lit("t"), F.lit(3), F.lit("x")), ids.rfc3339(at), ids.run_stamp(at)
    ).first()
    assert tuple(r) == ("dataset=d/table=t/schema_version=v3/x", "2025-01-02T03:04:05Z", "2025-01-02T03-04-05")


def test_error_classes(spark):
    cases = {
        "quota exceeded: timeout": "quota",
        "Quota exceeded": "unknown",
        "rpc: unauthenticated": "auth",
        "permission denied": "auth",
        "dial: connection refused": "store_unavailable",
        "lookup: no such host": "store_unavailable",
        "context deadline exceeded": "transient",
        "i/o timeout": "transient",
        "other": "unknown",
    }
    df = spark.createDataFrame([(c,) for c in cases], "m string")
    for r in df.select("m", classify.error_class(F.col("m")).alias("c")).collect():
        assert r["c"] == cases[r["m"]]


# -- hashing -------------------------------------------------------------------------


def test_fingerprint_ignores_order_and_counts_copies(spark):
    data = [(i, f"v{i % 3}", None if i % 4 else 1.5) for i in range(50)]
    shuffled = data[:]
    random.Random(1).shuffle(shuffled)

    def fingerprint(rows):
        df = spark.createDataFrame(rows, "a bigint, b string, c double")
        return tuple(df.agg(*hashing.fingerprint_aggregates(df)).first())

    assert fingerprint(data) == fingerprint(shuffled)
    assert fingerprint(data) != fingerprint(data + data[:1])
    assert fingerprint(data) != fingerprint([(*data[0][:2], 2.0), *data[1:]])


def test_row_text_keeps_values_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "-"), ("-", None)], "x string, y string")
    assert df.select(hashing.row_text(df)).distinct().count() == 4


def test_row_text_of_nested_values(spark):
    df = spark.sql(
        "select array(1, null) a, named_struct('x', cast(null as int), 'y', 2) s, "
        "map('k', 1) m, X'00ff' b union all "
        "select array(1), named_struct('x', 2, 'y', cast(null as int)), map('k', 2), X'00fe'"
    )
    assert df.select(hashing.row_text(df)).distinct().count() == 2


def test_shards_cover_all_keys(spark):
    df = spark.range(1000).select(hashing.hash_shard(F.col("id"), 7).alias("s"))
    counts = [r["count"] for r in df.groupBy("s").count().collect()]
    assert len(counts) == 7 and sum(counts) == 1000 and min(counts) > 90


# -- discovery and batches -----------------------------------------------------------


def parts(spark, rows):
    return spark.createDataFrame(rows, "dataset string, table string, partition_id string, total_rows bigint")


def test_discovery_keeps_rows_without_a_partition(spark):
    df = spark.createDataFrame([(day(1), 1), (day(1), 2), (None, 3)], f"ts {TS}, v int")
    found = discovery.discover(TableSource("d", "t", df, "ts", "ts"), with_bytes=True)
    got = {r["partition_id"]: (r["total_rows"], r["total_logical_bytes"]) for r in found.collect()}
    assert got == {"20250101": (2, 32), "__NULL__": (1, 8)}


def test_discovery_granularity_and_scan(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 2, 3, 30),), (day(2),), (None,)], f"ts {TS}")
    for unit, expected in (("hour", {"2025010203", "2025010200"}), ("month", {"202501"}), ("year", {"2025"})):
        source = TableSource("d", "t", df, "ts", granularity=unit)
        found = {r["partition_id"] for r in discovery.discover(source).collect()}
        assert found == expected | {"__NULL__"}
        assert sum(scan_partition(source, p).count() for p in found) == 3
    assert scan_partition(TableSource("d", "t", df, "ts"), "20250102").count() == 2


def test_metadata_row_without_id_is_the_full_table(spark):
    df = spark.createDataFrame([(None,), ("20250101",)], "partition_id string")
    assert {r[0] for r in discovery.from_metadata(df).collect()} == {"full", "20250101"}


def test_discovery_from_files(spark, tmp_path):
    rows = spark.range(100).withColumn("p", (F.col("id") % 2).cast("string"))
    rows.write.partitionBy("p").parquet(str(tmp_path / "t"))
    df = spark.read.schema("id bigint, p string").parquet(str(tmp_path / "t"))
    found = discovery.discover_files(df, "p", "d", "t").collect()
    assert {r["partition_id"]: r["total_rows"] for r in found} == {"0": 50, "1": 50}
    assert all(r["stored_bytes"] > 0 and r["last_modified"] for r in found)


def expected_batches(pids, days):
    """Batches of one table, by walking the calendar."""

    def parse(p):
        try:
            return dt.datetime.strptime(p, "%Y%m%d") if len(p) == 8 and p.isdigit() else None
        except ValueError:
            return None

    first, last = parse(min(pids)), parse(max(pids))
    if first is None or last is None:
        return {p: 0 for p in pids}
    return {p: -1 if parse(p) is None else (parse(p) - first).days // days for p in pids}


odd_ids = st.one_of(
    st.dates(dt.date(2023, 12, 1), dt.date(2024, 3, 1)).map(lambda d: d.strftime("%Y%m%d")),
    st.sampled_from(["20240230", "2024010105", "__NULL__", "202401"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abc"), st.sets(odd_ids, min_size=1, max_size=12), min_size=1), st.integers(1, 40))
def test_batches_cover_every_partition_once(spark, tables, days):
    rows = [("d", t, p, 1) for t, pids in tables.items() for p in pids]
    got = batches.assign_batches(parts(spark, rows), days).collect()
    assert sorted((r["table"], r["partition_id"]) for r in got) == sorted((t, p) for _, t, p, _ in rows)
    for t, pids in tables.items():
        want = expected_batches(pids, days)
        assert {r["partition_id"]: r["batch_idx"] for r in got if r["table"] == t} == want


def test_batch_edges_start_at_first_day(spark):
    rows = [("d", "t", f"202401{n:02d}", 2) for n in (3, 9, 10, 31)]
    plan = {r["batch_idx"]: r for r in batches.plan_batches(parts(spark, rows)).collect()}
    assert set(plan) == {0, 1, 4}
    assert (plan[0]["start_pid"], plan[0]["end_pid"], plan[0]["total_rows"]) == ("20240103", "20240109", 4)


def test_nonpositive_batch_days_mean_default(spark):
    rows = [("d", "t", "20240101", 1), ("d", "t", "20240108", 1)]
    assert batches.plan_batches(parts(spark, rows), 0).count() == 2


# -- incremental ---------------------------------------------------------------------


def test_watermark_filter_is_strict(spark):
    rows = [("d", "t", "1", day(1)), ("d", "t", "2", day(2)), ("d", "t", "3", day(3)), ("d", "u", "1", day(1))]
    df = spark.createDataFrame(rows, f"dataset string, table string, partition_id string, last_modified {TS}")
    marks = spark.createDataFrame([("d", "t", day(2))], f"dataset string, table string, watermark {TS}")
    got = sorted((r["table"], r["partition_id"]) for r in incremental.changed_since(df, marks).collect())
    assert got == [("t", "3"), ("u", "1")]


def outcome(spark, rows):
    schema = f"dataset string, table string, last_modified {TS}, committed boolean, watermark {TS}"
    return incremental.advance_watermark(spark.createDataFrame(rows, schema)).first()["watermark"]


def test_watermark_stays_below_failures(spark):
    ok = [("d", "t", day(n), True, None) for n in (1, 2, 5)]
    assert outcome(spark, ok) == day(5)
    failed = [*ok, ("d", "t", day(4), False, None)]
    assert outcome(spark, failed) == day(4) - dt.timedelta(microseconds=1)
    earlier = [("d", "t", None, True, day(9)), *failed]
    assert outcome(spark, earlier) == day(9)
    assert outcome(spark, [("d", "t", day(4), False, None)]) is None


def test_late_predicate(spark):
    rows = [(day(2), day(1), True), (day(1), day(2), False), (day(1), day(1), False)]
    df = spark.createDataFrame(rows, f"m {TS}, s {TS}, want boolean")
    assert df.where(incremental.is_late(F.col("m"), F.col("s")) != F.col("want")).count() == 0


def test_skip_exported(spark):
    key = "dataset string, table string, partition_id string"
    plan = spark.createDataFrame([("d", "t", p, day(2)) for p in "abcd"], f"{key}, last_modified {TS}")
    state = spark.createDataFrame(
        [
            ("d", "t", "a", day(2), "p/a"),  # done
            ("d", "t", "b", day(1), "p/b"),  # modified since
            ("d", "t", "c", day(2), "p/c"),  # file gone
            ("d", "t", "d", day(2), ""),  # never exported
        ],
        f"{key}, exported_modified {TS}, exported_path string",
    )
    there = spark.createDataFrame([("p/a",), ("p/b",)], "path string")
    kept = incremental.skip_exported(plan, state, there)
    assert sorted(r["partition_id"] for r in kept.collect()) == ["b", "c", "d"]


def test_first_rule_wins(spark):
    tables = spark.createDataFrame([("a", "x1"), ("a", "y"), ("b", "x1")], "dataset string, table string")
    rules = [
        incremental.Rule("a.x?", strategy="full_refresh"),
        incremental.Rule("a.*", batch_days=30),
        incremental.Rule("b.*", include=False),
    ]
    got = {(r["dataset"], r["table"]): (r["strategy"], r["batch_days"]) for r in incremental.apply_rules(tables, rules).collect()}
    assert got == {("a", "x1"): ("full_refresh", 7), ("a", "y"): ("partition", 30)}
    assert incremental.apply_rules(tables, []).count() == 3


# -- keyed ---------------------------------------------------------------------------


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz") | st.none()), min_size=1, max_size=40), st.integers(1, 9))
def test_counted_changes_do_not_depend_on_buckets(spark, seen, width):
    rows = [(k, i, v) for i, (k, v) in enumerate(seen)]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    got = keyed.count_changes(df, ["k"], "at", "v", F.floor(F.col("at") / width), "n").collect()
    for key in "ab":
        n, last, want = 0, object(), {}
        for k, at, v in rows:
            if k == key:
                turned = v != last
                n, last = n + turned, v
                want[at] = (n, turned)
        assert {r["at"]: (r["n"], r["is_change"]) for r in got if r["k"] == key} == want


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "z")], "k string, at int, v string")
    assert {tuple(r) for r in keyed.latest_per_key(df, ["k"], ["at"]).collect()} == {("a", 2, None), ("b", 1, "z")}
    assert {tuple(r) for r in keyed.first_per_key(df, ["k"], ["at"]).collect()} == {("a", 1, "x"), ("b", 1, "z")}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_per_key(spark, how):
    many = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    one = spark.createDataFrame([(0, "x"), (2, "y")], "k bigint, v string")
    want = sorted(map(tuple, many.join(one, "k", how).collect()))
    assert sorted(map(tuple, keyed.join_per_key(many, one, ["k"], how).collect())) == want
    with pytest.raises(ValueError):
        keyed.join_per_key(many, one, ["k"], "full")


def test_hot_key_is_split_by_measured_bytes(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        many = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        joined = keyed.join_per_key(many, spark.range(200_000).select(F.col("id").alias("k"), F.lit(1).alias("one")), ["k"], "inner")
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_snapshot_as_of(spark):
    log = spark.createDataFrame([("a", day(1), 1), ("a", day(3), 2), ("b", day(5), 3)], f"k string, ts {TS}, v int")
    at = F.lit("2025-01-04").cast(TS)
    assert [tuple(r) for r in asof.snapshot_as_of(log, ["k"], "ts", at).collect()] == [("a", day(3), 2)]


# -- ledgers -------------------------------------------------------------------------


def test_runs_and_stale_runs(spark):
    schema = f"run_id string, state string, at {TS}, started_at {TS}"
    runs = spark.createDataFrame(
        [
            ("done", "running", day(1), day(1)),
            ("done", "completed", day(1), day(1)),
            ("dead", "running", day(1), day(1)),
            ("young", "running", day(9), day(9)),
        ],
        schema,
    )
    now = F.lit("2025-01-09 12:00:00").cast(TS)
    assert [r["run_id"] for r in ledger.stale_runs(runs, now).collect()] == ["dead"]
    aborted = runs.unionByName(ledger.abort_rows(runs, now))
    states = {r["run_id"]: r["state"] for r in ledger.latest_runs(aborted).collect()}
    assert states == {"done": "completed", "dead": "aborted", "young": "running"}


def test_insert_missing_is_idempotent(spark):
    old = spark.createDataFrame([("proj", "ds", "tbl", 1)], "p string, d string, t string, at int")
    new = spark.createDataFrame([("proj", "ds", "tbl", 2), ("proj", "ds", "other", 3), ("proj", "ds", "other", 4)], "p string, d string, t string, at int")
    added = ledger.insert_missing(new, old, ["p", "d", "t"], ["at"])
    assert [tuple(r) for r in added.collect()] == [("proj", "ds", "other", 3)]
    assert ledger.insert_missing(new, old.unionByName(added), ["p", "d", "t"], ["at"]).count() == 0


def test_run_totals_and_counters(spark):
    schema = "run_id string, dataset string, table string, state string, rows bigint, stored_bytes bigint"
    tasks = spark.createDataFrame(
        [
            ("1", "d", "t", "completed", 5, 50),
            ("1", "d", "t", "failed", 0, 0),
            ("2", "d", "t", "completed", 7, 70),
            ("3", "d", "t", "failed", 0, 0),
        ],
        schema,
    )
    totals = {r["run_id"]: tuple(r)[1:] for r in report.run_totals(tasks).collect()}
    assert totals == {"1": (2, 1, 1, "partial"), "2": (1, 1, 0, "completed"), "3": (1, 0, 1, "failed")}
    done = report.counters(tasks).where("state = 'completed'").first()
    assert (done["n_tasks"], done["rows_extracted"], done["bytes_stored"]) == (2, 12, 120)


def test_summary_lists_empty_tables(spark):
    tables = spark.createDataFrame([("d", "t"), ("d", "u")], "dataset string, table string")
    p = spark.createDataFrame(
        [("d", "t", "a", 5, 10), ("d", "t", "b", 6, None)],
        "dataset string, table string, partition_id string, row_count bigint, bytes bigint",
    )
    got = [tuple(r) for r in report.in_display_order(report.summary(tables, p)).collect()]
    assert got == [("d", "t", 2, 11, 10), ("d", "u", 0, 0, 0)]
    versions = spark.createDataFrame([("d", "t", 1), ("d", "u", 1)], "dataset string, table string, version int")
    detail = report.table_detail(versions, p, "d", "t")
    assert (detail[0].count(), detail[1].count()) == (1, 2)


def test_durations_and_ratio(spark):
    tasks = spark.createDataFrame([("t", 0.003), ("t", 0.3), ("t", 99.0), ("t", None)], "name string, s double")
    got = {r["le"]: r["cumulative_count"] for r in report.duration_histogram(tasks, "s", ["name"]).collect()}
    assert got[0.005] == 1 and got[0.25] == 1 and got[0.5] == 2 and got[10.0] == 2 and got[float("inf")] == 3
    assert report.duration_percentiles(tasks, "s", ["name"]).first()["p50"] == 0.3
    sizes = spark.createDataFrame([("a", 80, 10), ("b", 5, 0)], "t string, raw bigint, kept bigint")
    ratios = {r["t"]: r["ratio"] for r in report.compression_ratio(sizes, "raw", "kept", ["t"]).collect()}
    assert ratios == {"a": 8.0, "b": None}


# -- manifests -----------------------------------------------------------------------

FILES = "dataset string, table string, path string, size bigint, row_count bigint, sha256 string"


def listed(spark, *files):
    return spark.createDataFrame([("d", "t", *f) for f in files], FILES)


def test_manifest_merge_and_totals(spark):
    m1 = listed(spark, ("part-00001.parquet", 1000, 100, "abc"), ("part-00002.parquet", 2000, 200, "def"))
    m2 = listed(spark, ("part-00002.parquet", 100, 50, "dup"), ("part-00003.parquet", 3000, 300, "ghi"))
    merged = manifest.merge(m1, m2)
    assert {r["path"]: r["sha256"] for r in merged.collect()}["part-00002.parquet"] == "def"
    assert tuple(manifest.totals(merged).first())[2:] == (3, 600, 6000)
    assert {r["sha256"] for r in manifest.merge(m2, m1).collect()} == {"abc", "dup", "ghi"}


def test_manifest_json_roundtrip(spark):
    m1 = listed(spark, ("a.parquet", 1000, 100, "abc"), ("b.parquet", 2000, 200, "def"))
    documents = manifest.encode(m1, F.lit("2025-01-02 03:04:05").cast(TS))
    back = manifest.decode(documents)
    assert sorted(map(tuple, back.select(m1.columns).collect())) == sorted(map(tuple, m1.collect()))
    assert back.first()["exported_at"] == "2025-01-02T03:04:05Z"
    whole = spark.createDataFrame(
        [('{"schema_version":"v1","files":[{"path":"a","size":1,"row_count":2,"sha256":"x"},{"path":"b"}]}',)],
        "value string",
    )
    assert [r["path"] for r in manifest.decode(whole).collect()] == ["a", "b"]


def test_file_status_and_orphans(spark):
    stored = spark.createDataFrame(
        [("ok", 1, "a", day(1)), ("edited", 1, "b", day(1)), ("old", 1, "c", day(1)), ("new", 1, "d", day(8))],
        f"path string, size bigint, sha256 string, modified {TS}",
    )
    known = listed(spark, ("ok", 1, 1, "a"), ("edited", 1, 1, "a"), ("lost", 1, 1, "a"))
    status = {r["path"]: r["status"] for r in manifest.check_files(stored, known).collect()}
    assert status == {"ok": "ok", "edited": "changed", "lost": "missing", "old": "untracked", "new": "untracked"}
    now = F.lit("2025-01-08 12:00:00").cast(TS)
    assert [r["path"] for r in manifest.orphans(stored, known, now).collect()] == ["old"]


def test_checksum_of_known_bytes(spark, tmp_path):
    from floodmark.sources import files

    (tmp_path / "x.parquet").write_bytes(b"hello world")
    row = files.checksums(spark, str(tmp_path)).first()
    assert (row["path"], row["size"]) == ("x.parquet", 11)
    assert row["sha256"] == hashlib.sha256(b"hello world").hexdigest()


# -- verification and unification ------------------------------------------------------


def test_counts_compare_both_ways(spark):
    a = spark.createDataFrame([("1", 5), ("2", 5)], "partition_id string, row_count bigint")
    b = spark.createDataFrame([("2", 5), ("3", 5)], "partition_id string, row_count bigint")
    assert {r["partition_id"]: r["matches"] for r in verify.compare_counts(a, b).collect()} == {"1": False, "2": True, "3": False}


def test_sample_rates(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("partition_id"))
    assert verify.sampled(keys, 0.0).count() == 0
    assert verify.sampled(keys, 1.0).count() == 2000
    assert 120 < verify.sampled(keys, 0.1).count() < 280
    with pytest.raises(ValueError):
        verify.sampled(keys, 1.5)


def test_value_diff_names_columns(spark):
    schema = "k int, a string, b int"
    left = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, "x", 1), (4, "x", 1), (4, "x", 1)], schema)
    right = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (5, "x", 1), (4, "x", 1)], schema)
    got = {r["k"]: (r["status"], r["columns"]) for r in verify.value_diff(left, right, "k", ["a", "b"]).collect()}
    assert got == {2: ("changed", "a,b"), 3: ("missing", ""), 4: ("duplicate", ""), 5: ("extra", "")}


def test_unify_nested_versions(spark):
    v1 = spark.sql("select 1 as id, named_struct('x', 1) as s, array(named_struct('q', 1)) as l")
    v2 = spark.sql(
        "select 2L as id, named_struct('x', 2L, 'y', 'n') as s, array(named_struct('q', 2L, 'r', 'm')) as l, 1.5D as d"
    )
    rows = {r["id"]: r for r in unify.unify([v1, v2], v2.schema).collect()}
    assert rows[1]["s"]["y"] is None and rows[1]["l"][0]["r"] is None and rows[1]["d"] is None
    assert rows[2]["s"]["y"] == "n" and rows[2]["l"][0]["q"] == 2


def test_lenient_casts_are_counted(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    target = spark.createDataFrame([], "v int").schema
    assert unify.cast_failures(df, target).first()["v"] == 1
    assert [r["v"] for r in unify.conform(df, target, strict=False).collect()] == [1, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        unify.conform(df, target).collect()


def test_rewrite_forward_refuses_drops(spark):
    df = spark.sql("select 1 as a, named_struct('x', 1, 'y', 2) as s")
    target = spark.sql("select 1L as a, named_struct('x', 1) as s").schema
    with pytest.raises(ValueError, match="s.y"):
        unify.rewrite_forward(df, target)


def test_view_text_joins_renamed_columns(spark):
    spark.sql("select 1 as id, 'old' as nm").createOrReplaceTempView("rv1")
    spark.sql("select 2 as id, 'new' as name").createOrReplaceTempView("rv2")
    versions = [(v, spark.table(v).schema) for v in ("rv1", "rv2")]
    text = unify.view_text(versions, spark.table("rv2").schema, {"name": "nm"})
    assert sorted(map(tuple, spark.sql(text).collect())) == [(1, "old"), (2, "new")]


def test_storable_types(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    df = spark.sql(
        "select time'01:02:03.5' as t, interval '1-2' year to month as ym, "
        "interval '3 04:05:06.7' day to second as ds, 1.5BD as n, cast(1.5 as decimal(38,20)) as big"
    )
    row = unify.storable(df).first()
    assert row["t"] == 3_723_500_000
    assert tuple(row["ym"]) == (14, 0, 0)
    assert tuple(row["ds"]) == (0, 3, 14_706_700_000)
    assert row["big"] == "1.50000000000000000000"
    with pytest.raises(ValueError):
        unify.storable(df, big_decimals="wide")


def test_range_and_geography(spark):
    df = spark.sql("select cast(null as date) as lo, date'2025-01-01' as hi, 'POINT(1 2)' as g")
    out = df.select(unify.range_value(F.col("lo"), F.col("hi")).alias("r"), unify.geography(F.col("g"), "g"))
    row = out.first()["r"]
    assert row["unbounded_low"] and not row["unbounded_high"]
    assert out.schema["g"].metadata == {"geo_format": "wkt"}
