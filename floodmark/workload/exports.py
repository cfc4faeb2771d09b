"""Queries that export, publish, check and read back."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.functions import hashing, ids
from floodmark.operators import batches, discovery, manifest, sketches, verify, zonemaps
from floodmark.operators.incremental import Rule
from floodmark.operators.journal import Journal
from floodmark.operators.ledger import Ledgers
from floodmark.plans import digests, export
from floodmark.plans.sync import Lake
from floodmark.session import fresh_dir
from floodmark.sources import files
from floodmark.sources.tables import TableSource, union_all, with_text
from floodmark.streaming import export as streaming
from floodmark.workload import base
from floodmark.workload.base import query


def _export(spark: SparkSession, source: TableSource, days: int, root: str) -> DataFrame:
    """Export all partitions of a source in batches and return what was written."""
    plan_dir = f"{root}/plan"
    planned = batches.label_batches(batches.assign_batches(discovery.discover(source), days))
    planned.write.parquet(plan_dir)
    plan = spark.read.schema(planned.schema).parquet(plan_dir)
    target = export.run_dir(root, source.dataset, source.table, 1, "r1")
    export.export_batches(source, plan, target)
    return spark.read.parquet(target)


@query(
    f"""select strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count,
      {base.fingerprint_sql(base.EVENT_TEXT)} as fingerprint
    from events group by 1"""
)
def export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    written = _export(spark, base.events(spark, sf), 7, fresh_dir(spark, "batches"))
    content = written.withColumn("cents", base.cents("value"))
    return verify.fingerprint_by(content, F.col("partition_id"), base.EVENT_COLUMNS)


@query("select * from customer")
def export_full_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    source = base.customer(spark, sf)
    lake = Lake(spark, fresh_dir(spark, "full"))
    return spark.read.parquet(lake.export_full(source, "2024-02-01 03:04:05"))


@query(
    """select strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count,
      count(distinct user_id) as n_users
    from events where not (dayofmonth(ts) in (9, 10) and event_type = 'error') group by 1"""
)
def partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    events = base.table(spark, sf, "events")
    target = fresh_dir(spark, "partitions")
    pid = ids.partition_id(F.to_date("ts"))
    export.export_partitions(events, pid, target)
    again = F.dayofmonth("ts").isin(9, 10) & (F.col("event_type") != "error")
    export.export_partitions(events.where(again), pid, target)
    written = spark.read.schema(with_text(events.schema, "partition_id")).parquet(target)
    return written.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("user_id").alias("n_users")
    )


@query(
    f"""
    with texts as (
      select l_returnflag, l_linestatus,
        concat_ws('|', cents, l_linenumber, l_orderkey, l_partkey) as txt
      from (select *, cast(round(l_extendedprice * 100) as bigint) as cents from lineitem))
    select l_returnflag || l_linestatus as partition_id, count(*) as row_count,
      {base.fingerprint_sql('txt')} as fingerprint
    from texts group by 1"""
)
def additive_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    items = base.table(spark, sf, "lineitem").withColumn("cents", base.cents("l_extendedprice"))
    columns = ["cents", "l_linenumber", "l_orderkey", "l_partkey"]
    return verify.fingerprint_by(items, F.concat("l_returnflag", "l_linestatus"), columns)


@query(
    """
    with days as (select cast(ts as date) as d, event_type, value from events),
    first_day as (select min(d) as d0, max(d) as d1 from days)
    select strftime(d0 + 7 * ((d - d0) // 7)::integer, '%Y%m%d') || '_' ||
      strftime(least(d0 + 7 * ((d - d0) // 7)::integer + 6, d1), '%Y%m%d') as batch,
      event_type, count(*) as n
    from days, first_day group by 1, 2"""
)
def batch_scan(spark: SparkSession, sf: str) -> DataFrame:
    written = _export(spark, base.events(spark, sf), 7, fresh_dir(spark, "scan"))
    return written.groupBy("batch", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    select 'zstd' as codec, count(*) as written_rows, count(*) as read_rows,
      sum(cast(round(o_totalprice * 100) as bigint))::bigint as cents from orders
    union all
    select 'snappy', count(*), count(*), sum(cast(round(o_totalprice * 100) as bigint))::bigint from orders"""
)
def codec_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    orders = base.table(spark, sf, "orders")
    root = fresh_dir(spark, "codecs")
    results = []
    for codec in export.CODECS:
        layout = export.Layout(codec=codec)
        rows = export.write_counted(orders, f"{root}/{codec}", f"rows_{codec}", layout=layout)
        results.append(
            spark.read.parquet(f"{root}/{codec}").agg(
                F.lit(codec).alias("codec"),
                F.lit(rows).cast("bigint").alias("written_rows"),
                F.count(F.lit(1)).alias("read_rows"),
                F.sum(base.cents("o_totalprice")).alias("cents"),
            )
        )
    return results[0].unionByName(results[1])


@query(
    """select ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % 8 as shard, count(*) as row_count,
      min(n_chars) as min_chars, max(n_chars) as max_chars, sum(strlen(text))::bigint as text_bytes
    from documents group by 1"""
)
def sharded_sorted_export(spark: SparkSession, sf: str) -> DataFrame:
    target = fresh_dir(spark, "shards")
    layout = export.Layout(cluster_by=("n_chars",), max_rows=100_000)
    export.export_sharded(base.table(spark, sf, "documents"), "doc_id", 8, target, layout)
    per_file = (
        spark.read.parquet(target)
        .groupBy(F.col("shard").cast("bigint").alias("shard"), F.col("_metadata.file_path").alias("path"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("n_chars").alias("lo"),
            F.max("n_chars").alias("hi"),
            F.sum(F.octet_length("text").cast("bigint")).alias("b"),
        )
    )
    return per_file.groupBy("shard").agg(
        F.sum("n").alias("row_count"),
        F.min("lo").alias("min_chars"),
        F.max("hi").alias("max_chars"),
        F.sum("b").alias("text_bytes"),
    )


@query(
    """select ('0x' || substr(md5(o_orderkey::varchar), 1, 8))::bigint % 16 as shard, count(*) as n,
      min(o_orderkey) as first_key
    from orders group by 1"""
)
def shard_assignment(spark: SparkSession, sf: str) -> DataFrame:
    shard = hashing.hash_shard(F.col("o_orderkey"), 16)
    return (
        base.table(spark, sf, "orders")
        .groupBy(shard.alias("shard"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))
    )


# -- manifests ---------------------------------------------------------------------


@query(
    """
    select 'logs' as dataset, 'events' as "table", count(*) as row_count from events
    union all
    select 'shop', 'orders', count(*) from orders"""
)
def manifest_totals(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "totals")
    built = None
    for source, days in ((base.events(spark, sf), 7), (base.orders(spark, sf), 365)):
        written = _export(spark, source, days, f"{root}/{source.table}")
        below = export.run_dir(f"{root}/{source.table}", source.dataset, source.table, 1, "r1")
        rows = manifest.build(
            files.checksums(spark, root, [below]), files.rows_per_file(written, root)
        ).withColumns({"dataset": F.lit(source.dataset), "table": F.lit(source.table)})
        built = rows if built is None else manifest.merge(built, rows)
    return manifest.totals(built).select("dataset", "table", "row_count")


_FILES = """
with files as (
  select l_linenumber as line, 'shop' as dataset, 'm' || l_returnflag as "table",
    'part-' || l_orderkey || '.parquet' as path,
    cast(round(l_extendedprice * 100) as bigint) as bytes
  from lineitem),
m1 as (
  select dataset, "table", path, sum(bytes)::bigint as size, count(*) as row_count,
    sha256(path || '1') as sha256 from files where line <= 4 group by 1, 2, 3),
m2 as (
  select dataset, "table", path, sum(bytes)::bigint as size, count(*) as row_count,
    sha256(path || '2') as sha256 from files where line >= 3 group by 1, 2, 3)"""


def _manifests(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two manifests that share paths: the first and the last lines of each order."""
    items = base.table(spark, sf, "lineitem")

    def one(rows: DataFrame, mark: str) -> DataFrame:
        path = F.concat(F.lit("part-"), F.col("l_orderkey").cast("string"), F.lit(".parquet"))
        grouped = rows.groupBy("l_returnflag", "l_orderkey").agg(
            F.sum(base.cents("l_extendedprice")).alias("size"), F.count(F.lit(1)).alias("row_count")
        )
        return grouped.select(
            F.lit("shop").alias("dataset"),
            F.concat(F.lit("m"), "l_returnflag").alias("table"),
            path.alias("path"),
            "size",
            "row_count",
            F.sha2(F.concat(path, F.lit(mark)), 256).alias("sha256"),
        )

    return one(items.where("l_linenumber <= 4"), "1"), one(items.where("l_linenumber >= 3"), "2")


@query(
    f"""{_FILES}
    select * from m1 union all
    select * from m2 where not exists (
      select 1 from m1 where m1.dataset = m2.dataset and m1."table" = m2."table" and m1.path = m2.path)"""
)
def manifest_merge(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.merge(*_manifests(spark, sf))


@query(
    f"""{_FILES}
    select 'v1' as schema_version, '2024-02-01T03:04:05Z' as exported_at, dataset, "table", path,
      size, row_count, sha256 from m1"""
)
def manifest_json(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "manifest")
    at = F.lit("2024-02-01 03:04:05").cast("timestamp_ntz")
    manifest.encode(_manifests(spark, sf)[0], at).write.text(root)
    return manifest.decode(spark.read.text(root))


_BATCHES = """
with days as (select distinct cast(ts as date) as d from events),
edges as (select min(d) as d0, max(d) as d1 from days),
labels as (
  select distinct strftime(d0 + 7 * ((d - d0) // 7)::integer, '%Y%m%d') as first_day,
    strftime(d0 + 7 * ((d - d0) // 7)::integer, '%Y%m%d') || '_' ||
    strftime(least(d0 + 7 * ((d - d0) // 7)::integer + 6, d1), '%Y%m%d') as batch
  from days, edges)"""


@query(
    f"""{_BATCHES}
    select batch, case first_day when '20240101' then 'changed' when '20240108' then 'untracked'
      else 'ok' end as status from labels
    union all
    select batch || '_gone', 'missing' from labels"""
)
def file_checksums(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "checks")
    source = base.events(spark, sf)
    written = _export(spark, source, 7, root)
    target = export.run_dir(root, source.dataset, source.table, 1, "r1")
    batch = F.regexp_extract("path", "batch=([^/]+)/", 1)
    stored = files.checksums(spark, root, [target])
    listed = manifest.build(stored, files.rows_per_file(written, root))
    edited = listed.where(~batch.startswith("20240108")).withColumn(
        "sha256", F.when(batch.startswith("20240101"), F.lit("0")).otherwise(F.col("sha256"))
    )
    gone = listed.withColumn("path", F.regexp_replace("path", "(batch=[^/]+)/", "$1_gone/"))
    checked = manifest.check_files(stored, edited.unionByName(gone))
    return checked.select(batch.alias("batch"), "status").distinct()


# -- whole runs --------------------------------------------------------------------


@query(
    """
    select 'read' as what, strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count
    from events group by 2
    union all
    select 'listed', 'events', count(*) from events
    union all
    select 'orphaned', 'r2', count(*) from events"""
)
def staged_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A second run writes its files and dies before it is closed."""
    source = base.events(spark, sf)
    lake = Lake(spark, fresh_dir(spark, "publish"))
    lake.sync([source], "r1", "2024-02-01 00:00:00")
    dead = export.run_dir(lake.root, source.dataset, source.table, 1, "r2")
    rows = source.frame.withColumns({"partition_id": source.partition_id(), "batch": F.lit("all")})
    export.write_parquet(rows, dead, partition_by=["batch"])
    inventory = files.inventory(spark, lake.root, "part-*.zstd.parquet").where(
        F.col("path").startswith("data/")
    )
    later = F.current_timestamp() + F.expr("INTERVAL 2 DAYS")
    stored = spark.read.parquet(f"{dead}/batch=all")
    orphaned = (
        manifest.orphans(inventory, lake.manifest(), later)
        .join(files.rows_per_file(stored, lake.root), "path", "left")
        .groupBy(F.regexp_extract("path", "/run=([^/]+)/", 1).alias("partition_id"))
        .agg(F.sum("row_count").alias("row_count"))
    )
    listed = manifest.totals(lake.manifest()).select(F.col("table").alias("partition_id"), "row_count")
    read = verify.count_partitions(replace(source, frame=lake.read(source)))
    result = read.withColumn("what", F.lit("read"))
    for what, counts in (("listed", listed), ("orphaned", orphaned)):
        result = result.unionByName(counts.withColumn("what", F.lit(what)))
    return result


@query(
    """select strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count,
      case when dayofmonth(ts) = 10 then 'r2' else 'r1' end as run_id
    from events group by 1, 3"""
)
def incremental_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """One day lacks rows at first; when they arrive, only that day is exported again."""
    events = base.table(spark, sf, "events")
    tenth = F.dayofmonth("ts") == 10
    missing = tenth & (F.col("event_type") == "signup")

    def source(df: DataFrame, modified) -> TableSource:
        return TableSource("logs", "events", df.withColumn("changed_at", modified), "ts", "changed_at")

    before = source(events.where(~missing), F.col("ts"))
    after = source(
        events, F.when(tenth, F.col("ts") + F.expr("INTERVAL 60 DAYS")).otherwise(F.col("ts"))
    )
    lake = Lake(spark, fresh_dir(spark, "two-runs"))
    lake.sync([before], "r1", "2024-02-01 00:00:00")
    lake.sync([after], "r2", "2024-02-02 00:00:00")
    counts = verify.count_partitions(replace(after, frame=lake.read(after)))
    runs = lake.ledgers.latest("partitions").select("partition_id", "run_id")
    return counts.join(runs, "partition_id")


@query(
    """
    select case when dayofmonth(o_orderdate) >= 15 then o_orderpriority end as o_orderpriority,
      count(*) as n, sum(cast(round(o_totalprice * 100) as bigint))::bigint as cents,
      min(o_orderkey) as first_key
    from orders group by 1"""
)
def sync_schema_change(spark: SparkSession, sf: str) -> DataFrame:
    """A column is added between two runs; days changed since then are read with it."""
    orders = base.table(spark, sf, "orders")
    touched = F.dayofmonth("o_orderdate") >= 15
    old = orders.drop("o_orderpriority").withColumn("changed_at", F.col("o_orderdate"))
    moved = F.col("o_orderdate") + F.expr("INTERVAL 3650 DAYS")
    new = orders.withColumn("changed_at", F.when(touched, moved).otherwise(F.col("o_orderdate")))
    lake = Lake(spark, fresh_dir(spark, "evolve"))
    latest = None
    for run, frame in (("r1", old), ("r2", new)):
        latest = TableSource("shop", "orders", frame, "o_orderdate", "changed_at")
        lake.sync([latest], run, f"2024-02-0{run[1]} 00:00:00", days=365)
    return lake.read(latest).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(base.cents("o_totalprice")).alias("cents"),
        F.min("o_orderkey").alias("first_key"),
    )


def _two_runs(spark: SparkSession, sf: str, label: str, first) -> tuple[Lake, TableSource]:
    """A lake of orders after two runs: all days as ``first`` makes them, then those from the 15th on."""
    orders = base.table(spark, sf, "orders")
    moved = F.col("o_orderdate") + F.expr("INTERVAL 3650 DAYS")
    changed = F.when(F.dayofmonth("o_orderdate") >= 15, moved).otherwise(F.col("o_orderdate"))
    frames = first(orders).withColumn("changed_at", F.col("o_orderdate")), orders.withColumn("changed_at", changed)
    lake = Lake(spark, fresh_dir(spark, label))
    for k, frame in enumerate(frames, 1):
        source = TableSource("shop", "orders", frame, "o_orderdate", "changed_at")
        lake.sync([source], f"r{k}", f"2024-02-0{k} 00:00:00", days=365)
    return lake, source


_BY_STATUS = """select o_orderstatus, count(*) as n, sum(o_orderkey)::bigint as keys,
  min(o_orderkey) as first_key from orders group by 1"""


def _by_status(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.min("o_orderkey").alias("first_key")
    )


@query(
    """select strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count, min(event_id) as first_event
    from events where dayofmonth(ts) % 2 = 0 group by 1"""
)
def export_scattered_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every other day is planned: as many ranges as days, and nothing between them is read."""
    events = base.events(spark, sf)
    plan = batches.label_batches(batches.assign_batches(discovery.discover(events), 7))
    even = plan.where(F.substring("partition_id", 7, 2).cast("int") % 2 == 0)
    rows = export.assign_rows(events, even)
    return rows.groupBy("partition_id").agg(F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_event"))


@query("""select 'shop' as dataset, 'orders' as "table", count(*) as row_count from orders""")
def totals_after_reexport(spark: SparkSession, sf: str) -> DataFrame:
    """Days exported twice count once."""
    lake, _ = _two_runs(spark, sf, "reexport", lambda orders: orders)
    return manifest.totals(lake.manifest()).select("dataset", "table", "row_count")


@query(_BY_STATUS)
def sync_type_widened(spark: SparkSession, sf: str) -> DataFrame:
    """INT became BIGINT: a version of its own, and all rows are read."""
    narrow = lambda orders: orders.withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    lake, source = _two_runs(spark, sf, "widened", narrow)
    return _by_status(lake.read(source))


@query(_BY_STATUS)
def ack_changes_read(spark: SparkSession, sf: str) -> DataFrame:
    """STRING became BIGINT, which breaks readers: they get BIGINT once that is acknowledged."""
    text = lambda orders: orders.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    lake, source = _two_runs(spark, sf, "acked", text)
    if dict(lake.read(source).dtypes)["o_orderkey"] != "string":
        raise RuntimeError("a breaking version is in force before it was acknowledged")
    lake.acknowledge("shop", "orders", 2, "2024-02-03 00:00:00")
    return _by_status(lake.read(source))


@query(
    """
    select 'logs' as dataset, 'events' as "table", 1 as schema_version,
      count(distinct cast(ts as date)) as partition_count, count(*) as total_rows from events
    union all
    select 'shop', 'customer', 1, 1, count(*) from customer
    union all
    select 'shop', 'orders', 1, count(distinct cast(o_orderdate as date)), count(*) from orders"""
)
def sync_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, fresh_dir(spark, "catalogue"))
    sources = [base.events(spark, sf), base.customer(spark, sf), base.orders(spark, sf)]
    lake.sync(sources, "r1", "2024-02-01 00:00:00", days=365)
    return lake.summary().select("dataset", "table", "schema_version", "partition_count", "total_rows")


@query(
    """select strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count,
      count(distinct event_id) as n_events from events group by 1"""
)
def stream_export(spark: SparkSession, sf: str) -> DataFrame:
    events = base.table(spark, sf, "events")
    root = fresh_dir(spark, "stream")
    events.repartitionByRange(6, "ts").write.parquet(f"{root}/arriving")
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 2)
        .parquet(f"{root}/arriving")
    )
    running = streaming.start_export(stream, "ts", f"{root}/out", f"{root}/checkpoint")
    running.awaitTermination()
    rows = streaming.read_exported(spark, f"{root}/out", events.schema)
    return rows.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("event_id").alias("n_events")
    )


# -- verification ------------------------------------------------------------------


@query(
    """
    with source as (
      select strftime(ts, '%Y%m%d') as partition_id, count(*) as n from events
      where dayofmonth(ts) <> 20 group by 1),
    exported as (
      select strftime(ts, '%Y%m%d') as partition_id, count(*) as n from events
      where dayofmonth(ts) <> 5 and not (dayofmonth(ts) = 9 and event_type = 'error') group by 1)
    select coalesce(s.partition_id, e.partition_id) as partition_id, s.n as source_rows,
      e.n as exported_rows, s.n is not distinct from e.n as matches
    from source s full join exported e on s.partition_id = e.partition_id"""
)
def verify_counts(spark: SparkSession, sf: str) -> DataFrame:
    events = base.table(spark, sf, "events")
    day = F.dayofmonth("ts")
    lost = (day == 5) | ((day == 9) & (F.col("event_type") == "error"))
    sides = [
        verify.count_partitions(TableSource("logs", "events", rows, "ts"))
        for rows in (events.where(day != 20), events.where(~lost))
    ]
    return verify.compare_counts(*sides)


@query(
    """
    select strftime(o_orderdate, '%Y%m%d') as partition_id, count(*) as source_rows,
      count(*) filter (o_orderstatus <> 'P') as exported_rows,
      count(*) filter (o_orderstatus = 'P') = 0 as matches
    from orders group by 1
    having ('0x' || substr(md5(strftime(o_orderdate, '%Y%m%d')), 1, 8))::bigint % 1000000 < 50000"""
)
def verify_sample(spark: SparkSession, sf: str) -> DataFrame:
    orders = base.table(spark, sf, "orders")
    counted = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("o_orderstatus") != "P").alias("kept")
    )
    days = counted.withColumn("partition_id", ids.partition_id(F.col("day")))
    source = days.select("partition_id", F.col("all").alias("row_count"))
    exported = days.select("partition_id", F.col("kept").alias("row_count"))
    return verify.compare_counts(verify.sampled(source, 0.05), verify.sampled(exported, 0.05))


@query(
    f"""
    with edited as (
      select * replace (case when dayofmonth(ts) = 5 and event_type = 'view' then value + 1 else value end as value)
      from events where dayofmonth(ts) <> 12),
    a as (select strftime(ts, '%Y%m%d') as partition_id, count(*) as n,
            {base.fingerprint_sql(base.EVENT_TEXT)} as fp from events group by 1),
    b as (select strftime(ts, '%Y%m%d') as partition_id, count(*) as n,
            {base.fingerprint_sql(base.EVENT_TEXT)} as fp from edited group by 1)
    select a.partition_id, a.n as source_rows, b.n as exported_rows,
      a.n is not distinct from b.n and a.fp is not distinct from b.fp as matches
    from a left join b on a.partition_id = b.partition_id"""
)
def verify_content(spark: SparkSession, sf: str) -> DataFrame:
    events = base.table(spark, sf, "events")
    day = F.dayofmonth("ts")
    bump = (day == 5) & (F.col("event_type") == "view")
    edited = events.where(day != 12).withColumn(
        "value", F.when(bump, F.col("value") + 1).otherwise(F.col("value"))
    )
    sides = [
        verify.fingerprint_by(base.event_content(df), F.to_date("ts"), base.EVENT_COLUMNS).withColumn(
            "partition_id", ids.partition_id(F.col("partition_id"))
        )
        for df in (events, edited)
    ]
    return verify.compare_content(*sides)


@query(
    """
    with copy as (
      select o_orderkey, o_orderstatus, o_orderpriority,
        cast(round(o_totalprice * 100) as bigint) + case when o_orderstatus = 'P' then 1 else 0 end as cents
      from orders where o_orderpriority <> '5-LOW'
      union all
      select o_orderkey, o_orderstatus, o_orderpriority, cast(round(o_totalprice * 100) as bigint)
      from orders where o_orderpriority = '1-URGENT'),
    a as (select o_orderkey, count(*) as n, min(cast(round(o_totalprice * 100) as bigint)) as cents from orders group by 1),
    b as (select o_orderkey, count(*) as n, max(cents) as cents from copy group by 1),
    j as (select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
      case when a.n > 1 or b.n > 1 then 'duplicate' when b.n is null then 'missing'
           when a.n is null then 'extra' when a.cents <> b.cents then 'changed' else 'same' end as status
      from a full join b on a.o_orderkey = b.o_orderkey)
    select o_orderkey, status, case when status = 'changed' then 'cents' else '' end as columns
    from j where status <> 'same'"""
)
def value_diff(spark: SparkSession, sf: str) -> DataFrame:
    orders = base.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", base.cents("o_totalprice").alias("cents")
    )
    raised = F.col("cents") + (F.col("o_orderstatus") == "P").cast("int")
    copy = orders.where("o_orderpriority <> '5-LOW'").withColumn("cents", raised)
    twice = copy.unionByName(orders.where("o_orderpriority = '1-URGENT'"))
    columns = ["o_orderstatus", "o_orderpriority", "cents"]
    return verify.value_diff(orders, twice, "o_orderkey", columns)



# -- runs that go on, tables that change in part ----------------------------------------


class _Stops(BaseException):
    """What ends a driver; a run cannot close itself then."""


class _StoppedLake(Lake):
    """A lake whose driver ends in the middle of the third table's export."""

    written = 0

    def _write(self, source: TableSource, plan: DataFrame, target: str, layout: export.Layout) -> None:
        self.written += 1
        if self.written < 3:
            return super()._write(source, plan, target, layout)
        super()._write(source, plan.where("batch_idx % 2 = 0"), target, layout)
        raise _Stops


@query(
    """
    select 'logs' as dataset, 'events' as "table", count(*) as read_rows, count(*) as listed_rows,
      count(distinct event_id) as n_keys, 1 as attempt from events
    union all
    select 'shop', 'customer', count(*), count(*), count(distinct c_custkey), 1 from customer
    union all
    select 'shop', 'orders', count(*), count(*), count(distinct o_orderkey), 2 from orders"""
)
def resume_after_crash(spark: SparkSession, sf: str) -> DataFrame:
    """A run dies in its third table. Started again, it writes that table only; each is present once."""
    root = fresh_dir(spark, "resumed")
    keys = {"events": "event_id", "customer": "c_custkey", "orders": "o_orderkey"}
    sources = [base.events(spark, sf), base.customer(spark, sf), base.orders(spark, sf)]
    starts = ["2024-02-01 00:00:00", "2024-02-01 06:00:00"]
    try:
        _StoppedLake(spark, root, at_once=1).sync(sources, "r1", starts[0], days=365)
    except _Stops:
        pass
    lake = Lake(spark, root)
    lake.sync(sources, "r1", starts[1], days=365)
    steps = Journal(spark, root, "r1").steps()
    listed = manifest.totals(lake.manifest()).select("dataset", "table", F.col("row_count").alias("listed_rows"))
    read = union_all(
        [
            lake.read(s).agg(
                F.lit(s.dataset).alias("dataset"),
                F.lit(s.table).alias("table"),
                F.count(F.lit(1)).alias("read_rows"),
                F.countDistinct(keys[s.table]).alias("n_keys"),
                F.lit(1 + starts.index(steps["written", s.name]["at"])).alias("attempt"),
            )
            for s in sources
        ]
    )
    return read.join(listed, ["dataset", "table"])


@query(
    """
    with shards as (
      select *, ('0x' || substr(md5(c_custkey::varchar), 1, 8))::bigint % 16 as shard,
        c_custkey % 1000 = 1 as edited from customer)
    select 'shard-00016-' || lpad(shard::varchar, 5, '0') as partition_id,
      case when shard = 3 then 0 else count(*) end as row_count,
      case when shard = 3 then 0 else count(*) end as read_rows,
      case when shard = 3 then 0 else sum(cast(round(c_acctbal * 100) as bigint) + edited::int)::bigint end as cents,
      case when shard = 3 or bool_or(edited) then 'r2' else 'r1' end as run_id
    from shards group by shard"""
)
def incremental_full_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table without partitions: between two runs some rows are edited and a shard loses all its rows.

    The second run writes the shards of the edited rows only, and retires the emptied one.
    """

    def source(df: DataFrame) -> TableSource:
        return TableSource("shop", "customer", df, shard_on="c_custkey", shards=16)

    cents = base.cents("c_acctbal")
    before = base.table(spark, sf, "customer").withColumn("cents", cents)
    edited = before.withColumn("cents", F.col("cents") + (F.col("c_custkey") % 1000 == 1).cast("int"))
    after = edited.where(hashing.hash_shard(F.col("c_custkey"), 16) != 3)
    lake = Lake(spark, fresh_dir(spark, "full-table"))
    lake.sync([source(before)], "r1", "2024-02-01 00:00:00")
    lake.sync([source(after)], "r2", "2024-02-02 00:00:00")
    now = source(after)
    read = lake.read(now).groupBy(now.partition_id().alias("partition_id"))
    read = read.agg(F.count(F.lit(1)).alias("read_rows"), F.sum("cents").alias("cents"))
    state = lake.ledgers.latest("partitions").select("partition_id", "row_count", "run_id")
    return state.join(read, "partition_id", "left").fillna(0, ["read_rows", "cents"])


@query(
    """
    with copy as (
      select event_id, cast(round(value * 100) as bigint)
          + case when dayofmonth(ts) = 5 and event_type = 'view' and event_id % 7 = 0 then 1 else 0 end as cents,
        event_type, user_id from events where not (dayofmonth(ts) = 9 and event_id % 11 = 0)
      union all
      select -event_id - 1, 0, event_type, user_id from events where dayofmonth(ts) = 3 and event_id % 50 = 0),
    j as (
      select coalesce(a.event_id, b.event_id) as event_id,
        case when b.event_id is null then 'missing' when a.event_id is null then 'extra'
             when cast(round(a.value * 100) as bigint) <> b.cents then 'changed' else 'same' end as status
      from events a full join copy b on a.event_id = b.event_id)
    select event_id, status, case when status = 'changed' then 'cents' else '' end as columns
    from j where status <> 'same'"""
)
def diff_by_digest_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Edited, lost and added rows of three days, found without reading the other days' rows again."""
    events = base.table(spark, sf, "events").select("ts", "event_id", base.cents("value").alias("cents"), "event_type", "user_id")
    day, number = F.dayofmonth("ts"), F.col("event_id")
    edit = (day == 5) & (F.col("event_type") == "view") & (number % 7 == 0)
    kept = events.where(~((day == 9) & (number % 11 == 0))).withColumn("cents", F.col("cents") + edit.cast("int"))
    added = events.where((day == 3) & (number % 50 == 0)).withColumns({"event_id": -number - 1, "cents": F.lit(0).cast("bigint")})
    source, copy = (TableSource("logs", "events", df, "ts") for df in (events, kept.unionByName(added)))
    return digests.value_diff(source, copy, "event_id", ["cents", "event_type", "user_id"])


# Fixed value: target of the planned files below, small enough that test tables need many.
_SMALL_FILE = 16_384


@query(
    f"""
    with recursive e as (
      select case when event_id % 3 = 0 then timestamp '2024-01-10 12:00:00' else ts end as ts,
        8 * ((event_id is not null)::int + 1 + (user_id is not null)::int + (value is not null)::int)
          + coalesce(strlen(event_type) + 2, 0) + coalesce(strlen(props) + 2, 0) as bytes from events),
    days as (select ts::date as d, count(*) as row_count, sum(bytes)::bigint as bytes from e group by 1),
    sized as (
      select *, (d - (select min(d) from days)) // 7 as b, ceil(bytes * (1.0::double / 3))::bigint as size,
        greatest(1, ceil(ceil(bytes * (1.0::double / 3)) / {_SMALL_FILE}))::int as pieces from days),
    small as (select *, row_number() over (partition by b order by size desc, d) as i from sized where pieces = 1),
    packed as (
      select distinct b, 0::bigint as i, []::bigint[] as free, 0 as bin from small
      union all
      select s.b, s.i,
        case when p.at = 0 then list_append(f.free, {_SMALL_FILE} - s.size)
          else list_transform(f.free, lambda x, j: case when j = p.at then x - s.size else x end) end,
        case when p.at = 0 then len(f.free) + 1 else p.at end
      from packed f join small s on s.b = f.b and s.i = f.i + 1,
        lateral (select coalesce(list_position(list_transform(f.free, lambda x: x >= s.size), true), 0) as at) p),
    placed as (
      select z.b, z.d, z.pieces, z.row_count, case when z.pieces = 1 then k.bin end as bin
      from sized z left join small s on s.d = z.d left join packed k on k.b = s.b and k.i = s.i),
    units as (select b, bin, case when bin is null then d end as d, max(pieces) as n from placed group by 1, 2, 3),
    numbered as (
      select *, coalesce(sum(n) over (order by b, bin nulls last, d rows between unbounded preceding and 1 preceding), 0)::int as first_file
      from units)
    select strftime(p.d, '%Y%m%d') as partition_id, p.pieces, n.first_file, p.row_count,
      p.row_count as listed_rows, p.pieces as n_files
    from placed p join numbered n on n.b = p.b and n.bin is not distinct from p.bin and (p.bin is not null or n.d = p.d)"""
)
def file_plan_by_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Files planned from bytes and written so: a day with a third of all rows is cut, small days share files."""
    frame = base.table(spark, sf, "events")
    hot = F.lit("2024-01-10 12:00:00").cast(frame.schema["ts"].dataType)
    frame = frame.withColumn("ts", F.when(F.col("event_id") % 3 == 0, hot).otherwise(F.col("ts")))
    source = TableSource("logs", "events", frame, "ts", cluster_by=("user_id",))
    root = fresh_dir(spark, "sized")
    lake = Lake(spark, root, export.Layout(target_bytes=_SMALL_FILE, smallest_bytes=1024))
    lake.sync([source], "r1", "2024-02-01 00:00:00", rules=[Rule("*", sized_files=True)])
    planned = spark.read.parquet(f"{root}/runs/r1/plan").select("partition_id", "pieces", "first_file")
    found = lake.written_files().groupBy("partition_id").agg(
        F.countDistinct("path").alias("n_files"), F.sum("row_count").alias("listed_rows")
    )
    read = lake.read(source).groupBy(source.partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("row_count"))
    return planned.join(found, "partition_id", "left").join(read, "partition_id", "left")


class _DiesSealing(Ledgers):
    """Ledgers whose driver ends after a compaction has written its bases, before it counts."""

    def _seal(self, generation: int) -> None:
        raise _Stops


@query(
    """
    select strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count, count(*) as read_rows,
      case when max(ts) < timestamp '2024-01-10 00:00:00' then 'r1'
        when max(ts) < timestamp '2024-01-20 00:00:00' then 'r2' else 'r3' end as run_id,
      case when dayofmonth(max(ts)) in (10, 20) then 2 else 1 end as history_rows, 2 as generation
    from events group by 1"""
)
def ledger_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs, a compaction after the first that dies half way, and one after each of the others."""
    root = fresh_dir(spark, "compacted")
    lake = Lake(spark, root)

    def source(until: str | None) -> TableSource:
        frame = base.table(spark, sf, "events")
        if until is not None:
            frame = frame.where(F.col("ts") < F.lit(until).cast(frame.schema["ts"].dataType))
        return TableSource("logs", "events", frame, "ts", "ts")

    lake.sync([source("2024-01-10 12:00:00")], "r1", "2024-02-01 00:00:00")
    try:
        _DiesSealing(spark, root).compact()
    except _Stops:
        pass
    lake.sync([source("2024-01-20 12:00:00")], "r2", "2024-02-02 00:00:00")
    lake.compact()
    lake.sync([source(None)], "r3", "2024-02-03 00:00:00")
    lake.compact()
    key = ["dataset", "table", "partition_id"]
    state = lake.ledgers.latest("partitions").select(*key, "row_count", "run_id")
    history = lake.ledgers.read("partitions").groupBy(*key).agg(F.count(F.lit(1)).alias("history_rows"))
    now = source(None)
    read = lake.read(now).groupBy(now.partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("read_rows"))
    number = F.lit(lake.ledgers.generation()).alias("generation")
    return state.join(history, key).join(read, "partition_id").select("*", number).drop("dataset", "table")


def _sketched_events(spark: SparkSession, sf: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Events exported and sketched in two runs, the second with a day exported again: sketches and rows by week."""
    frame = base.table(spark, sf, "events")
    first = frame.where(F.col("ts") < F.lit("2024-01-12 12:00:00").cast(frame.schema["ts"].dataType))
    lake = Lake(spark, fresh_dir(spark, "sketched"))
    for run, rows in enumerate([first, frame], 1):
        source = TableSource("logs", "events", rows, "ts", "ts")
        lake.sync([source], f"r{run}", f"2024-02-0{run} 00:00:00")
        lake.sketch(source, columns)
    day = F.to_date("partition_id", "yyyyMMdd")
    week = F.date_format(F.date_trunc("week", day), "yyyyMMdd")
    return lake.sketches(source).withColumn("week", week), frame.withColumn("week", F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd"))


@query(
    """
    with w as (select strftime(date_trunc('week', ts), '%Y%m%d') as week, event_id, user_id, event_type from events)
    select week, "column", count(*) as row_count, count(*) - count(v) as nulls, count(distinct v) as exact, true as within
    from (select week, 'event_id' as "column", event_id::varchar as v from w
      union all select week, 'user_id', user_id::varchar from w
      union all select week, 'event_type', event_type from w)
    group by 1, 2"""
)
def distinct_by_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct counts by week from sketches of days, each within four standard errors of the exact count."""
    columns = ["event_id", "user_id", "event_type"]
    sketched, rows = _sketched_events(spark, sf, columns)
    counted = sketches.distinct_counts(sketched, ["week"])
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns]))
    exact = rows.select("week", values).groupBy("week", "column").agg(F.countDistinct("v").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact")) <= 4 * sketches.DISTINCT_ERROR * F.col("exact") + 0.5
    return counted.join(exact, ["week", "column"]).withColumn("within", off).drop("n_distinct")


@query(
    """
    select strftime(date_trunc('week', ts), '%Y%m%d') as week, fraction, count(value) as n, true as within
    from events, (values (0.5::double), (0.9::double), (0.99::double)) f(fraction) group by 1, 2"""
)
def duration_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles by week from sketches of days; the share of rows up to each is within twice the rank error."""
    sketched, rows = _sketched_events(spark, sf, ["value"])
    found = sketches.quantiles(sketched, ["week"], [0.5, 0.9, 0.99]).drop("column")
    met = rows.select("week", F.col("value").alias("v")).join(found, "week").groupBy("week", "fraction", "n")
    slack = F.lit(2 * sketches.RANK_ERROR)
    below = F.count_if(F.col("v") < F.col("value")) / F.col("n") <= F.col("fraction") + slack
    upto = F.count_if(F.col("v") <= F.col("value")) / F.col("n") >= F.col("fraction") - slack
    return met.agg((below & upto).alias("within"))


@query(
    """
    with e as (select event_id, strftime(ts, '%Y%m%d') as partition_id, max(event_id) over () as last from events)
    select 'bounds' as looked_up, partition_id, count(*) as n_rows, sum(event_id)::bigint as ids, true as skipped
    from e where event_id between last // 3 and last // 3 + last // 10 group by 2
    union all
    select 'values', partition_id, count(*), sum(event_id)::bigint, true
    from e where event_id in (0, last // 7, last // 2, last) group by 2"""
)
def skip_by_zone_map(spark: SparkSession, sf: str) -> DataFrame:
    """Look-ups by range and by value read only files whose bounds and filters allow them; rows are those of a full read."""
    source = base.events(spark, sf)
    lake = Lake(spark, fresh_dir(spark, "zones"))
    lake.sync([source], "r1", "2024-02-01 00:00:00", days=2)
    lake.map_zones(source, ["event_id", "event_type"], filtered=["event_id"])
    last = source.frame.agg(F.max("event_id")).first()[0]
    needs = {
        "bounds": zonemaps.Need("event_id", low=last // 3, high=last // 3 + last // 10),
        "values": zonemaps.Need("event_id", values=(0, last // 7, last // 2, last)),
    }
    listed = lake.published().count()
    out = []
    for name, need in needs.items():
        rows = lake.read_where(source, need).groupBy(source.partition_id().alias("partition_id"))
        fewer = lake.files_for(source, need).count() < listed
        counted = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("ids"))
        out.append(counted.withColumns({"looked_up": F.lit(name), "skipped": F.lit(fewer)}))
    return union_all(out)
