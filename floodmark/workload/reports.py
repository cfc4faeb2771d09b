"""Queries on runs, tables, counters, durations and generated data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.functions import ids
from floodmark.operators import discovery, keyed, ledger, report
from floodmark.sources import synthetic
from floodmark.workload import base
from floodmark.workload.base import query

_SUMMARY = """
with tables as (
  select c_mktsegment as dataset, 'c' || c_custkey as "table" from customer),
partitions as (
  select c.c_mktsegment as dataset, 'c' || o.o_custkey as "table", o.o_orderkey as partition_id,
    1 as row_count, cast(round(o.o_totalprice * 100) as bigint) as bytes
  from orders o join customer c on c.c_custkey = o.o_custkey),
summary as (
  select t.dataset, t."table", count(p.partition_id) as partition_count,
    coalesce(sum(p.row_count), 0)::bigint as total_rows, coalesce(sum(p.bytes), 0)::bigint as total_bytes
  from tables t left join partitions p on p.dataset = t.dataset and p."table" = t."table"
  group by 1, 2)"""


def _table_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as tables, their orders as partitions."""
    customers = base.table(spark, sf, "customer")
    name = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    tables = customers.select(F.col("c_mktsegment").alias("dataset"), name.alias("table"))
    segments = customers.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = base.table(spark, sf, "orders")
    partitions = orders.join(segments, "o_custkey").select(
        F.col("c_mktsegment").alias("dataset"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("table"),
        F.col("o_orderkey").alias("partition_id"),
        F.lit(1).alias("row_count"),
        base.cents("o_totalprice").alias("bytes"),
    )
    return report.summary(tables, partitions)


@query(f"{_SUMMARY} select * from summary")
def summary(spark: SparkSession, sf: str) -> DataFrame:
    return _table_summary(spark, sf)


@query(
    f"""{_SUMMARY}
    select * from summary
    qualify row_number() over (partition by dataset order by total_bytes desc, "table" desc) = 1"""
)
def catalogue_top(spark: SparkSession, sf: str) -> DataFrame:
    top = keyed.latest_per_key(_table_summary(spark, sf), ["dataset"], ["total_bytes", "table"])
    return report.in_display_order(top)


@query(
    """
    select 'shop' as dataset, 'orders' as "table", strftime(o_orderdate, '%Y%m%d') as partition_id,
      count(*) as total_rows
    from orders group by 3"""
)
def table_detail(spark: SparkSession, sf: str) -> DataFrame:
    sources = [base.events(spark, sf), base.orders(spark, sf), base.customer(spark, sf)]
    parts = discovery.discover_all(sources).select("dataset", "table", "partition_id", "total_rows")
    versions = parts.select("dataset", "table", F.lit(1).alias("version"))
    return report.table_detail(versions, parts, "shop", "orders")[1]


_NOW = "2024-02-01 00:00:00"


@query(
    f"""
    with parts as (select strftime(ts, '%Y%m%d') as partition_id, max(ts) as synced_at from events group by 1)
    select partition_id, synced_at,
      cast(floor((epoch_us(timestamp '{_NOW}') - epoch_us(synced_at)) / 1000000) as bigint) as lag_seconds
    from parts"""
)
def lag_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    parts = discovery.discover(base.events(spark, sf))
    synced = parts.select("partition_id", F.col("last_modified").alias("synced_at"))
    return report.lag(synced, "synced_at", F.lit(_NOW).cast("timestamp_ntz"))


_TASKS = """
with tasks as (
  select l_orderkey::varchar as run_id, 'd' || l_linenumber as dataset, l_linestatus as "table",
    case l_returnflag when 'A' then 'completed' when 'N' then 'running' else 'failed' end as state,
    l_quantity::bigint as rows, cast(round(l_extendedprice * 100) as bigint) as stored_bytes,
    l_shipdate as "at"
  from lineitem)"""


def _tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as tasks, their orders as runs."""
    flag = F.col("l_returnflag")
    return base.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.concat(F.lit("d"), F.col("l_linenumber").cast("string")).alias("dataset"),
        F.col("l_linestatus").alias("table"),
        F.when(flag == "A", "completed").when(flag == "N", "running").otherwise("failed").alias("state"),
        F.col("l_quantity").cast("bigint").alias("rows"),
        base.cents("l_extendedprice").alias("stored_bytes"),
        F.col("l_shipdate").alias("at"),
    )


@query(
    f"""{_TASKS}
    select dataset, "table", state, count(*) as n_tasks, sum(rows)::bigint as rows_extracted,
      sum(stored_bytes)::bigint as bytes_stored
    from tasks group by 1, 2, 3"""
)
def counters(spark: SparkSession, sf: str) -> DataFrame:
    return report.counters(_tasks(spark, sf))


@query(
    f"""{_TASKS}
    select run_id, count(*) as total_tasks, count(*) filter (state = 'completed') as completed_tasks,
      count(*) filter (state = 'failed') as failed_tasks,
      case when count(*) filter (state = 'completed') = count(*) then 'completed'
           when count(*) filter (state = 'completed') > 0 then 'partial' else 'failed' end as run_state
    from tasks group by 1"""
)
def run_totals(spark: SparkSession, sf: str) -> DataFrame:
    return report.run_totals(_tasks(spark, sf))


@query(f"""{_TASKS} select run_id, "table", rows from tasks where state = 'failed'""")
def tasks_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.by_state(_tasks(spark, sf), "failed").select("run_id", "table", "rows")


_RUNS = """
runs as (
  select o_orderkey::varchar as run_id, 'running' as state, o_orderdate as "at", o_orderdate as started_at
  from orders
  union all
  select o.o_orderkey::varchar, 'completed', l.l_shipdate, o.o_orderdate
  from lineitem l join orders o on o.o_orderkey = l.l_orderkey
  where l.l_returnflag = 'R' and l.l_shipdate >= o.o_orderdate),
latest as (
  select * from runs
  qualify row_number() over (partition by run_id order by "at" desc, (state <> 'running') desc, state desc) = 1),
stale as (
  select * from latest
  where state = 'running' and started_at < timestamp '1998-01-01 00:00:00' - interval 24 hour)"""


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """An opening row per order and a closing row per returned item shipped later.

    Items are reduced to their last shipment per order, which is all that can become the
    latest row of a run.
    """
    orders = base.table(spark, sf, "orders")
    run_id = F.col("o_orderkey").cast("string").alias("run_id")
    opened = orders.select(
        run_id, F.lit("running").alias("state"), F.col("o_orderdate").alias("at"),
        F.col("o_orderdate").alias("started_at"),
    )
    shipped = (
        base.table(spark, sf, "lineitem")
        .where("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("at"))
    )
    closed = (
        shipped.join(orders.select("o_orderkey", "o_orderdate"), "o_orderkey")
        .where(F.col("at") >= F.col("o_orderdate"))
        .select(run_id, F.lit("completed").alias("state"), "at", F.col("o_orderdate").alias("started_at"))
    )
    return opened.unionByName(closed)


_STALE_AT = "1998-01-01 00:00:00"


@query(f"with {_RUNS} select * from stale")
def stale_runs(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.stale_runs(_runs(spark, sf), F.lit(_STALE_AT).cast("timestamp_ntz"))


@query(
    f"""{_TASKS}, {_RUNS}
    select state, count(*) as n, sum(rows)::bigint as n_rows from tasks
    where run_id not in (select run_id from stale) group by 1"""
)
def purge_stale_tasks(spark: SparkSession, sf: str) -> DataFrame:
    stale = ledger.stale_runs(_runs(spark, sf), F.lit(_STALE_AT).cast("timestamp_ntz"))
    kept = ledger.without_runs(_tasks(spark, sf), stale)
    return kept.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("n_rows"))


_BOUNDS = ", ".join(f"({b}::double)" for b in report.DURATION_BOUNDS)


@query(
    f"""
    with bounds(le) as (values {_BOUNDS}, ('inf'::double)),
    types as (select distinct event_type from events)
    select t.event_type, b.le,
      (select count(*) from events e where e.event_type = t.event_type and e.value <= b.le) as cumulative_count
    from types t, bounds b"""
)
def duration_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return report.duration_histogram(base.table(spark, sf, "events"), "value", ["event_type"])


@query(
    """
    with log as (
      select event_type as source, case event_type
          when 'view' then 'quota exceeded, timeout for ' || props
          when 'click' then 'permission denied for ' || props
          when 'purchase' then 'dial: connection refused ' || props
          when 'signup' then case when value > 10 then 'context deadline exceeded'
                                  else 'i/o timeout' end
          else 'Quota ' || props end as message
      from events
      union all select lang, text from documents
      union all select 'page', html from pages
      union all select role, text from conversations)
    select source, case when contains(message, 'quota') then 'quota'
        when contains(message, 'unauthenticated') or contains(message, 'permission') then 'auth'
        when contains(message, 'connection refused') or contains(message, 'no such host') then 'store_unavailable'
        when contains(message, 'timeout') or contains(message, 'deadline') then 'transient'
        else 'unknown' end as error_class, count(*) as n_errors
    from log group by 1, 2"""
)
def error_classes(spark: SparkSession, sf: str) -> DataFrame:
    kind, props = F.col("event_type"), F.col("props")
    message = (
        F.when(kind == "view", F.concat(F.lit("quota exceeded, timeout for "), props))
        .when(kind == "click", F.concat(F.lit("permission denied for "), props))
        .when(kind == "purchase", F.concat(F.lit("dial: connection refused "), props))
        .when(
            kind == "signup",
            F.when(F.col("value") > 10, "context deadline exceeded").otherwise("i/o timeout"),
        )
        .otherwise(F.concat(F.lit("Quota "), props))
    )
    log = base.table(spark, sf, "events").select(kind.alias("source"), message.alias("message"))
    for name, source, text in (
        ("documents", F.col("lang"), "text"),
        ("pages", F.lit("page"), "html"),
        ("conversations", F.col("role"), "text"),
    ):
        texts = base.table(spark, sf, name).select(source.alias("source"), F.col(text).alias("message"))
        log = log.unionByName(texts)
    return report.error_classes(log, "message", ["source"])


@query(
    """
    with typed as (select strftime(ts, '%Y%m%d') as day, event_type, user_id, value from events)
    select day, event_type, cast(grouping(day) * 2 + grouping(event_type) as bigint) as level,
      count(*) as n, count(distinct user_id) as n_users,
      sum(cast(round(value * 100) as bigint))::bigint as cents
    from typed group by rollup (day, event_type)"""
)
def daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    typed = base.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    rolled = report.rollup(
        typed,
        ["day", "event_type"],
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("user_id").alias("n_users"),
        F.sum(base.cents("value")).alias("cents"),
    )
    return rolled.withColumn("day", F.date_format("day", "yyyyMMdd"))


@query(
    """
    select lang, source, sum(strlen(text))::bigint as raw_bytes,
      sum(case when lang = 'en' then n_chars // 3 else 0 end)::bigint as stored_bytes,
      sum(strlen(text))::double / nullif(sum(case when lang = 'en' then n_chars // 3 else 0 end), 0)::double as ratio
    from documents group by 1, 2"""
)
def ratio_by_table(spark: SparkSession, sf: str) -> DataFrame:
    stored = F.when(F.col("lang") == "en", F.floor(F.col("n_chars") / 3)).otherwise(0).cast("bigint")
    sizes = base.table(spark, sf, "documents").select(
        "lang", "source", F.octet_length("text").cast("bigint").alias("raw"), stored.alias("stored")
    )
    return report.compression_ratio(sizes, "raw", "stored", ["lang", "source"])


def _draw_sql(label: str, upper: int) -> str:
    return f"('0x' || substr(md5(seed || ':{label}'), 1, 8))::bigint % {upper + 1}"


@query(
    f"""
    with seeds as (
      select c_custkey::varchar || '-' || n as seed
      from customer, unnest(range(1, 11)) as r(n))
    select md5(seed) as event_id,
      timestamp '2026-01-01' + ({_draw_sql('minute', synthetic.MINUTES_PER_YEAR)}) * interval 1 minute as event_timestamp,
      'user_' || ({_draw_sql('user', 1000)}) as user_id,
      case {_draw_sql('type', 5)} when 0 then 'page_view' when 1 then 'click' when 2 then 'purchase'
        when 3 then 'signup' when 4 then 'logout' else 'other' end as event_type,
      round(({_draw_sql('amount', 100_000)})::double / 100, 2) as amount,
      'page_' || ({_draw_sql('page', 50)}) as page
    from seeds"""
)
def synthetic_events(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.events(base.table(spark, sf, "customer"), "c_custkey", 10)


@query(
    f"""
    with seeds as (select c_custkey::varchar as seed from customer)
    select 'user_' || seed as user_id, 'User ' || seed as full_name,
      'user' || seed || '@example.com' as email,
      timestamp '2025-01-01' + ({_draw_sql('day', 365)}) * interval 1 day as created_at,
      case {_draw_sql('plan', 3)} when 0 then 'free' when 1 then 'pro' else 'enterprise' end as plan
    from seeds"""
)
def synthetic_users(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.users(base.table(spark, sf, "customer"), "c_custkey")


@query(
    """
    select 'dataset=' || lang || '/table=' || source || '/schema_version=v' || (n_chars % 3 + 1) || '/' ||
      strftime(timestamp '2024-01-01' + doc_id * interval 1 hour, '%Y%m%d') || '_full' as path,
      strftime(timestamp '2024-01-01' + doc_id * interval 1 hour, '%Y-%m-%dT%H:%M:%SZ') as exported_at,
      doc_id
    from documents"""
)
def export_paths(spark: SparkSession, sf: str) -> DataFrame:
    docs = base.table(spark, sf, "documents")
    at = F.timestamp_add("HOUR", F.col("doc_id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    leaf = ids.batch_label(ids.partition_id(F.to_date(at)), F.lit(ids.FULL))
    path = ids.export_path(F.col("lang"), F.col("source"), F.col("n_chars") % 3 + 1, leaf)
    return docs.select(path.alias("path"), ids.rfc3339(at).alias("exported_at"), "doc_id")
