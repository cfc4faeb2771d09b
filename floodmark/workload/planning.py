"""Queries on discovery, batch plans, incremental selection and as-of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.functions import ids
from floodmark.operators import asof, batches, discovery, incremental, keyed, ledger, verify
from floodmark.sources.tables import scan_partition
from floodmark.workload import base
from floodmark.workload.base import query

PARTS = ["dataset", "table", "partition_id", "total_rows", "last_modified"]


@query(
    """select strftime(ts, '%Y%m%d') as partition_id, count(*) as total_rows, max(ts) as last_modified
    from events group by 1"""
)
def discover_partitions(spark: SparkSession, sf: str) -> DataFrame:
    found = discovery.discover(base.events(spark, sf))
    return found.select("partition_id", "total_rows", "last_modified")


@query(
    """select strftime(ts, '%Y%m%d') as partition_id,
      sum(36 + strlen(event_type) + strlen(props))::bigint as total_logical_bytes
    from events group by 1"""
)
def discover_logical_bytes(spark: SparkSession, sf: str) -> DataFrame:
    found = discovery.discover(base.events(spark, sf), with_bytes=True)
    return found.select("partition_id", "total_logical_bytes")


@query(
    """
    select 'logs' as dataset, 'events' as "table", strftime(ts, '%Y%m%d') as partition_id,
           count(*) as total_rows, max(ts) as last_modified from events group by 3
    union all
    select 'shop', 'orders', strftime(o_orderdate, '%Y%m%d'), count(*), max(o_orderdate)
    from orders group by 3
    union all
    select 'shop', 'lineitem', strftime(l_shipdate, '%Y%m%d'), count(*), max(l_shipdate)
    from lineitem group by 3
    union all
    select 'shop', 'customer', 'full', count(*), cast(null as timestamp) from customer
    union all
    select 'text', 'documents', 'full', count(*), cast(null as timestamp) from documents"""
)
def discover_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    sources = [f(spark, sf) for f in (base.events, base.orders, base.lineitem, base.customer, base.documents)]
    return discovery.discover_all(sources).select(*PARTS)


@query(
    """
    select 'logs' as dataset, 'events' as "table", strftime(ts, '%Y%m%d') as partition_id,
           count(*) as total_rows, max(ts) as last_modified from events group by 3
    having max(ts) > timestamp '2001-01-01'
    union all
    select 'shop', 'lineitem', strftime(l_shipdate, '%Y%m%d'), count(*), max(l_shipdate)
    from lineitem group by 3 having max(l_shipdate) > timestamp '2001-01-01'"""
)
def discover_modified_since(spark: SparkSession, sf: str) -> DataFrame:
    since = F.lit("2001-01-01").cast("timestamp_ntz")
    sources = [base.events(spark, sf), base.lineitem(spark, sf)]
    return discovery.discover_all(sources, modified_since=since).select(*PARTS)


@query(
    """select event_type, min(ts) as first_ts, max(ts) as last_ts, count(*) as total_rows,
      count(distinct cast(ts as date)) as partition_count
    from events group by 1"""
)
def time_range(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.time_range(base.table(spark, sf, "events"), "ts", "event_type")


@query(
    """select event_type, count(*) as n, sum(cast(round(value * 100) as bigint))::bigint as cents
    from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11' group by 1"""
)
def scan_one_partition(spark: SparkSession, sf: str) -> DataFrame:
    rows = scan_partition(base.events(spark, sf), "20240110")
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(base.cents("value")).alias("cents")
    )


@query(
    """
    with parts as (
      select strftime(ts, '%Y%m%d') as pid, cast(ts as date) as d, count(*) as n
      from events group by 1, 2)
    select date_diff('day', (select min(d) from parts), d) // 7 as batch_idx,
      min(pid) as start_pid, max(pid) as end_pid, count(*) as n_partitions, sum(n)::bigint as total_rows
    from parts group by 1"""
)
def batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    plan = batches.plan_batches(discovery.discover(base.events(spark, sf)))
    return plan.drop("dataset", "table")


@query(
    """
    with parts as (
      select strftime(o_orderdate, '%Y%m%d') as pid, cast(o_orderdate as date) as d, count(*) as n
      from orders group by 1, 2)
    select date_diff('day', (select min(d) from parts), d) // 30 as batch_idx,
      min(pid) as start_pid, max(pid) as end_pid, count(*) as n_partitions, sum(n)::bigint as total_rows
    from parts group by 1"""
)
def batch_plan_orders(spark: SparkSession, sf: str) -> DataFrame:
    plan = batches.plan_batches(discovery.discover(base.orders(spark, sf)), days=30)
    return plan.drop("dataset", "table")


# Orders again, with ids that are not days between the first and the last day of
# table `mixed`, and with null days at the end of table `nulls`.
_ODD_IDS = """
odd as (
  select 'shop' as dataset, 'mixed' as "table",
    case when o_orderdate >= timestamp '2001-01-01' then strftime(o_orderdate, '%Y%m%d')
         when o_orderpriority = '1-URGENT' then strftime(o_orderdate, '%Y%m%d') || '12'
         when o_orderpriority = '2-HIGH' then strftime(o_orderdate, '%Y') || '0230'
         else strftime(o_orderdate, '%Y%m%d') end as partition_id, 1 as n
  from orders
  union all
  select 'shop', 'nulls',
    case when o_orderstatus = 'P' then '__NULL__' else strftime(o_orderdate, '%Y%m%d') end, 1
  from orders
  union all
  select 'shop', 'customer', 'full', 1 from customer)"""


def _odd_parts(spark: SparkSession, sf: str) -> DataFrame:
    orders = base.table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    late = F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    odd = (
        F.when(late, day)
        .when(F.col("o_orderpriority") == "1-URGENT", F.concat(day, F.lit("12")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.substring(day, 1, 4), F.lit("0230")))
        .otherwise(day)
    )
    nulls = F.when(F.col("o_orderstatus") == "P", ids.NULL_PARTITION).otherwise(day)
    frames = [
        orders.select(F.lit("mixed").alias("table"), odd.alias("partition_id")),
        orders.select(F.lit("nulls").alias("table"), nulls.alias("partition_id")),
        base.table(spark, sf, "customer").select(
            F.lit("customer").alias("table"), F.lit(ids.FULL).alias("partition_id")
        ),
    ]
    rows = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return (
        rows.groupBy("table", "partition_id")
        .agg(F.count(F.lit(1)).alias("total_rows"))
        .withColumn("dataset", F.lit("shop"))
    )


@query(
    f"""
    with {_ODD_IDS},
    parts as (
      select dataset, "table", partition_id, count(*) as total_rows,
        case when regexp_full_match(partition_id, '[0-9]{{8}}')
             then try_strptime(partition_id, '%Y%m%d')::date end as d
      from odd group by 1, 2, 3),
    edges as (
      select dataset, "table", arg_min(d, partition_id) as lo_d,
        min(partition_id) as lo, max(partition_id) as hi
      from parts group by 1, 2),
    bounds as (
      select e.dataset, e."table", l.d as first_day, h.d as last_day
      from edges e
      join parts l on l.dataset = e.dataset and l."table" = e."table" and l.partition_id = e.lo
      join parts h on h.dataset = e.dataset and h."table" = e."table" and h.partition_id = e.hi)
    select p.dataset, p."table",
      cast(case when b.first_day is null or b.last_day is null then 0
           when p.d is null then -1
           else date_diff('day', b.first_day, p.d) // 30 end as bigint) as batch_idx,
      min(p.partition_id) as start_pid, max(p.partition_id) as end_pid,
      count(*) as n_partitions, sum(p.total_rows)::bigint as total_rows
    from parts p join bounds b on p.dataset = b.dataset and p."table" = b."table"
    group by 1, 2, 3"""
)
def batch_plan_odd_ids(spark: SparkSession, sf: str) -> DataFrame:
    return batches.plan_batches(_odd_parts(spark, sf), days=30)


@query(
    """
    with named as (
      select case o_orderpriority
          when '1-URGENT' then strftime(o_orderdate, '%Y%m%d')
          when '2-HIGH' then strftime(o_orderdate, '%Y%m%d') || '05'
          when '3-MEDIUM' then strftime(o_orderdate, '%Y') || '0230'
          when '5-LOW' then strftime(o_orderdate, '%Y%m')
          else '__NULL__' end as pid
      from orders)
    select pid, count(*) as n,
      case when regexp_full_match(pid, '[0-9]{8}')
           then strftime(try_strptime(pid, '%Y%m%d'), '%Y-%m-%d') end as day_text,
      case when length(pid) = 8
           then substr(pid, 1, 4) || '-' || substr(pid, 5, 2) || '-' || substr(pid, 7, 2) end as date_text
    from named group by 1"""
)
def partition_id_parse(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    priority = F.col("o_orderpriority")
    pid = (
        F.when(priority == "1-URGENT", day)
        .when(priority == "2-HIGH", F.concat(day, F.lit("05")))
        .when(priority == "3-MEDIUM", F.concat(F.substring(day, 1, 4), F.lit("0230")))
        .when(priority == "5-LOW", F.substring(day, 1, 6))
        .otherwise(ids.NULL_PARTITION)
    )
    counted = base.table(spark, sf, "orders").groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "pid",
        "n",
        ids.partition_day(F.col("pid")).cast("string").alias("day_text"),
        ids.partition_date_text(F.col("pid")).alias("date_text"),
    )


@query(
    """
    with named as (
      select case lang when 'en' then source || '.' || lang when 'fr' then source || '.' || lang || '.x'
                  else source end as name
      from documents)
    select case when contains(name, '.') then split_part(name, '.', 1) end as dataset,
      case when contains(name, '.') then substr(name, strpos(name, '.') + 1) end as "table",
      count(*) as n
    from named group by 1, 2"""
)
def table_name_split(spark: SparkSession, sf: str) -> DataFrame:
    lang = F.col("lang")
    name = (
        F.when(lang == "en", F.concat_ws(".", "source", "lang"))
        .when(lang == "fr", F.concat_ws(".", "source", "lang", F.lit("x")))
        .otherwise(F.col("source"))
    )
    parts = ids.table_parts(name)
    return (
        base.table(spark, sf, "documents")
        .groupBy(parts["dataset"].alias("dataset"), parts["table"].alias("table"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


_MARKS = f"""
with {base.SHIPPED_PARTS}, {base.EVENT_PARTS},
parts as (
  select * from shipped union all select * from event_parts union all
  select 'shop', 'customer', 'full', count(*), cast(null as timestamp) from customer),
marks as (
  select dataset, "table", max(last_modified) - interval 10 day as watermark from parts group by 1, 2)"""


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    sources = [base.shipped_orders(spark, sf), base.events(spark, sf), base.customer(spark, sf)]
    return discovery.discover_all(sources).select(*PARTS)


@query(
    f"""{_MARKS}
    select p.* from parts p join marks m on p.dataset = m.dataset and p."table" = m."table"
    where m.watermark is null or p.last_modified is null or p.last_modified > m.watermark"""
)
def changed_since_watermark(spark: SparkSession, sf: str) -> DataFrame:
    parts = _parts(spark, sf)
    marks = parts.groupBy("dataset", "table").agg(
        (F.max("last_modified") - F.expr("INTERVAL 10 DAYS")).alias("watermark")
    )
    return incremental.changed_since(parts, marks)


@query(
    f"""{_MARKS},
    outcome as (select *, not (substr(partition_id, 7, 2) = '17') as committed from parts),
    per_table as (
      select dataset, "table",
        max(last_modified) filter (committed) as reached,
        min(last_modified) filter (not committed) as missed
      from outcome group by 1, 2)
    select dataset, "table",
      case when reached is null then null
           when missed is null then reached
           else least(reached, missed - interval 1 microsecond) end as watermark
    from per_table"""
)
def advance_watermark(spark: SparkSession, sf: str) -> DataFrame:
    failed = F.substring("partition_id", 7, 2) == "17"
    return incremental.advance_watermark(_parts(spark, sf).withColumn("committed", ~failed))


_STATE = f"""
with {base.SHIPPED_PARTS},
state as (
  select strftime(o.o_orderdate, '%Y%m%d') as partition_id,
    max(l.shipped) as exported_modified,
    case when max(o.o_orderpriority) = '1-URGENT' then '' else
      'orders/' || strftime(o.o_orderdate, '%Y%m%d') || '.parquet' end as exported_path
  from orders o
  join (select l_orderkey, max(l_shipdate) as shipped from lineitem where l_returnflag <> 'R' group by 1) l
    on l.l_orderkey = o.o_orderkey
  group by strftime(o.o_orderdate, '%Y%m%d')),
inventory as (
  select distinct 'orders/' || strftime(o_orderdate, '%Y%m%d') || '.parquet' as path
  from orders where o_orderstatus = 'F')"""


def _state(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Earlier exports: made before the returned items shipped, some with their file gone."""
    shipped = (
        base.table(spark, sf, "lineitem")
        .where(F.col("l_returnflag") != "R")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )
    orders = base.table(spark, sf, "orders")
    grouped = (
        orders.join(shipped, "o_orderkey")
        .groupBy(F.to_date("o_orderdate").alias("day"))
        .agg(F.max("shipped").alias("exported_modified"), F.max("o_orderpriority").alias("top"))
    )
    pid = ids.partition_id(F.col("day"))
    path = F.concat(F.lit("orders/"), pid, F.lit(".parquet"))
    state = grouped.select(
        F.lit("shop").alias("dataset"),
        F.lit("orders").alias("table"),
        pid.alias("partition_id"),
        "exported_modified",
        F.when(F.col("top") == "1-URGENT", "").otherwise(path).alias("exported_path"),
    )
    stored = (
        orders.where(F.col("o_orderstatus") == "F")
        .select(F.to_date("o_orderdate").alias("day"))
        .distinct()
        .select(path.alias("path"))
    )
    return state, stored


@query(
    f"""{_STATE}
    select p.partition_id, p.total_rows, p.last_modified from shipped p
    where not exists (
      select 1 from state s join inventory i on i.path = s.exported_path
      where s.partition_id = p.partition_id and s.exported_path <> ''
        and p.last_modified <= s.exported_modified)"""
)
def skip_exported(spark: SparkSession, sf: str) -> DataFrame:
    parts = discovery.discover(base.shipped_orders(spark, sf)).select(*PARTS)
    state, stored = _state(spark, sf)
    kept = incremental.skip_exported(parts, state, stored)
    return kept.select("partition_id", "total_rows", "last_modified")


@query(
    f"""{_STATE}
    select p.partition_id, p.total_rows, coalesce(s.schema_version, 1) as schema_version,
      coalesce(s.exported_path, '') as exported_path
    from shipped p left join (select *, 2 as schema_version from state) s
      on s.partition_id = p.partition_id"""
)
def partition_lookup(spark: SparkSession, sf: str) -> DataFrame:
    parts = discovery.discover(base.shipped_orders(spark, sf))
    state = _state(spark, sf)[0].withColumn("schema_version", F.lit(2))
    found = incremental.partition_lookup(parts, state)
    return found.select("partition_id", "total_rows", "schema_version", "exported_path")


@query(
    f"""
    with now_fp as (
      select strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count,
        {base.fingerprint_sql(base.EVENT_TEXT)} as fingerprint
      from events group by 1),
    edited as (
      select * replace (case when dayofmonth(ts) = 5 then value + 1 else value end as value)
      from events where not (dayofmonth(ts) = 9 and event_type = 'error')),
    old_fp as (
      select strftime(ts, '%Y%m%d') as partition_id, count(*) as row_count,
        {base.fingerprint_sql(base.EVENT_TEXT)} as fingerprint
      from edited group by 1)
    select n.partition_id, n.row_count from now_fp n
    where not exists (select 1 from old_fp o where o.partition_id = n.partition_id
      and o.row_count = n.row_count and o.fingerprint = n.fingerprint)"""
)
def unchanged_suppressed(spark: SparkSession, sf: str) -> DataFrame:
    events = base.table(spark, sf, "events")
    day = F.dayofmonth("ts")
    edited = events.where(~((day == 9) & (F.col("event_type") == "error"))).withColumn(
        "value", F.when(day == 5, F.col("value") + 1).otherwise(F.col("value"))
    )

    def state(df: DataFrame) -> DataFrame:
        content = base.event_content(df)
        prints = verify.fingerprint_by(content, F.to_date("ts"), base.EVENT_COLUMNS)
        return prints.withColumns(
            {
                "partition_id": ids.partition_id(F.col("partition_id")),
                "dataset": F.lit("logs"),
                "table": F.lit("events"),
            }
        )

    kept = incremental.suppress_unchanged(state(events), state(edited))
    return kept.select("partition_id", "row_count")


@query(
    f"""with {base.SHIPPED_PARTS}
    select partition_id, total_rows, last_modified from shipped
    where last_modified > strptime(partition_id, '%Y%m%d') + interval 60 day"""
)
def late_partitions(spark: SparkSession, sf: str) -> DataFrame:
    parts = discovery.discover(base.shipped_orders(spark, sf))
    read_at = base.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    state = read_at.select(
        F.lit("shop").alias("dataset"),
        F.lit("orders").alias("table"),
        ids.partition_id(F.col("day")).alias("partition_id"),
        (F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 60 DAYS")).alias("snapshot_time"),
    )
    late = incremental.late_partitions(parts, state)
    return late.select("partition_id", "total_rows", "last_modified")


@query(
    """select user_id, event_id, ts, event_type, value from events
    where ts <= timestamp '2024-01-15 12:00:00'
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
)
def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    log = base.table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    at = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return asof.snapshot_as_of(log, ["user_id"], "ts", at, ["event_id"])


@query(
    """select o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""
)
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = base.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"
    )
    return keyed.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    """
    with ranked as (
      select l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey,
        row_number() over (partition by l_partkey
          order by l_shipdate, l_orderkey, l_linenumber, l_suppkey) as rn
      from lineitem)
    select l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey from ranked
    where rn = 1 and l_partkey not in (select p_partkey from part where p_size > 25)"""
)
def ledger_insert_missing(spark: SparkSession, sf: str) -> DataFrame:
    new = base.table(spark, sf, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"
    )
    old = base.table(spark, sf, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"]
    return ledger.insert_missing(new, old, ["l_partkey"], order)


@query(
    """
    with rows_all as (
      select o_orderkey as k, o_orderdate as seen, 'placed' as state, 0 as line from orders
      union all
      select l_orderkey, l_shipdate, 'shipped', l_linenumber from lineitem)
    select k, seen, state, line from rows_all
    qualify row_number() over (partition by k order by seen desc, state desc, line desc) = 1"""
)
def ledger_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old = base.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderdate").alias("seen"),
        F.lit("placed").alias("state"),
        F.lit(0).alias("line"),
    )
    new = base.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_shipdate").alias("seen"),
        F.lit("shipped").alias("state"),
        F.col("l_linenumber").alias("line"),
    )
    return ledger.upsert_view(old, new, ["k"], ["seen", "state", "line"])


RULES = [
    incremental.Rule("src1*.en", include=False),
    incremental.Rule("src?.*", strategy="full_refresh"),
    incremental.Rule("*.fr", batch_days=30),
]


@query(
    """
    with tables as (select source as dataset, lang as "table", count(*) as n from documents group by 1, 2),
    ruled as (
      select *, dataset || '.' || "table" as name from tables)
    select dataset, "table", n,
      case when regexp_full_match(name, 'src.\\..*') then 'full_refresh' else 'partition' end as strategy,
      case when regexp_full_match(name, 'src.\\..*') then 7
           when regexp_full_match(name, '.*\\.fr') then 30 else 7 end as batch_days
    from ruled where not regexp_full_match(name, 'src1.*\\.en')"""
)
def strategy_rules(spark: SparkSession, sf: str) -> DataFrame:
    tables = (
        base.table(spark, sf, "documents")
        .groupBy(F.col("source").alias("dataset"), F.col("lang").alias("table"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return incremental.apply_rules(tables, RULES)
