"""Queries on the schema registry and on reading across versions.

The registry is derived from the line items: every order is a table, every line number
a record of it, and the item's part and supplier decide types and presence. It grows
with the data like a catalogue of many tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.functions import classify
from floodmark.operators import registry, unify
from floodmark.plans import export
from floodmark.session import fresh_dir, stored
from floodmark.workload import base
from floodmark.workload.base import query

TYPES = ["INT64", "FLOAT64", "NUMERIC", "STRING", "DATE", "TIMESTAMP"]
_TYPE_LIST = "[" + ", ".join(f"'{t}'" for t in TYPES) + "]"


def _pick(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.pmod(number, F.lit(6)) + 1).cast("int"))


_ITEMS = """
items as (
  select 'd' || (l_orderkey % 4) as dataset, 't' || l_orderkey as "table", 'g' || l_linenumber as g,
    min(l_partkey) as p, min(l_suppkey) as s,
    case max(l_returnflag) when 'A' then 'NULLABLE' when 'N' then 'REQUIRED' else 'REPEATED' end as mode
  from lineitem group by 1, 2, 3)"""

_FIELDS = f"""
with {_ITEMS},
old_fields as (
  select dataset, "table", g as path, g as name, 'RECORD' as type, 'NULLABLE' as mode
  from items where s % 5 <> 0
  union all
  select dataset, "table", g || '.a', 'a', {_TYPE_LIST}[p % 6 + 1], mode from items where s % 5 <> 0
  union all
  select dataset, "table", g || '.h', 'h', 'RECORD', 'NULLABLE' from items where s % 5 <> 0
  union all
  select dataset, "table", g || '.h.x', 'x', {_TYPE_LIST}[s % 6 + 1], mode from items where s % 5 <> 0),
new_fields as (
  select dataset, "table", g as path, g as name,
    case when p % 11 = 0 then 'STRING' else 'RECORD' end as type, 'NULLABLE' as mode
  from items where s % 7 <> 0
  union all
  select dataset, "table", g || '.a', 'a',
    case when p % 4 = 0 then {_TYPE_LIST}[(p // 6) % 6 + 1] else {_TYPE_LIST}[p % 6 + 1] end, mode
  from items where s % 7 <> 0 and p % 11 <> 0
  union all
  select dataset, "table", g || '.h', 'h', 'RECORD', 'NULLABLE'
  from items where s % 7 <> 0 and p % 11 <> 0 and p % 3 <> 0
  union all
  select dataset, "table", g || '.h.x', 'x', {_TYPE_LIST}[s % 6 + 1], mode
  from items where s % 7 <> 0 and p % 11 <> 0 and p % 3 <> 0
  union all
  select dataset, "table", g || '.n', 'n', 'STRING', mode
  from items where s % 7 <> 0 and p % 11 <> 0 and p % 5 = 0)"""


def _rank(column: str, *marks: str) -> Column:
    """Where a text lies among ordered marks: 2k + 1 at the k-th, even between, null for null.

    The greatest rank is that of the greatest text, and numbers are aggregated without sorting rows.
    """
    rank = F.when(F.col(column) < marks[0], 0)
    for k, mark in enumerate(marks):
        rank = rank.when(F.col(column) == mark, 2 * k + 1)
        beyond = F.col(column) > mark
        rank = rank.when(beyond & (F.col(column) < marks[k + 1]) if k + 1 < len(marks) else beyond, 2 * k + 2)
    return rank


def _items(spark: SparkSession, sf: str) -> DataFrame:
    mode = F.max(_rank("l_returnflag", "A", "N"))
    return (
        base.table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_partkey").alias("p"),
            F.min("l_suppkey").alias("s"),
            F.when(mode == 1, "NULLABLE").when(mode == 3, "REQUIRED").otherwise("REPEATED").alias("mode"),
        )
        .select(
            F.concat(F.lit("d"), (F.col("l_orderkey") % 4).cast("string")).alias("dataset"),
            F.concat(F.lit("t"), F.col("l_orderkey").cast("string")).alias("table"),
            F.concat(F.lit("g"), F.col("l_linenumber").cast("string")).alias("g"),
            "p", "s", "mode",
        )
        .repartition("dataset", "table")  # a table's fields lie together, as in a registry that is kept by table
    )


def _tables(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of :func:`_items`, of which each has a row at least."""
    key = F.col("l_orderkey")
    return base.table(spark, sf, "lineitem").select(
        F.concat(F.lit("d"), (key % 4).cast("string")).alias("dataset"),
        F.concat(F.lit("t"), key.cast("string")).alias("table"),
    )


def _unfold(items: DataFrame, fields: list[tuple[Column, str, Column | str, Column | str]]) -> DataFrame:
    """One row per item and field whose condition holds."""
    entries = [
        F.when(
            present,
            F.struct(
                (F.concat("g", F.lit("." + below)) if below else F.col("g")).alias("path"),
                (F.lit(below.rsplit(".", 1)[-1]) if below else F.col("g")).alias("name"),
                (F.lit(dtype) if isinstance(dtype, str) else dtype).alias("type"),
                (F.lit(mode) if isinstance(mode, str) else mode).alias("mode"),
            ),
        )
        for present, below, dtype, mode in fields
    ]
    unfolded = items.select("dataset", "table", F.explode(F.array(*entries)).alias("f"))
    return unfolded.where(F.col("f").isNotNull()).select("dataset", "table", "f.*")


def _old_fields(spark: SparkSession, sf: str) -> DataFrame:
    here, mode = F.col("s") % 5 != 0, F.col("mode")
    return _unfold(
        _items(spark, sf),
        [
            (here, "", "RECORD", "NULLABLE"),
            (here, "a", _pick(F.col("p")), mode),
            (here, "h", "RECORD", "NULLABLE"),
            (here, "h.x", _pick(F.col("s")), mode),
        ],
    )


def _new_fields(spark: SparkSession, sf: str) -> DataFrame:
    p, mode = F.col("p"), F.col("mode")
    here = F.col("s") % 7 != 0
    record = here & (p % 11 != 0)
    other = F.floor(p / 6).cast("bigint")
    return _unfold(
        _items(spark, sf),
        [
            (here, "", F.when(p % 11 == 0, "STRING").otherwise("RECORD"), "NULLABLE"),
            (record, "a", F.when(p % 4 == 0, _pick(other)).otherwise(_pick(p)), mode),
            (record & (p % 3 != 0), "h", "RECORD", "NULLABLE"),
            (record & (p % 3 != 0), "h.x", _pick(F.col("s")), mode),
            (record & (p % 5 == 0), "n", "STRING", mode),
        ],
    )


@query(
    f"""{_FIELDS},
    placed as (
      select *, string_split(path, '.') as steps, len(string_split(path, '.')) as depth from old_fields),
    framed as (
      select *, lag(depth) over (partition by dataset, "table" order by steps) as before from placed)
    select dataset, "table", count(*) as n_fields,
      sha256(string_agg(
        case when before is null then '' when depth > before then chr(0) || chr(123)
             else repeat(chr(125), before - depth) || chr(0) end
        || name || chr(0) || type || chr(0) || mode, '' order by steps)
        || repeat(chr(125), last(depth order by steps) - 1)) as schema_hash
    from framed group by 1, 2"""
)
def schema_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    prints = registry.fingerprints(_old_fields(spark, sf), ["dataset", "table"])
    return prints.drop("shape_hash")


_WIDER = " or ".join(
    f"(before_type = '{a}' and after_type in ({', '.join(repr(b) for b in bs)}))"
    for a, bs in classify.WIDENINGS.items()
)

_CHANGES = f"""{_FIELDS},
changed as (
  select coalesce(o.dataset, n.dataset) as dataset, coalesce(o."table", n."table") as "table",
    coalesce(o.path, n.path) as path, o.type as before_type, n.type as after_type,
    o.mode as before_mode, n.mode as after_mode,
    case when o.path is null then 'ADD' when n.path is null then 'DROP' else 'TYPE_CHANGE' end as change
  from old_fields o full join new_fields n
    on o.dataset = n.dataset and o."table" = n."table" and o.path = n.path
  where o.type is distinct from n.type),
changes as (
  select *, coalesce(change = 'TYPE_CHANGE' and ({_WIDER}), false) as widening from changed c
  where not exists (
    select 1 from changed a where a.dataset = c.dataset and a."table" = c."table"
      and starts_with(c.path, a.path || '.'))),
diffed as (
  select *, case change when 'ADD' then after_mode not in ('NULLABLE', 'REPEATED')
                 when 'TYPE_CHANGE' then not widening else true end as breaking
  from changes)"""


@query(f"{_CHANGES} select * from diffed")
def schema_diff(spark: SparkSession, sf: str) -> DataFrame:
    return registry.diff(_old_fields(spark, sf), _new_fields(spark, sf))


@query(
    f"""{_CHANGES},
    tables as (select distinct dataset, "table" from items)
    select t.dataset, t."table", count(d.path) as n_changes,
      case when count(d.path) = 0 then 'NONE' when bool_or(d.breaking) then 'BREAKING'
           else 'ADDITIVE' end as change_type,
      coalesce(bool_or(d.widening), false) as widened
    from tables t left join diffed d on t.dataset = d.dataset and t."table" = d."table"
    group by 1, 2"""
)
def schema_classify(spark: SparkSession, sf: str) -> DataFrame:
    changes = registry.diff(_old_fields(spark, sf), _new_fields(spark, sf))
    return registry.classify_changes(changes, _tables(spark, sf))


@query(
    f"""{_CHANGES},
    lost as (
      select *, coalesce(before_type, after_type) as type, regexp_extract(path, '^(.*)\\.[^.]*$', 1) as parent
      from diffed where change in ('ADD', 'DROP'))
    select dataset, "table", parent, type,
      count(*) filter (change = 'DROP') as n_dropped, count(*) filter (change = 'ADD') as n_added,
      case when n_dropped = 1 and n_added = 1 then min(path) filter (change = 'DROP') end as renamed_from,
      case when n_dropped = 1 and n_added = 1 then min(path) filter (change = 'ADD') end as renamed_to
    from lost group by 1, 2, 3, 4
    having count(*) filter (change = 'DROP') > 0 and count(*) filter (change = 'ADD') > 0"""
)
def rename_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return registry.rename_candidates(registry.diff(_old_fields(spark, sf), _new_fields(spark, sf)))


@query(
    f"""
    with pairs as (
      select {_TYPE_LIST}[l_partkey % 6 + 1] as before_type, {_TYPE_LIST}[l_suppkey % 6 + 1] as after_type
      from lineitem)
    select before_type, after_type, ({_WIDER}) as widening, count(*) as n from pairs group by 1, 2, 3"""
)
def type_widening(spark: SparkSession, sf: str) -> DataFrame:
    pairs = base.table(spark, sf, "lineitem").select(
        _pick(F.col("l_partkey")).alias("before_type"), _pick(F.col("l_suppkey")).alias("after_type")
    )
    widening = classify.is_widening(F.col("before_type"), F.col("after_type"))
    return pairs.groupBy("before_type", "after_type", widening.alias("widening")).agg(
        F.count(F.lit(1)).alias("n")
    )


# Schemas of one table per supplier, observed monthly: the line numbers shipped in the
# month are its fields.
_OBSERVED = """
with observed as (
  select 'sup' as dataset, 's' || l_suppkey as "table", date_trunc('month', l_shipdate)::timestamp as seen,
    'f' || l_linenumber as path,
    case max(l_returnflag) when 'A' then 'INT64' when 'N' then 'FLOAT64' else 'STRING' end as type,
    case max(l_linestatus) when 'O' then 'NULLABLE' else 'REQUIRED' end as mode
  from lineitem group by 1, 2, 3, 4),
texts as (
  select dataset, "table", seen, count(*) as n_fields,
    string_agg(path || chr(0) || type || chr(0) || mode, chr(0) order by path) as full_text,
    string_agg(path || chr(0) || type, chr(0) order by path) as shape
  from observed group by 1, 2, 3),
flagged as (
  select *, case when shape is distinct from lag(shape) over (partition by dataset, "table" order by seen)
                 then 1 else 0 end as turn
  from texts),
numbered as (
  select *, sum(turn) over (partition by dataset, "table" order by seen)::bigint as version from flagged),
history as (
  select dataset, "table", version, sha256(full_text) as schema_hash, n_fields, seen as valid_from,
    lead(seen) over (partition by dataset, "table" order by version) as valid_until
  from numbered where turn = 1)"""


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    flag, status = F.max(_rank("l_returnflag", "A", "N")), F.max(_rank("l_linestatus", "O"))
    return (
        base.table(spark, sf, "lineitem")
        .groupBy(
            "l_suppkey", F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("observed_at"),
            "l_linenumber",
        )
        .agg(
            F.when(flag == 1, "INT64").when(flag == 3, "FLOAT64").otherwise("STRING").alias("type"),
            F.when(status == 1, "NULLABLE").otherwise("REQUIRED").alias("mode"),
        )
        .select(
            F.lit("sup").alias("dataset"),
            F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("table"),
            "observed_at",
            F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias("path"),
            F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias("name"),
            "type", "mode",
        )
    )


@query(f"{_OBSERVED} select * from history")
def schema_history(spark: SparkSession, sf: str) -> DataFrame:
    by_year = F.date_trunc("year", "observed_at")
    return registry.version_history(_observed(spark, sf), by_year)


_CLASSES = f"""{_OBSERVED},
fields as (
  select h.dataset, h."table", h.version, o.path, o.type, o.mode
  from history h join observed o on h.dataset = o.dataset and h."table" = o."table" and h.valid_from = o.seen),
changed as (
  select coalesce(o.dataset, n.dataset) as dataset, coalesce(o."table", n."table") as "table",
    coalesce(o.version + 1, n.version) as version,
    o.type as before_type, n.type as after_type, n.mode as after_mode, o.path is null as added
  from (select f.* from fields f semi join history h
          on f.dataset = h.dataset and f."table" = h."table" and h.version = f.version + 1) o
  full join (select * from fields where version > 1) n
    on o.dataset = n.dataset and o."table" = n."table" and o.path = n.path and o.version + 1 = n.version
  where o.type is distinct from n.type),
verdicts as (
  select dataset, "table", version, count(*) as n_changes,
    bool_or(case when added then after_mode <> 'NULLABLE' when after_type is null then true
                 else not ({_WIDER}) end) as breaking
  from changed group by 1, 2, 3),
classed as (
  select h.dataset, h."table", h.version, coalesce(v.n_changes, 0) as n_changes,
    case when h.version = 1 then 'INITIAL' when v.breaking then 'BREAKING' else 'ADDITIVE' end as change_type
  from history h left join verdicts v
    on h.dataset = v.dataset and h."table" = v."table" and h.version = v.version)"""


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    # Both steps read all observations; they are derived from the line items once.
    observed = stored(_observed(spark, sf), "observed")
    history = registry.version_history(observed, F.date_trunc("year", "observed_at"))
    return registry.classify_history(observed, history)


@query(f"{_CLASSES} select * from classed")
def version_classes(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).select("dataset", "table", "version", "n_changes", "change_type")


@query(
    f"""{_CLASSES},
    acks as (
      select distinct 'sup' as dataset, 's' || s_suppkey as "table", s_nationkey::bigint as version
      from supplier)
    select c.dataset, c."table",
      max(case when c.change_type <> 'BREAKING' or a.version is not null then c.version end) as current_version,
      max(c.version) as latest_version
    from classed c left join acks a
      on a.dataset = c.dataset and a."table" = c."table" and a.version = c.version
    group by 1, 2"""
)
def ack_promotes(spark: SparkSession, sf: str) -> DataFrame:
    acks = base.table(spark, sf, "supplier").select(
        F.lit("sup").alias("dataset"),
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("table"),
        F.col("s_nationkey").cast("bigint").alias("version"),
    )
    return registry.current_version(_classified(spark, sf), acks)


# -- reading across versions -----------------------------------------------------


@query(
    """
    select doc_id, text, lang, case when lang = 'en' then source end as source,
      case when lang = 'en' then n_chars end as n_chars
    from documents"""
)
def unify_versions(spark: SparkSession, sf: str) -> DataFrame:
    docs = base.table(spark, sf, "documents")
    root = fresh_dir(spark, "unify")
    english = F.col("lang") == "en"
    v1 = docs.where(~english).select("doc_id", "text", "lang")
    export.write_parquet(v1, f"{root}/schema_version=v1")
    export.write_parquet(docs.where(english), f"{root}/schema_version=v2")
    versions = [spark.read.parquet(f"{root}/schema_version=v{v}") for v in (1, 2)]
    return unify.unify(versions, docs.schema)


@query(
    """select p_partkey, p_name, p_brand, p_type, cast(p_size as bigint) as p_size,
      p_retailprice, cast(null as varchar) as p_origin
    from part"""
)
def rewrite_forward(spark: SparkSession, sf: str) -> DataFrame:
    part = base.table(spark, sf, "part")
    root = fresh_dir(spark, "rewrite")
    export.write_parquet(part, f"{root}/schema_version=v1")
    widened = [
        T.StructField(f.name, T.LongType() if f.name == "p_size" else f.dataType) for f in part.schema
    ]
    target = T.StructType([*widened, T.StructField("p_origin", T.StringType())])
    old = spark.read.parquet(f"{root}/schema_version=v1")
    export.write_parquet(unify.rewrite_forward(old, target), f"{root}/schema_version=v2")
    return spark.read.schema(target).parquet(f"{root}/schema_version=v2")


@query(
    """select o_orderkey, o_custkey as customer, o_orderdate,
      case when o_orderstatus <> 'F' then o_orderpriority end as o_orderpriority
    from orders"""
)
def unify_view(spark: SparkSession, sf: str) -> DataFrame:
    orders = base.table(spark, sf, "orders")
    root = fresh_dir(spark, "view")
    closed = F.col("o_orderstatus") == "F"
    pieces = [
        orders.where(closed).select("o_orderkey", "o_custkey", "o_orderdate"),
        orders.where(~closed).select(
            "o_orderkey", F.col("o_custkey").alias("customer"), "o_orderdate", "o_orderpriority"
        ),
    ]
    versions = []
    for v, piece in enumerate(pieces, start=1):
        export.write_parquet(piece, f"{root}/schema_version=v{v}")
        versions.append((f"parquet.`{root}/schema_version=v{v}`", piece.schema))
    return spark.sql(unify.view_text(versions, pieces[1].schema, {"customer": "o_custkey"}))


@query(
    """select event_id,
      0 as age_months, cast(date_diff('day', date '2024-01-01', cast(ts as date)) as integer) as age_days,
      epoch_us(ts) - epoch_us(date_trunc('day', ts)) as age_micros,
      cast(cast(event_id as decimal(28, 10)) as varchar) as big_id,
      json_extract_string(props, '$.k')::bigint as k
    from events"""
)
def storable_types(spark: SparkSession, sf: str) -> DataFrame:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    typed = base.table(spark, sf, "events").select(
        "event_id",
        (F.col("ts") - start).alias("age"),
        F.col("event_id").cast("decimal(28,10)").alias("big_id"),
        F.parse_json("props").alias("props"),
    )
    root = fresh_dir(spark, "storable")
    export.write_parquet(unify.storable(typed), root)
    return spark.read.parquet(root).select(
        "event_id",
        F.col("age.months").alias("age_months"),
        F.col("age.days").alias("age_days"),
        F.col("age.micros").alias("age_micros"),
        "big_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
