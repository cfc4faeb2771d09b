"""Named queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.sources.tables import TableSource

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cents(column: str):
    """Money as whole cents, the same in every engine."""
    return F.round(F.col(column) * 100).cast("bigint")


def events(spark: SparkSession, sf: str) -> TableSource:
    return TableSource("logs", "events", table(spark, sf, "events"), "ts", "ts")


def orders(spark: SparkSession, sf: str) -> TableSource:
    frame = table(spark, sf, "orders")
    return TableSource("shop", "orders", frame, "o_orderdate", "o_orderdate")


def lineitem(spark: SparkSession, sf: str) -> TableSource:
    frame = table(spark, sf, "lineitem")
    return TableSource("shop", "lineitem", frame, "l_shipdate", "l_shipdate")


def customer(spark: SparkSession, sf: str) -> TableSource:
    return TableSource("shop", "customer", table(spark, sf, "customer"))


def documents(spark: SparkSession, sf: str) -> TableSource:
    return TableSource("text", "documents", table(spark, sf, "documents"))


def shipped_orders(spark: SparkSession, sf: str) -> TableSource:
    """Orders by order day, modified when their last item ships.

    Items are reduced to one row per order before the join.
    """
    shipped = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )
    frame = table(spark, sf, "orders").join(shipped, "o_orderkey", "left")
    return TableSource("shop", "orders", frame, "o_orderdate", "shipped")


# The same relations as common table expressions.
SHIPPED_PARTS = """
shipped as (
  select 'shop' as dataset, 'orders' as "table", strftime(o.o_orderdate, '%Y%m%d') as partition_id,
         count(*) as total_rows, max(l.shipped) as last_modified
  from orders o
  left join (select l_orderkey, max(l_shipdate) as shipped from lineitem group by 1) l
    on l.l_orderkey = o.o_orderkey
  group by 3
)"""

EVENT_PARTS = """
event_parts as (
  select 'logs' as dataset, 'events' as "table", strftime(ts, '%Y%m%d') as partition_id,
         count(*) as total_rows, max(ts) as last_modified
  from events group by 3
)"""

EVENT_TEXT = """concat_ws('|', cast(round(value * 100) as bigint), event_id,
    length(event_type) || ':' || event_type, length(props) || ':' || props, user_id)"""


def fingerprint_sql(text: str) -> str:
    return f"sum(('0x' || substr(sha256({text}), 1, 12))::bigint::hugeint)::varchar"


def event_content(df: DataFrame) -> DataFrame:
    """Events in columns that every engine prints alike."""
    return df.select("ts", cents("value").alias("cents"), "event_id", "event_type", "props", "user_id")


EVENT_COLUMNS = ["cents", "event_id", "event_type", "props", "user_id"]
