"""Registry of this package's queries, and tables kept in the shared folder."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from floodmark.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    A cluster that ships the library to its executors needs no more than that; this serves
    sessions that were started from another folder.
    """
    own = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if own not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([own, *filter(None, paths)])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The lineage ends at the table: a lost executor costs no recomputation of what led to it.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
