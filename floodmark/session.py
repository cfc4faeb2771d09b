"""Session settings and the shared folder that jobs write their intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Kept for the life of the process; removes itself when the process ends.
_LOCAL_SCRATCH: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "floodmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the export jobs rely on. AQE sizes the shuffles at run time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        # Plans are built from many columns; noting the call site of each doubles the time.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, whose executors
    share the driver's disk, may fall back to a temporary folder.
    """
    global _LOCAL_SCRATCH
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.TemporaryDirectory(prefix="floodmark-")
    return _LOCAL_SCRATCH.name


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, path: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Write a frame once and read it back, for results that several later steps use.

    The lineage ends at the written table, so a lost executor costs no recomputation, and
    Catalyst plans the joins that follow by the table's true size.
    """
    spark = df.sparkSession
    path = path or fresh_dir(spark, label)
    df.write.mode(mode).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
