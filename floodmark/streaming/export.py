"""Export new files as they arrive, each micro-batch exactly once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from floodmark.functions import ids
from floodmark.operators.keyed import join_per_key
from floodmark.plans import export
from floodmark.sources.tables import with_text

COMMITS = "batch_id bigint, max_event_time timestamp_ntz, rows bigint"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """Micro-batches that were written completely."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def start_export(
    stream: DataFrame,
    event_time: str,
    root: str,
    checkpoint: str,
    allowed_delay: str = "INTERVAL 1 DAY",
    layout: export.Layout = export.Layout(),
) -> StreamingQuery:
    """Export a stream by day of ``event_time`` until no input is left.

    Rows older than the newest exported time less the allowed delay go to a table of
    late rows instead of being dropped. A micro-batch that is run again after a failure
    overwrites its own directory, and its commit row is overwritten with it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = commits(spark, root).where(F.col("batch_id") < batch_id)
        reached = earlier.agg(F.max("max_event_time")).first()[0]
        time = F.col(event_time).cast("timestamp_ntz")
        late = F.lit(False)
        if reached is not None:
            late = time < F.lit(reached).cast("timestamp_ntz") - F.expr(allowed_delay)
        rows = batch.withColumns(
            {
                "partition_id": ids.partition_id(F.to_date(event_time)),
                "kind": F.when(late, "late").otherwise("on_time"),
            }
        )
        target = f"{root}/data/batch_id={batch_id}"
        arranged = export.arrange(rows, ["kind", "partition_id"], layout)
        export.write_parquet(arranged, target, layout, ["kind"], mode="overwrite")
        written = spark.read.schema(batch.schema).parquet(target)
        written.agg(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.max(F.col(event_time).cast("timestamp_ntz")).alias("max_event_time"),
            F.count(F.lit(1)).alias("rows"),
        ).write.mode("overwrite").parquet(f"{root}/commits/id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_exported(
    spark: SparkSession, root: str, schema: T.StructType, kind: str | None = None
) -> DataFrame:
    """Rows of the committed micro-batches; ``kind`` picks ``on_time`` or ``late`` rows."""
    layout = with_text(schema, "partition_id", "kind").add("batch_id", T.LongType())
    rows = spark.read.schema(layout).parquet(f"{root}/data")
    good = commits(spark, root).select("batch_id")
    done = join_per_key(rows, good, ["batch_id"], "left_semi")
    if kind is not None:
        done = done.where(F.col("kind") == kind)
    return done.drop("batch_id")
