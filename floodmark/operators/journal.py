"""The journal of a run: which of its steps are done, so that a restart need not do them again.

A step is one small file below the run's own folder, written beside its place and renamed into
it: it is there whole or not at all. Steps are few (a handful for a run, one for each table),
so the driver reads them back at once. What a step did is durable before it is noted; a run
that dies between the two does that step again, and each step's own writing allows for that.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: Name of steps that concern the run as a whole.
RUN = "run"
STEPS = "name string, step string, detail string"


class Journal:
    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark = spark
        self.folder = f"{root}/runs/{run_id}/journal"

    def _place(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def note(self, step: str, name: str = RUN, **detail: Any) -> None:
        """Note a step as done; noting it again replaces what was noted."""
        text = json.dumps({"name": name, "step": step, "detail": json.dumps(detail)})
        place, store = self._place(f"{name}.{step}.json")
        beside, _ = self._place(f"_{name}.{step}.json")
        out = store.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not store.rename(beside, place):  # some stores do not rename onto a file
            store.delete(place, False)
            store.rename(beside, place)

    def table(self) -> DataFrame:
        """One row per step: name, step, detail."""
        return self.spark.read.schema(STEPS).json(self.folder)

    def steps(self) -> dict[tuple[str, str], dict[str, Any]]:
        """Details of the steps that are done, by step and name."""
        try:
            return {(r["step"], r["name"]): json.loads(r["detail"]) for r in self.table().collect()}
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}


def remove(spark: SparkSession, folder: str) -> None:
    """Delete what an earlier attempt left in a folder that only this run writes."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
