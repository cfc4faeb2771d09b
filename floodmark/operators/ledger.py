"""Append-only ledgers of runs, tables, partitions, schema versions and acknowledgements.

A row of the partitions ledger is the outcome of one partition in one run, good or bad.

A change of state is a new row; the latest row of a key is its state. Plain Parquet
has no MERGE, and appending keeps every earlier state for audit.

Compaction writes the present state once, as the base of a new generation; what is appended
then goes into that generation. Present state is read from the newest base and what came after
it, however long the history is; the history of all generations stays readable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.operators.journal import remove
from floodmark.operators.keyed import first_per_key, latest_per_key
from floodmark.sources.tables import union_all

RUNS = "run_id string, state string, at timestamp_ntz, started_at timestamp_ntz"
TABLES = """project string, dataset string, table string, schema_version int,
 watermark timestamp_ntz, run_id string, at timestamp_ntz"""
PARTITIONS = """project string, dataset string, table string, partition_id string,
 schema_version int, state string, error string, exported_modified timestamp_ntz,
 snapshot_time timestamp_ntz, synced_at timestamp_ntz, row_count bigint, exported_path string,
 run_id string, at timestamp_ntz, logical_bytes bigint, fingerprint string"""
VERSIONS = """dataset string, table string, version bigint, schema_hash string,
 shape_hash string, change_type string, n_changes bigint, widened boolean, valid_from timestamp_ntz,
 physical_hash string, schema_json string, run_id string"""
FIELDS = """dataset string, table string, version bigint, path string, parent string,
 name string, type string, mode string, description string, depth int, run_id string"""
ACKS = "dataset string, table string, version bigint, at timestamp_ntz"

SCHEMAS = {
    "runs": RUNS,
    "tables": TABLES,
    "partitions": PARTITIONS,
    "versions": VERSIONS,
    "fields": FIELDS,
    "acks": ACKS,
}
KEYS = {
    "runs": ["run_id"],
    "tables": ["dataset", "table"],
    "partitions": ["dataset", "table", "partition_id"],
}

# Ledgers whose history outgrows their present state. The others are needed whole.
COMPACTED = ("runs", "tables", "partitions")
CLOSED = ("completed", "partial")

STALE_AFTER = "INTERVAL 24 HOURS"


class Ledgers:
    """The ledgers below one root. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/") + "/ledger"

    def append(self, name: str, rows: DataFrame) -> None:
        """Append rows; columns the ledger knows and the rows lack are null."""
        fields = _schema(name).fields
        rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in fields
            ]
        ).write.mode("append").parquet(self._folder(name, self.generation()))

    def append_new(self, name: str, rows: DataFrame, keys: Sequence[str], run_id: str) -> None:
        """Append the rows whose keys the ledger does not have from this run yet."""
        there = self.live(name).where(F.col("run_id") == run_id).select(*keys)
        self.append(name, rows.join(there, list(keys), "left_anti"))

    def generation(self) -> int:
        """The newest generation whose base is complete; 0 before the first compaction."""
        folder, store = self._store(f"{self.root}/generations")
        if not store.exists(folder):
            return 0
        names = [status.getPath().getName() for status in store.listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _store(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, name: str, generation: int) -> str:
        if name not in COMPACTED or generation == 0:
            return f"{self.root}/{name}"
        return f"{self.root}/generation-{generation}/{name}"

    def _base(self, name: str, generation: int) -> str:
        return f"{self.root}/generation-{generation}/base/{name}"

    def read(self, name: str) -> DataFrame:
        """All rows ever appended, of all generations."""
        newest = self.generation() if name in COMPACTED else 0
        return union_all([self._at(name, self._folder(name, k)) for k in range(newest + 1)])

    def live(self, name: str) -> DataFrame:
        """Rows that the present state follows from: the newest base and what was appended since."""
        newest = self.generation()
        if name not in COMPACTED or newest == 0:
            return self.read(name)
        return union_all([self._at(name, self._base(name, newest)), self._at(name, self._folder(name, newest))])

    def compact(self) -> int:
        """Write the present state as the base of a new generation, and return its number.

        The base has the latest row of each key from closed runs, and every row of runs that
        are not closed: those may still go on and be published. It is in force once its
        generation is sealed, by creating one empty file; a compaction that dies before has
        changed nothing, and the next one writes the same generation anew.
        """
        new = self.generation() + 1
        remove(self.spark, f"{self.root}/generation-{new}")
        runs = latest_runs(self.live("runs"))
        closed = runs.where(F.col("state").isin(*CLOSED)).select("run_id")
        for name in COMPACTED:
            if name == "runs":
                kept = runs
            else:
                rows = self.live(name)
                going = rows.join(closed, "run_id", "left_anti")
                settled = self._state(name, rows.join(closed, "run_id", "left_semi"))
                kept = settled.unionByName(going)
            kept.select(*_schema(name).fieldNames()).write.parquet(self._base(name, new))
        self._seal(new)
        return new

    def closed_since(self) -> int:
        """Runs that closed since the last compaction."""
        rows = self._at("runs", self._folder("runs", self.generation()))
        return latest_runs(rows).where(F.col("state").isin(*CLOSED)).count()

    def _seal(self, generation: int) -> None:
        place, store = self._store(f"{self.root}/generations/{generation}")
        store.create(place, False).close()

    def _at(self, name: str, path: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._empty(name)

    def _empty(self, name: str) -> DataFrame:
        """No rows, in a form that lets Catalyst drop the joins with them."""
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in _schema(name).fields]
        return self.spark.range(0, 1, 1, 1).select(*nulls).where(F.lit(False))

    def committed(self, name: str) -> DataFrame:
        """Rows of completed runs only: the run's closing row is what publishes them."""
        return self._published(self.read(name))

    def _published(self, rows: DataFrame) -> DataFrame:
        closed = self.latest("runs").where(F.col("state").isin(*CLOSED))
        return rows.join(closed.select("run_id"), "run_id", "left_semi")

    def latest(self, name: str) -> DataFrame:
        if name == "runs":
            return latest_runs(self.live("runs"))
        if name == "versions":
            return latest_per_key(self.committed("versions"), ["dataset", "table"], ["version"])
        return self._state(name, self._published(self.live(name)))

    def _state(self, name: str, rows: DataFrame) -> DataFrame:
        """The latest row of each key; of partitions, the latest that was exported well."""
        if name == "partitions":
            rows = rows.where("state = 'completed'")
        return latest_per_key(rows, KEYS[name], ["at", "run_id"])

    def append_run(self, run_id: str, state: str, at: str, started_at: str) -> None:
        values = {"run_id": run_id, "state": state, "at": at, "started_at": started_at}
        one = self.spark.range(0, 1, 1, 1)
        self.append("runs", one.select(*[F.lit(v).alias(k) for k, v in values.items()]))


def _schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def latest_runs(runs: DataFrame) -> DataFrame:
    """Present state of each run; a closing row outranks the opening row of the same time."""
    return latest_per_key(runs, ["run_id"], ["at", F.col("state") != "running", "state"])


def stale_runs(runs: DataFrame, now: Column) -> DataFrame:
    """Runs whose latest row still says running though they began over 24 hours ago."""
    begun = F.col("started_at") < now - F.expr(STALE_AFTER)
    return latest_runs(runs).where((F.col("state") == "running") & begun)


def abort_rows(runs: DataFrame, now: Column) -> DataFrame:
    """Closing rows for stale runs."""
    return stale_runs(runs, now).withColumns({"state": F.lit("aborted"), "at": now})


def without_runs(tasks: DataFrame, runs: DataFrame) -> DataFrame:
    """Tasks of all runs but the given ones."""
    return tasks.join(runs.select("run_id").distinct(), "run_id", "left_anti")


def insert_missing(new: DataFrame, old: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows to append so that every new key exists once; stored rows are never replaced."""
    return first_per_key(new, keys, order).join(old.select(*keys).distinct(), list(keys), "left_anti")


def upsert_view(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """State by key after appending ``new`` to ``old``."""
    return latest_per_key(old.unionByName(new), keys, order)


def by_state(tasks: DataFrame, state: str) -> DataFrame:
    return tasks.where(F.col("state") == state)


def table_state(tables: DataFrame, dataset: str, table: str) -> DataFrame:
    return tables.where((F.col("dataset") == dataset) & (F.col("table") == table))
