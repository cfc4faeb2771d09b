"""One incremental run over many tables: discover, plan, export, verify, publish."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.functions import ids
from floodmark.operators import (
    batches,
    discovery,
    filesizes,
    incremental,
    ledger,
    manifest,
    registry,
    report,
    sketches,
    unify,
    verify,
    zonemaps,
)
from floodmark.operators.journal import RUN, Journal, remove
from floodmark.operators.keyed import join_per_key
from floodmark.operators.ledger import Ledgers
from floodmark.plans import export
from floodmark.session import stored
from floodmark.sources import files
from floodmark.sources.tables import TableSource, union_all

TABLE_KEY = incremental.TABLE_KEY
KEY = incremental.PARTITION_KEY

# Directory columns of exported files, and the one data column that all of them have.
LAYOUT = """partition_id string, dataset string, table string, schema_version string,
 run string, batch string"""

# Readers would see the rows of both kinds of export.
SWITCHED = "the table was exported under another strategy before; use a new table name"


@dataclass(frozen=True)
class RunResult:
    run_id: str
    state: str
    tables: int
    failed: dict[str, str]


class Lake:
    """A Parquet lake below one root, with its ledgers and manifest. One writer at a time."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        layout: export.Layout = export.Layout(),
        at_once: int = 4,
        big_decimals: str = "decimal",
        compact_every: int = 0,
    ):
        """``big_decimals`` says how decimals of more than 9 digits after the point are stored.

        ``compact_every`` is the number of closed runs after which a run compacts the ledgers
        once it is closed itself; 0 leaves that to :meth:`compact`.
        """
        self.spark = spark
        self.at_once = at_once
        self.big_decimals = big_decimals
        self.compact_every = compact_every
        self.root = root.rstrip("/")
        self.layout = layout
        self.ledgers = Ledgers(spark, self.root)

    # -- one run ---------------------------------------------------------------

    def sync(
        self,
        sources: Sequence[TableSource],
        run_id: str,
        now: str,
        days: int = batches.DEFAULT_DAYS,
        rules: Sequence[incremental.Rule] = (),
    ) -> RunResult:
        """Export what changed since the last run and publish it.

        Each table is one write job, as tables differ in their columns. All other steps
        handle the tables together. Everything a run writes lies under its own id, and
        readers see it only once the closing row of the run is in the ledger: a run that
        dies half way changes nothing for them and its files become orphans.

        A run that died, failed or was aborted goes on where it stopped when it is started
        again under its id with the same sources: the plan and the tables that it noted as
        written stand, tables that it left half written are written anew.
        """
        at = F.lit(now).cast("timestamp_ntz")
        state = self._reopen(run_id, at, now)
        self.ledgers.append_run(run_id, "running", now, now)
        try:
            result = self._run(sources, run_id, now, days, rules, resumed=state is not None)
        except Exception:
            # Nothing of the run is published; the next one need not wait for it.
            self.ledgers.append_run(run_id, "failed", now, now)
            raise
        if self.compact_every and self.ledgers.closed_since() >= self.compact_every:
            self.ledgers.compact()
        return result

    def compact(self) -> int:
        """Write the ledgers' present state once, so that reading it no longer reads all history."""
        return self.ledgers.compact()

    def _reopen(self, run_id: str, at: Column, now: str) -> str | None:
        """The state of an earlier attempt of a run, if there is one; stale other runs are aborted."""
        runs = self.ledgers.live("runs")
        stale = ledger.abort_rows(runs, at).where(F.col("run_id") != run_id)
        if not stale.isEmpty():
            self.ledgers.append("runs", stale)
        known = ledger.latest_runs(runs.where(F.col("run_id") == run_id)).first()
        if known is None:
            return None
        if known["state"] in ("completed", "partial"):
            raise ValueError(f"run {run_id} is {known['state']}; a new run needs a new id")
        if known["state"] != "running" and dt.datetime.fromisoformat(now) <= known["at"]:
            raise ValueError(f"run {run_id} was closed at {known['at']}; start it again at a later time")
        return known["state"]

    def unfinished(self) -> DataFrame:
        """Steps that runs which are not closed have noted: run_id, name, step, detail."""
        going = self.ledgers.latest("runs").where(~F.col("state").isin("completed", "partial"))
        rows = [Journal(self.spark, self.root, r["run_id"]) for r in going.select("run_id").collect()]
        noted = [(j.folder.split("/")[-2], n, s, json.dumps(d)) for j in rows for (s, n), d in j.steps().items()]
        return self.spark.createDataFrame(noted, "run_id string, name string, step string, detail string")

    def _run(
        self,
        sources: Sequence[TableSource],
        run_id: str,
        now: str,
        days: int,
        rules: Sequence[incremental.Rule],
        resumed: bool,
    ) -> RunResult:
        at = F.lit(now).cast("timestamp_ntz")
        journal = Journal(self.spark, self.root, run_id)
        done = journal.steps() if resumed else {}
        default = incremental.Rule("*", batch_days=days)
        chosen = [(s, incremental.rule_for(s.name, rules, default)) for s in sources]
        # A full refresh takes the table as one partition.
        chosen = [
            (replace(s, partition_on=None, shard_on=None) if r.strategy == "full_refresh" else s, r)
            for s, r in chosen
            if r.include
        ]
        chosen = [(replace(s, frame=self._storable(s.frame)), r) for s, r in chosen]
        if ("planned", RUN) in done:  # what was not planned then waits for the next run
            planned_names = done["versions", RUN]
            chosen = [(s, r) for s, r in chosen if s.name in planned_names]
            if lacking := sorted(planned_names.keys() - {s.name for s, _ in chosen}):
                raise ValueError(f"run {run_id} was planned with other tables as well: {', '.join(lacking)}")
        sources = [source for source, _ in chosen]
        if not sources:  # the rules leave nothing to do
            self.ledgers.append_run(run_id, "completed", now, now)
            return RunResult(run_id, "completed", 0, {})
        folder = f"{self.root}/runs/{run_id}"
        if ("planned", RUN) in done:
            versions = done["versions", RUN]
            wanted, plan = (self.spark.read.parquet(f"{folder}/{name}") for name in ("wanted", "plan"))
        else:
            versions = self._resolve_versions(sources, run_id, now, resumed)
            journal.note("versions", **versions)
            wanted, plan = self._plan(chosen, folder, resumed)
            journal.note("planned")
        planned = plan.groupBy(*TABLE_KEY).agg(F.count(F.lit(1)).alias("n")).collect()
        sizes = {f"{r['dataset']}.{r['table']}": r["n"] for r in planned}

        switched = self._switched(sources)
        todo = [s for s in sources if s.name in sizes and s.name not in switched]
        targets = {
            s.name: export.run_dir(self.root, s.dataset, s.table, versions[s.name], run_id)
            for s in todo
        }

        def write(source: TableSource) -> str | None:
            if ("written", source.name) in done:
                return None
            target = targets[source.name]
            if resumed:
                remove(self.spark, target)
            layout = replace(self.layout, cluster_by=source.cluster_by or self.layout.cluster_by)
            mine = ledger.table_state(plan, source.dataset, source.table)
            try:
                self._write(source, mine, target, layout)
            except Exception as error:  # one table's failure must not stop the others
                return str(error)
            journal.note("written", source.name, at=now)
            return None

        # Small tables do not fill a cluster one after the other, so several are written at once.
        with export.file_sizing(self.spark, self.layout), ThreadPoolExecutor(self.at_once) as pool:
            errors = dict(zip([s.name for s in todo], pool.map(write, todo)))
        failed = {name: error for name, error in errors.items() if error is not None}
        failed |= {name: SWITCHED for name in switched if name in sizes}
        written = {name: targets[name] for name, error in errors.items() if error is None}
        if ("published", RUN) in done:
            failed |= done["published", RUN]
        elif written:
            counted = self._count_written(list(written.values()), run_id)
            failed |= self._mismatches(plan, counted, list(written))
            self._publish(plan, counted, written, failed, versions, run_id, at, resumed)
            journal.note("published", **failed)
        if failed:
            self._record_failures(plan, failed, versions, run_id, at, resumed)
        self._record_tables(sources, wanted, run_id, failed, versions, now, resumed)
        done_well = len(written.keys() - failed.keys())
        state = "completed" if not failed else "partial" if done_well else "failed"
        self.ledgers.append_run(run_id, state, now, now)
        return RunResult(run_id, state, done_well, failed)

    def _storable(self, frame: DataFrame) -> DataFrame:
        """The frame in types that files can hold; as it is, if that changes nothing."""
        changed = unify.storable(frame, self.big_decimals)
        return frame if changed.schema == frame.schema else changed

    def _write(self, source: TableSource, plan: DataFrame, target: str, layout: export.Layout) -> None:
        export.export_batches(source, plan, target, layout)

    def _add(self, name: str, rows: DataFrame, keys: Sequence[str], run_id: str, resumed: bool) -> None:
        """Append to a ledger; a run that goes on leaves out what its earlier attempt appended."""
        if resumed:
            self.ledgers.append_new(name, rows, keys, run_id)
        else:
            self.ledgers.append(name, rows)

    def _switched(self, sources: Sequence[TableSource]) -> set[str]:
        """Tables exported in another kind of partitions before: whole, by time or by shard."""
        kind = ids.kind_of_id(F.col("partition_id"))
        known = self.ledgers.latest("partitions").groupBy(*TABLE_KEY).agg(F.max(kind).alias("kind"))
        before = {f"{r['dataset']}.{r['table']}": r["kind"] for r in known.collect()}
        return {s.name for s in sources if before.get(s.name, s.kind) != s.kind}

    def _resolve_versions(
        self, sources: Sequence[TableSource], run_id: str, now: str, resumed: bool
    ) -> dict[str, int]:
        """Schema version of each table; schemas not seen before are recorded.

        Records carry the run's id: those of a run that dies are never in force.
        """
        rows = [
            (s.dataset, s.table, *f) for s in sources for f in registry.flatten(s.frame.schema, s.modes)
        ]
        today = self.spark.createDataFrame(
            rows,
            "dataset string, table string, path string, parent string, name string, type string, "
            "mode string, description string, depth int",
        )
        physical = self.spark.createDataFrame(
            [(s.dataset, s.table, registry.physical_hash(s.frame.schema), s.frame.schema.json()) for s in sources],
            "dataset string, table string, physical_hash string, schema_json string",
        )
        resolved = registry.resolve(today, self.ledgers.latest("versions"), physical)
        verdicts = resolved.select(*TABLE_KEY, "version", "is_new").collect()
        if any(r["is_new"] for r in verdicts):
            found = registry.describe_new(resolved, today, self.ledgers.committed("fields"))
            # Stored types that changed within one warehouse type break no reader.
            kept = F.col("retyped")
            found = found.withColumns(
                {
                    "change_type": F.when(kept, F.lit("ADDITIVE")).otherwise(F.col("change_type")),
                    "widened": F.col("widened") | kept,
                    "valid_from": F.lit(now).cast("timestamp_ntz"),
                    "run_id": F.lit(run_id),
                }
            ).join(physical.select(*TABLE_KEY, "schema_json"), TABLE_KEY)
            new = [(r["dataset"], r["table"], r["version"]) for r in verdicts if r["is_new"]]
            listed = self.spark.createDataFrame(new, "dataset string, table string, version bigint")
            # Fields first: a version without its fields would make the next one all ADD.
            fields = today.join(listed, TABLE_KEY).withColumn("run_id", F.lit(run_id))
            self._add("fields", fields, [*TABLE_KEY, "version", "path"], run_id, resumed)
            self._add("versions", found, [*TABLE_KEY, "version"], run_id, resumed)
        return {f"{r['dataset']}.{r['table']}": r["version"] for r in verdicts}

    def _plan(
        self, chosen: list[tuple[TableSource, incremental.Rule]], folder: str, resumed: bool
    ) -> tuple[DataFrame, DataFrame]:
        """Partitions that changed, and those of them to export with their batches.

        Both are written once and read back: that cuts the lineage, and each later step reads
        some small files instead of discovering the sources again.
        """
        mode = "overwrite" if resumed else "errorifexists"
        marks = {f"{r['dataset']}.{r['table']}": r["watermark"] for r in self.ledgers.latest("tables").collect()}
        with ThreadPoolExecutor(self.at_once) as pool:
            narrowed = list(pool.map(lambda s: self._touched(s, marks.get(s.name)), [s for s, _ in chosen]))
        found: dict[str, list[DataFrame]] = {"times": [], "shards": [], "whole": []}
        for source, (_, rule) in zip(narrowed, chosen):
            if source.kind == "shards":
                parts = discovery.discover_shards(source, with_bytes=rule.sized_files)
            else:
                parts = discovery.discover(source, with_bytes=rule.skip_unchanged or rule.sized_files)
                parts = parts.withColumn("fingerprint", F.lit(None).cast("string"))
            kind = "times" if source.kind == "whole" and rule.strategy == "partition" else source.kind
            found[kind].append(parts.withColumn("batch_days", F.lit(rule.batch_days)))
        state = self.ledgers.latest("partitions")
        wanted = list(found["whole"])
        if found["times"]:
            changed = incremental.changed_since(union_all(found["times"]), self.ledgers.latest("tables"))
            wanted.append(incremental.skip_exported(changed, state))
        if found["shards"]:
            names = [s.name for s in narrowed if s.kind == "shards"]
            mine = state.where(F.concat_ws(".", *TABLE_KEY).isin(names) & (ids.kind_of_id(F.col("partition_id")) == "shards"))
            days = F.lit(batches.DEFAULT_DAYS)
            parts = union_all(found["shards"]).drop("batch_days")
            wanted.append(incremental.changed_shards(parts, mine).withColumn("batch_days", days))
        rows = union_all(wanted)
        skips = [s.name for s, rule in chosen if rule.skip_unchanged and s.kind != "shards"]
        if skips:
            asked = F.concat_ws(".", *TABLE_KEY).isin(skips)
            rows = incremental.mark_unchanged(rows, state).withColumn("unchanged", F.col("unchanged") & asked)
        else:
            rows = rows.withColumn("unchanged", F.lit(False))
        rows = stored(rows, "wanted", f"{folder}/wanted", mode)
        every = sorted({rule.batch_days for _, rule in chosen} | ({batches.DEFAULT_DAYS} if found["shards"] else set()))
        todo = rows.where("not unchanged")
        plan = union_all(
            [batches.label_batches(batches.assign_batches(todo.where(F.col("batch_days") == days), days)) for days in every]
        )
        sized = [s.name for s, rule in chosen if rule.sized_files]
        if sized:
            plan = self._with_files(plan, sized)
        return rows, stored(plan, "plan", f"{folder}/plan", mode)

    def _with_files(self, plan: DataFrame, names: Sequence[str]) -> DataFrame:
        """The plan with the files of the named tables: ``stored_bytes``, ``pieces``, ``first_file``.

        Stored bytes are logical bytes times what the table's earlier files took of them.
        """
        asked = F.concat_ws(".", *TABLE_KEY).isin(list(names)) & (F.col("total_rows") > 0)
        default = F.lit(1 / export.SHUFFLE_TO_FILE)
        size = F.ceil(F.col("total_logical_bytes") * F.coalesce("ratio", default)).cast("bigint")
        mine = join_per_key(plan.where(asked), self.stored_ratio(), TABLE_KEY, "left")
        mine = mine.withColumn("stored_bytes", size).drop("ratio")
        layout = self.layout
        files_of = filesizes.plan_files(
            mine, F.col("stored_bytes"), layout.target_bytes, layout.smallest_bytes, layout.largest_bytes
        )
        return plan.where(~asked).unionByName(files_of, allowMissingColumns=True)

    def stored_ratio(self) -> DataFrame:
        """Bytes in files for each logical byte, by table, over the runs that measured both."""
        run = ["run_id", *TABLE_KEY]
        parts = self.ledgers.committed("partitions").where("state = 'completed'")
        logical = parts.groupBy(*run).agg(
            F.sum("logical_bytes").alias("logical"),
            F.bool_and((F.col("logical_bytes").isNotNull()) | (F.col("row_count") == 0)).alias("known"),
        )
        sizes = self._listed().groupBy(*run).agg(F.sum("size").alias("size"))
        both = logical.where("known and logical > 0").join(sizes, run)
        return both.groupBy(*TABLE_KEY).agg((F.sum("size") / F.sum("logical")).alias("ratio"))

    def _touched(self, source: TableSource, watermark: dt.datetime | None) -> TableSource:
        """The source without the partitions that hold no row changed since the watermark.

        The first scan filters raw rows by change time, which file statistics answer for
        old files; only the ranges of the partitions it finds are then counted. A table
        without a watermark, a change time or partitions is read whole.
        """
        if None in (watermark, source.modified_on, source.partition_on):
            return source
        changed = F.col(source.modified_on)
        kind = source.frame.schema[source.modified_on].dataType
        # Not strict, as a date drops the time of day; the exact filter follows on the counts.
        late = changed >= F.lit(watermark).cast("timestamp_ntz").cast(kind)
        rows = replace(source, frame=source.frame.where(late | changed.isNull()))
        touched = discovery.discover(replace(rows, modified_on=None)).select("partition_id")
        return replace(source, frame=export.within_spans(source, export.planned_spans(source, touched)))

    def _count_written(self, targets: list[str], run_id: str) -> DataFrame:
        """Rows by file and partition of all tables the run wrote, from one narrow scan."""
        rows = (
            self.spark.read.schema(LAYOUT).option("basePath", f"{self.root}/data").parquet(*targets)
        )
        by = [*TABLE_KEY, "schema_version", "batch", "partition_id"]
        counted = files.rows_per_file(rows, self.root, *by)
        return stored(counted, "written", f"{self.root}/runs/{run_id}/written", "overwrite")

    def _mismatches(
        self, plan: DataFrame, counted: DataFrame, names: Sequence[str]
    ) -> dict[str, str]:
        """Written tables whose partitions differ from what was planned."""
        # Shards without rows are planned to be retired and are in no file.
        expected = plan.where(F.concat_ws(".", *TABLE_KEY).isin(list(names)) & (F.col("total_rows") > 0))
        exported = counted.groupBy(*KEY).agg(F.sum("row_count").alias("row_count"))
        compared = verify.compare_counts(
            expected.select(*KEY, F.col("total_rows").alias("row_count")), exported, KEY
        )
        wrong = (
            compared.where("not matches").groupBy(*TABLE_KEY).agg(F.count(F.lit(1)).alias("n")).collect()
        )
        return {
            f"{r['dataset']}.{r['table']}": f"{r['n']} partitions differ from their plan" for r in wrong
        }

    def _publish(
        self,
        plan: DataFrame,
        counted: DataFrame,
        written: dict[str, str],
        failed: dict[str, str],
        versions: dict[str, int],
        run_id: str,
        at: Column,
        resumed: bool,
    ) -> None:
        """Manifest and partition rows of the tables that were written as planned."""
        good = [target for name, target in written.items() if name not in failed]
        if not good:
            return
        name = F.concat_ws(".", *TABLE_KEY)
        names = [n for n in written if n not in failed]
        listed = counted.where(~F.concat_ws(".", *TABLE_KEY).isin(list(failed))) if failed else counted
        in_storage = files.checksums(self.spark, self.root, good)
        entries = manifest.build(in_storage, listed).withColumns(
            {
                "dataset": F.regexp_extract("path", "/?dataset=([^/]+)/", 1),
                "table": F.regexp_extract("path", "/table=([^/]+)/", 1),
                "schema_version": F.regexp_extract("path", "/schema_version=v([0-9]+)/", 1).cast("int"),
                "run_id": F.lit(run_id),
                "exported_at": at,
            }
        )
        if resumed:
            entries = entries.join(self._listed().where(F.col("run_id") == run_id).select("path"), "path", "left_anti")
        entries.write.mode("append").json(f"{self.root}/manifest")
        sums = listed.groupBy(*KEY).agg(F.sum("row_count").alias("row_count"))
        known = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(versions[n]))])
        planned = plan.where(name.isin(names)).select(
            *KEY, "project", "batch", "last_modified", "fingerprint", F.col("total_logical_bytes").alias("logical_bytes")
        )
        state = planned.join(sums, KEY, "left").withColumns(
            {
                "row_count": F.coalesce("row_count", F.lit(0)),
                "schema_version": known[name],
            }
        )
        state = state.withColumns(
            {
                "run_id": F.lit(run_id),
                "state": F.lit("completed"),
                "at": at,
                "exported_modified": F.col("last_modified"),
                "snapshot_time": at,
                "synced_at": at,
                "exported_path": F.concat(
                    ids.export_path(
                        F.col("dataset"), F.col("table"), F.col("schema_version"),
                        F.lit(f"run={run_id}/batch="),
                    ),
                    F.col("batch"),
                ),
            }
        )
        self._add("partitions", state, [*KEY, "state"], run_id, resumed)

    def _record_failures(
        self,
        plan: DataFrame,
        failed: dict[str, str],
        versions: dict[str, int],
        run_id: str,
        at: Column,
        resumed: bool,
    ) -> None:
        errors = self.spark.createDataFrame(
            [(*name.split(".", 1), versions[name], error) for name, error in failed.items()],
            "dataset string, table string, schema_version int, error string",
        )
        planned = plan.select("project", *KEY)
        rows = join_per_key(planned, errors, TABLE_KEY, "inner")
        rows = rows.withColumns({"run_id": F.lit(run_id), "state": F.lit("failed"), "at": at})
        self._add("partitions", rows, [*KEY, "state"], run_id, resumed)

    def _record_tables(
        self,
        sources: Sequence[TableSource],
        plan: DataFrame,
        run_id: str,
        failed: dict[str, str],
        versions: dict[str, int],
        now: str,
        resumed: bool,
    ) -> None:
        """Append a row for each table that is new or whose watermark or version moved."""
        name = F.concat_ws(".", "dataset", "table")
        outcome = plan.withColumn("committed", ~name.isin(list(failed)) if failed else F.lit(True))
        before = self.ledgers.latest("tables").select(*TABLE_KEY, "watermark", "schema_version")
        marks = incremental.advance_watermark(
            outcome.unionByName(
                before.drop("schema_version").withColumn("committed", F.lit(True)),
                allowMissingColumns=True,
            )
        )
        listed = self.spark.createDataFrame(
            [(s.project, s.dataset, s.table, versions[s.name]) for s in sources],
            "project string, dataset string, table string, schema_version int",
        )
        known = before.select(
            *TABLE_KEY,
            F.struct("watermark", "schema_version").alias("_before"),
        )
        state = F.struct("watermark", "schema_version")
        moved = (
            listed.join(marks, TABLE_KEY, "left")
            .join(known, TABLE_KEY, "left")
            .where(~state.eqNullSafe(F.col("_before")))
        )
        moved = moved.drop("_before").withColumns(
            {"run_id": F.lit(run_id), "at": F.lit(now).cast("timestamp_ntz")}
        )
        self._add("tables", moved, TABLE_KEY, run_id, resumed)

    # -- readers ---------------------------------------------------------------

    def manifest(self) -> DataFrame:
        """Files that hold present rows, with the number of those; ``superseded`` is the rest.

        A partition that was exported again counts in its newest run only. The rows by file
        and partition that each run counted tell what is left of a file.
        """
        listed = self.published()
        counted = self.written_files()
        if counted is None:
            return listed.withColumn("superseded", F.lit(0).cast("bigint"))
        current = self.ledgers.latest("partitions").select(*KEY, "run_id")
        run = F.regexp_extract("path", "/run=([^/]+)/", 1)
        live = (
            counted.withColumn("run_id", run)
            .join(current, ["run_id", *KEY], "left_semi")
            .groupBy("path")
            .agg(F.sum("row_count").alias("live"))
        )
        return listed.join(live, "path").select(
            *[c for c in listed.columns if c != "row_count"],
            F.col("live").alias("row_count"),
            (F.col("row_count") - F.col("live")).alias("superseded"),
        )

    def written_files(self) -> DataFrame | None:
        """Rows by file and partition of all runs, published or not; None before the first."""
        schema = "dataset string, table string, schema_version string, batch string, partition_id string, row_count bigint, path string"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/runs/*/written")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def published(self) -> DataFrame:
        """Files of published runs, also those whose rows were all exported again."""
        listed = self._listed()
        done = self.ledgers.committed("partitions").where("state = 'completed'")
        return listed.join(
            done.select("run_id", *TABLE_KEY).distinct(), ["run_id", *TABLE_KEY], "left_semi"
        )

    def _listed(self) -> DataFrame:
        """Manifest entries of all runs, published or not."""
        try:
            return self.spark.read.schema(manifest.MANIFEST).json(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], manifest.MANIFEST)

    def _schemas(self, source: TableSource) -> dict[int, T.StructType]:
        """Recorded schemas of a table by version."""
        mine = ledger.table_state(self.ledgers.committed("versions"), source.dataset, source.table)
        rows = mine.where("schema_json is not null").select("version", "schema_json").collect()
        return {r["version"]: T.StructType.fromJson(json.loads(r["schema_json"])) for r in rows}

    def in_force(self, source: TableSource) -> int | None:
        row = ledger.table_state(self.current_versions(), source.dataset, source.table).first()
        return row["current_version"] if row else None

    def read(
        self,
        source: TableSource,
        version: int | None = None,
        strict: bool = True,
        only: Sequence[str] | None = None,
    ) -> DataFrame:
        """Present rows of a table as its readers see them, of all its files or of those named.

        Without a version, all versions are read, each in the schema recorded for it, and
        cast to the schema in force: the newest that is not breaking or is acknowledged.
        Strict casts fail on a value that does not fit; others make it null.
        """
        current = self.ledgers.latest("partitions")
        schemas = self._schemas(source)
        mine = ledger.table_state(current, source.dataset, source.table)
        if version is None:
            found = [r[0] for r in mine.select("schema_version").distinct().collect()]
        else:
            found = [version]
        named = {v: only and [p for p in only if f"/schema_version=v{v}/" in p] for v in found}
        if only is not None:
            found = [v for v in found if named[v]]
        pieces = [
            export.read_published(
                self.spark, self.root, source.dataset, source.table, v, current, schemas.get(v), named[v]
            )
            for v in sorted(found)
        ]
        wanted = version if version is not None else self.in_force(source)
        target = schemas.get(wanted, source.frame.schema)
        if not pieces:  # never exported, or no file is asked for
            return self.spark.createDataFrame([], target)
        return unify.unify(pieces, target, strict)

    def summary(self) -> DataFrame:
        tables = self.ledgers.latest("tables").select(
            "dataset", "table", "schema_version", F.col("at").alias("last_sync")
        )
        sizes = manifest.totals(self.manifest()).select("dataset", "table", "stored_bytes")
        parts = self.ledgers.latest("partitions").withColumn("bytes", F.lit(0))
        counted = report.summary(tables, parts).drop("total_bytes")
        return counted.join(sizes, ["dataset", "table"], "left").select(
            *counted.columns, F.coalesce("stored_bytes", F.lit(0)).alias("total_bytes")
        )

    def late(self, sources: Sequence[TableSource]) -> DataFrame:
        """Exported partitions that have changed since they were read."""
        return incremental.late_partitions(
            discovery.discover_all(sources), self.ledgers.latest("partitions")
        )

    def verify(self, source: TableSource, rate: float = 1.0) -> DataFrame:
        """Row counts of source and lake by partition, or of a repeatable sample of partitions.

        A sample is drawn from the exported partitions, and only their ranges are read on
        both sides. Partitions that were never exported show up at rate 1 only.
        """
        lake_side = replace(source, frame=self.read(source))
        if rate < 1 and source.partition_on is not None:
            known = ledger.table_state(self.ledgers.latest("partitions"), source.dataset, source.table)
            picked = verify.sampled(known.select("partition_id"), rate)
            spans = export.planned_spans(source, stored(picked, "picked"))
            source, lake_side = (replace(s, frame=export.within_spans(s, spans)) for s in (source, lake_side))
        counts = [verify.count_partitions(side) for side in (source, lake_side)]
        return verify.compare_counts(*[verify.sampled(side, rate) for side in counts])

    def sketch(self, source: TableSource, columns: Sequence[str]) -> None:
        """Sketch the named columns of the partitions that were exported since they were last sketched.

        Only ranges of those partitions are read. A partition that is exported again is
        sketched again; readers take the sketch of its newest export.
        """
        folder = self._sketch_dir(source)
        present = self._present(source)
        known = self._sketched(source).groupBy("run_id", "partition_id").agg(F.collect_set("column").alias("known"))
        lacking = F.size(F.array_except(F.array(*[F.lit(c) for c in columns]), F.coalesce("known", F.array().cast("array<string>"))))
        stale = stored(
            present.join(known, ["run_id", "partition_id"], "left").where(lacking > 0).select("run_id", "partition_id"), "stale"
        )
        if stale.isEmpty():
            return
        lake_side = replace(source, frame=self.read(source))
        if source.partition_on is not None:
            lake_side = replace(lake_side, frame=export.within_spans(lake_side, export.planned_spans(source, stale)))
        rows = lake_side.frame.withColumn("partition_id", lake_side.partition_id())
        built = sketches.build(join_per_key(rows, stale, ["partition_id"], "inner"), ["run_id", "partition_id"], columns)
        built.write.mode("append").parquet(folder)

    def sketches(self, source: TableSource) -> DataFrame:
        """Sketches of a table's present partitions: one row per partition and column."""
        mine = self._sketched(source).join(self._present(source), ["run_id", "partition_id"], "left_semi")
        # A column named in two calls for one export has two sketches of the same rows.
        return mine.dropDuplicates(["partition_id", "column"])

    def _present(self, source: TableSource) -> DataFrame:
        mine = ledger.table_state(self.ledgers.latest("partitions"), source.dataset, source.table)
        return mine.where("row_count > 0").select("run_id", "partition_id")

    def _sketch_dir(self, source: TableSource) -> str:
        return f"{self.root}/sketches/{export.safe_name(source.dataset)}/{export.safe_name(source.table)}"

    def _sketched(self, source: TableSource) -> DataFrame:
        try:
            return self.spark.read.schema(sketches.SCHEMA).parquet(self._sketch_dir(source))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], sketches.SCHEMA)

    def map_zones(self, source: TableSource, columns: Sequence[str], filtered: Sequence[str] = ()) -> None:
        """Keep bounds and null counts of the named columns, and Bloom filters of some of them, by file.

        Only files without them are read, and only these columns. Filters are written before
        bounds, which say that a file is mapped: a call that dies is made again. What the
        driver holds is the names of the files to read, as Spark's own listing does.
        """
        columns = list(dict.fromkeys([*columns, *filtered]))
        found, pages = self._zones(source)
        known = found.groupBy("path").agg(
            F.collect_set("column").alias("_known"),
            F.collect_set(F.when(F.col("pages").isNotNull(), F.col("column"))).alias("_filtered"),
        )
        schemas = self._schemas(source)
        listed = self._files_of(source).join(known, "path", "left")
        for version, schema in sorted(schemas.items()):
            mine = [c for c in columns if c in schema.fieldNames()]
            hashed = [c for c in filtered if c in mine]
            if not mine:
                continue
            lacks = [~F.coalesce(F.array_contains(name, c), F.lit(False)) for name, cs in (("_known", mine), ("_filtered", hashed)) for c in cs]
            new = listed.where(F.col("schema_version") == version).where(F.greatest(*lacks, F.lit(False)))
            paths = [f"{self.root}/{r[0]}" for r in new.select("path").collect()]
            if not paths:
                continue
            rows = self.spark.read.schema(schema).parquet(*paths).select(*mine)
            bounds = stored(zonemaps.bounds(rows, self.root, mine, hashed), "bounds")
            for c in hashed:
                zonemaps.filters(rows, bounds, c).write.mode("append").parquet(f"{self._zone_dir(source)}/filters")
            bounds.drop("file").write.mode("append").parquet(f"{self._zone_dir(source)}/bounds")

    def files_for(self, source: TableSource, *needs: zonemaps.Need) -> DataFrame:
        """Paths of the files that can hold rows which meet all needs; files that are not mapped are among them."""
        types = {f.name: f.dataType for f in self._target(source).fields}
        paths = self._files_of(source).select("path")
        found, pages = self._zones(source)
        for need in needs:
            if need.column not in types:
                raise ValueError(f"the table has no column {need.column!r}")
            paths = zonemaps.prune(paths, found, pages, need, types[need.column])
        return paths

    def read_where(self, source: TableSource, *needs: zonemaps.Need) -> DataFrame:
        """Rows that meet all needs, as ``read`` with a filter gives them, from ``files_for`` alone."""
        only = [r[0] for r in self.files_for(source, *needs).collect()]
        rows = self.read(source, only=only)
        for need in needs:
            rows = rows.where(need.matches(rows.schema[need.column].dataType))
        return rows

    def _target(self, source: TableSource) -> T.StructType:
        """The schema that readers of a table see."""
        return self._schemas(source).get(self.in_force(source), source.frame.schema)

    def _files_of(self, source: TableSource) -> DataFrame:
        return ledger.table_state(self.manifest(), source.dataset, source.table)

    def _zone_dir(self, source: TableSource) -> str:
        return f"{self.root}/zones/{export.safe_name(source.dataset)}/{export.safe_name(source.table)}"

    def _zones(self, source: TableSource) -> tuple[DataFrame, DataFrame]:
        """Bounds and filter pages of a table's files, mapped so far."""
        out = []
        for name, schema in (("bounds", zonemaps.BOUNDS), ("filters", zonemaps.FILTERS)):
            try:
                out.append(self.spark.read.schema(schema).parquet(f"{self._zone_dir(source)}/{name}"))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                out.append(self.spark.createDataFrame([], schema))
        return out[0], out[1]

    def orphans(self, now: str) -> DataFrame:
        """Data files over a day old that no published run lists."""
        stored = files.inventory(self.spark, f"{self.root}/data").withColumn(
            "path", F.concat(F.lit("data/"), "path")
        )
        return manifest.orphans(stored, self.published(), F.lit(now).cast("timestamp"))

    def remove_orphans(self, now: str) -> int:
        """Delete the directories of runs that were never published; returns their number.

        Only whole run directories go, of which a dead run has one per table. A run that is
        not closed and has written in any table within a day may be going on: it keeps all
        its files however old they are.
        """
        run = F.regexp_extract("path", "^(.*/run=[^/]+)/", 1).alias("run")
        listed = self.published().select(run).distinct()
        found = files.inventory(self.spark, f"{self.root}/data")
        young = F.col("modified") >= F.lit(now).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
        active = found.where(young).select(F.regexp_extract("path", "/run=([^/]+)/", 1).alias("run_id"))
        running = self.ledgers.latest("runs").where("state = 'running'")
        going = running.join(active.distinct(), "run_id", "left_semi").select("run_id")
        dead = self.orphans(now).select(run).distinct().join(listed, "run", "left_anti")
        dead = dead.withColumn("run_id", F.regexp_extract("run", "run=([^/]+)$", 1)).join(going, "run_id", "left_anti")
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        removed = 0
        for row in dead.toLocalIterator():
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{row['run']}")
            removed += path.getFileSystem(conf).delete(path, True)
        return removed

    def acknowledge(self, dataset: str, table: str, version: int, now: str) -> None:
        """Accept a breaking version as the table's present one."""
        row = self.spark.createDataFrame(
            [(dataset, table, version)], "dataset string, table string, version bigint"
        )
        self.ledgers.append("acks", row.withColumn("at", F.lit(now).cast("timestamp_ntz")))

    def current_versions(self) -> DataFrame:
        """Version in force and latest version of each table."""
        return registry.current_version(self.ledgers.committed("versions"), self.ledgers.read("acks"))

    # -- full export -----------------------------------------------------------

    def export_full(self, source: TableSource, now: str) -> str:
        """Write a whole table to a directory named after the run's time."""
        at = self.spark.range(1).select(ids.run_stamp(F.lit(now).cast("timestamp_ntz")))
        target = export.full_dir(self.root, source, at.first()[0])
        export.export_full(source.frame, target, self.layout)
        return target

