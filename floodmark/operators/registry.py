"""Schema registry: fingerprints, differences, classification and versions of table schemas.

A schema is held flat, one row per field, so that all tables are handled by the same
few jobs. The only value built per schema is its canonical text; a schema has to fit
the driver's analyser anyway before its table can be read.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.functions import classify
from floodmark.operators.keyed import KEY_HASH, count_changes, with_key_hash
from floodmark.session import stored

TABLE_KEY = ["dataset", "table"]
REGISTRY = (
    "dataset string, table string, version bigint, path string, parent string, "
    "name string, type string, mode string, description string, depth int"
)


def field_type(dtype: T.DataType) -> str:
    """Warehouse type name of a Spark type."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "INT64"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "FLOAT64"
    if isinstance(dtype, T.DecimalType):
        small = dtype.scale <= 9 and dtype.precision - dtype.scale <= 29
        return "NUMERIC" if small else "BIGNUMERIC"
    names = {
        T.StringType: "STRING",
        T.BinaryType: "BYTES",
        T.BooleanType: "BOOL",
        T.TimestampType: "TIMESTAMP",
        T.TimestampNTZType: "DATETIME",
        T.DateType: "DATE",
        T.StructType: "RECORD",
        T.VariantType: "JSON",
    }
    for cls, name in names.items():
        if isinstance(dtype, cls):
            return name
    return dtype.simpleString().upper()


def flatten(schema: T.StructType, modes: dict[str, str] | None = None) -> list[tuple]:
    """Fields of a schema as ``(path, parent, name, type, mode, description, depth)``.

    Spark reads every column of a file as nullable, so REQUIRED has to be told in ``modes``.
    """
    rows = []

    def visit(struct: T.StructType, parent: str, depth: int) -> None:
        for f in struct.fields:
            path = f"{parent}.{f.name}" if parent else f.name
            dtype, mode = f.dataType, "NULLABLE"
            if isinstance(dtype, T.ArrayType):
                dtype, mode = dtype.elementType, "REPEATED"
            mode = (modes or {}).get(path, mode)
            comment = (f.metadata or {}).get("comment", "")
            rows.append((path, parent, f.name, field_type(dtype), mode, comment, depth))
            if isinstance(dtype, T.StructType):
                visit(dtype, path, depth + 1)

    visit(schema, "", 0)
    return rows


def registry_rows(
    spark: SparkSession, schemas: Sequence[tuple[str, str, int, T.StructType]]
) -> DataFrame:
    """Registry of some tables from ``(dataset, table, version, schema)``."""
    rows = [(d, t, v, *field) for d, t, v, s in schemas for field in flatten(s)]
    return spark.createDataFrame(rows, REGISTRY)


def _mode(column: str = "mode") -> Column:
    """Mode of a field; an empty one means NULLABLE."""
    return F.when(F.coalesce(column, F.lit("")) == "", F.lit("NULLABLE")).otherwise(F.col(column))


def canonical_text(listed: Column, mode: str) -> Column:
    """Canonical text of one schema from its fields sorted by path components.

    That order lists the fields depth first, with siblings in byte order of their names.
    The step in depth from one field to the next tells which brackets stand between them,
    so nesting needs neither recursion nor a join.
    """
    nul = F.char(F.lit(0))

    def with_brackets(entry: Column, i: Column) -> Column:
        depth = F.size(entry["at"])
        before = F.size(F.get(listed, i - 1)["at"])
        lead = (
            F.when(i == 0, F.lit(""))
            .when(depth > before, F.concat(nul, F.lit("{")))
            .otherwise(F.concat(F.repeat(F.lit("}"), before - depth), nul))
        )
        return F.concat(lead, F.concat_ws("\0", entry["name"], entry["type"], entry[mode]))

    closing = F.repeat(F.lit("}"), F.size(F.element_at(listed, -1)["at"]) - 1)
    return F.concat(F.array_join(F.transform(listed, with_brackets), ""), closing)


def fingerprints(fields: DataFrame, by: Sequence[str] = ("dataset", "table", "version")) -> DataFrame:
    """SHA-256 of each schema, whatever the order and the descriptions of its fields.

    ``shape_hash`` leaves the mode out apart from REPEATED: two schemas with equal shape
    have no difference that asks for a new version.
    """
    repeated = F.col("mode") == "REPEATED"
    field = F.struct(
        F.split("path", r"\.").alias("at"),
        "name",
        "type",
        F.coalesce("mode", F.lit("")).alias("mode"),
        F.when(repeated, F.lit("REPEATED")).otherwise(F.lit("")).alias("shape"),
    )
    listed = fields.groupBy(*by).agg(F.array_sort(F.collect_list(field)).alias("_fields"))
    return listed.select(
        *by,
        F.sha2(canonical_text(F.col("_fields"), "mode"), 256).alias("schema_hash"),
        F.sha2(canonical_text(F.col("_fields"), "shape"), 256).alias("shape_hash"),
        F.size("_fields").cast("bigint").alias("n_fields"),
    )


def diff(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str] = TABLE_KEY,
    mode_flips_break: bool = False,
    use_aliases: bool = False,
) -> DataFrame:
    """Field changes between two schemas of each table: ADD, DROP, TYPE_CHANGE.

    Below an added, dropped or retyped record nothing is reported. Both sides are shuffled
    once, by key, or not at all where they are laid out by key already; fields then meet in
    the order of their paths, so nothing is written in between. ``mode_flips_break`` also
    reports NULLABLE to REPEATED and back, as MODE_CHANGE.
    """
    key = list(key)

    def side(fields: DataFrame, name: str) -> DataFrame:
        dtype = classify.standard_type(F.col("type")) if use_aliases else F.col("type")
        field = F.struct(dtype.alias("type"), _mode().alias("mode"))
        # Null keys and paths equal none: their rows are groups of their own, the last bit tells the sides apart.
        nameless = F.greatest(*[F.col(c).isNull() for c in [*key, "path"]])
        alone = F.shiftleft(F.xxhash64("path", field), 1).bitwiseOR(F.lit(int(name == "_new")))
        rows = with_key_hash(fields.withColumn("_apart", F.when(nameless, alone)), key)
        sides = [(field if c == name else F.lit(None)).alias(c) for c in ("_old", "_new")]
        return rows.select(KEY_HASH, *key, "_apart", F.concat("path", F.lit(".")).alias("_at"), *sides)

    # Bytewise, all that lies below a path p is between p + "." and p + "/".
    schema = Window.partitionBy(KEY_HASH, *key, "_apart").orderBy("_at")
    same_path = schema.rangeBetween(Window.currentRow, Window.currentRow)
    fields = side(old, "_old").unionAll(side(new, "_new"))
    met = fields.withColumns(
        {"_news": F.collect_list("_new").over(same_path), "_olds": F.count("_old").over(same_path)}
    ).where(F.col("_old").isNotNull() | (F.col("_olds") == 0))
    theirs = F.when(F.col("_old").isNotNull(), F.col("_news")).otherwise(F.array("_new"))
    pairs = met.withColumn("_new", F.explode_outer(theirs)).select(
        KEY_HASH, *key, "_apart", "_at",
        F.substring("_at", F.lit(1), F.length("_at") - 1).alias("path"),
        F.col("_old.type").alias("before_type"), F.col("_old.mode").alias("before_mode"),
        F.col("_new.type").alias("after_type"), F.col("_new.mode").alias("after_mode"),
    )
    repeated_flip = (F.col("before_mode") == "REPEATED") != (F.col("after_mode") == "REPEATED")
    change = (
        F.when(F.col("before_type").isNull(), F.lit("ADD"))
        .when(F.col("after_type").isNull(), F.lit("DROP"))
        .when(F.col("before_type") != F.col("after_type"), F.lit("TYPE_CHANGE"))
    )
    if mode_flips_break:
        change = change.when(repeated_flip, F.lit("MODE_CHANGE"))
    changed = pairs.withColumn("change", change).where(F.col("change").isNotNull())
    end = F.concat("path", F.lit("/"))
    # An ancestor's end lies beyond a path's own; that of any other path before it does not.
    reach = F.max(F.when(F.col("change") != "MODE_CHANGE", end)).over(schema)
    covered = changed.withColumn("_covered", F.coalesce(reach > end, F.lit(False)))
    widening = classify.is_widening(F.col("before_type"), F.col("after_type"))
    breaking = (
        F.when(F.col("change") == "ADD", ~F.col("after_mode").isin("NULLABLE", "REPEATED"))
        .when(F.col("change") == "TYPE_CHANGE", ~F.col("widening"))
        .otherwise(F.lit(True))
    )
    return (
        covered.where(~F.col("_covered"))
        .withColumn("widening", (F.col("change") == "TYPE_CHANGE") & widening)
        .withColumn("breaking", breaking)
        .select(
            *key, "path", "change", "before_type", "after_type", "before_mode", "after_mode",
            "widening", "breaking",
        )
    )


def classify_changes(
    changes: DataFrame, tables: DataFrame | None = None, key: Sequence[str] = TABLE_KEY
) -> DataFrame:
    """Change type by table; with ``tables``, those without a change are listed as NONE."""
    key = list(key)
    counted = changes.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_changes"),
        F.max("breaking").alias("_breaking"),
        F.max("widening").alias("_widened"),
    )
    if tables is not None:
        counted = tables.select(*key).distinct().join(counted, key, "left")
    return counted.select(
        *key,
        F.coalesce("n_changes", F.lit(0)).alias("n_changes"),
        classify.change_type(F.col("n_changes"), F.col("_breaking")).alias("change_type"),
        F.coalesce("_widened", F.lit(False)).alias("widened"),
    )


def version_history(observed: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Versions of each table from its schemas observed over time.

    ``observed`` has field rows with ``observed_at``. A version lasts from the first
    observation of a shape until the next shape. Its end is the start of the following
    version, found by equality on the version number.
    """
    # Numbering and the look-up of the following version read the fingerprints repeatedly.
    seen = stored(fingerprints(observed, [*TABLE_KEY, "observed_at"]), "seen")
    numbered = count_changes(
        seen,
        TABLE_KEY,
        order="observed_at",
        value="shape_hash",
        bucket=F.date_trunc("month", "observed_at") if bucket is None else bucket,
        out="version",
    )
    versions = numbered.where("is_change").select(
        *TABLE_KEY, "version", "schema_hash", "n_fields", F.col("observed_at").alias("valid_from")
    )
    following = versions.select(
        *TABLE_KEY,
        (F.col("version") - 1).alias("version"),
        F.col("valid_from").alias("valid_until"),
    )
    return versions.join(following, [*TABLE_KEY, "version"], "left")


def classify_history(
    observed: DataFrame, history: DataFrame, mode_flips_break: bool = True
) -> DataFrame:
    """Change type of each version against the one before it; the first one is INITIAL."""
    key = [*TABLE_KEY, "version"]
    history = stored(history, "history")
    starts = history.select(*key, F.col("valid_from").alias("observed_at"))
    fields = stored(observed.join(starts, [*TABLE_KEY, "observed_at"]), "fields")
    earlier = fields.withColumn("version", F.col("version") + 1)
    # The newest version has no successor and the first no predecessor.
    later = history.where(F.col("version") > 1).select(*key)
    pairs = earlier.join(later, key, "left_semi"), fields.join(later, key, "left_semi")
    changes = diff(*pairs, key=key, mode_flips_break=mode_flips_break)
    named = classify_changes(changes, history, key)
    first = F.col("version") == 1
    return history.join(named, key).withColumn(
        "change_type", F.when(first, F.lit("INITIAL")).otherwise(F.col("change_type"))
    )


def current_version(versions: DataFrame, acks: DataFrame) -> DataFrame:
    """Version in force: the newest that is not BREAKING or has been acknowledged."""
    key = [*TABLE_KEY, "version"]
    acked = acks.select(*key).distinct().withColumn("_acked", F.lit(True))
    usable = (F.col("change_type") != "BREAKING") | F.coalesce("_acked", F.lit(False))
    return (
        versions.join(acked, key, "left")
        .groupBy(*TABLE_KEY)
        .agg(
            F.max(F.when(usable, F.col("version"))).alias("current_version"),
            F.max("version").alias("latest_version"),
        )
    )


def physical_hash(schema: T.StructType) -> str:
    """Names the stored types of a schema, whatever the order of its fields.

    Warehouse types are wider: INT and BIGINT are both INT64, but a file of one cannot be
    read as the other, so they must not lie under one version.
    """

    def listed(dtype: T.DataType) -> str:
        if isinstance(dtype, T.StructType):
            return "{" + ",".join(sorted(f"{f.name}:{listed(f.dataType)}" for f in dtype.fields)) + "}"
        if isinstance(dtype, T.ArrayType):
            return f"[{listed(dtype.elementType)}]"
        return dtype.simpleString()

    return sha256(listed(schema).encode()).hexdigest()


def resolve(today: DataFrame, stored: DataFrame, physical: DataFrame | None = None) -> DataFrame:
    """Version of each table's present schema against its latest stored version.

    A table seen for the first time is at version 1, an unchanged shape keeps its version,
    any other shape is the next version. ``physical`` has one row per table with its
    ``physical_hash``: a change of stored types alone is a version too, marked ``retyped``.
    ``is_new`` marks versions to be recorded.
    """
    known = stored.select(
        *TABLE_KEY, F.col("version").alias("_version"), F.col("shape_hash").alias("_shape")
    )
    found = fingerprints(today, TABLE_KEY)
    shaped = F.col("_shape") == F.col("shape_hash")
    retyped = F.lit(False)
    if physical is not None:
        found = found.join(physical.select(*TABLE_KEY, "physical_hash"), TABLE_KEY, "left")
        known = known.join(
            stored.select(*TABLE_KEY, F.col("physical_hash").alias("_physical")), TABLE_KEY
        )
        retyped = shaped & (F.col("_physical") != F.col("physical_hash"))
    same = shaped & ~F.coalesce(retyped, F.lit(False))
    return (
        found.join(known, TABLE_KEY, "left")
        .withColumn(
            "version",
            F.when(F.col("_version").isNull(), F.lit(1))
            .when(same, F.col("_version"))
            .otherwise(F.col("_version") + 1)
            .cast("bigint"),
        )
        .withColumn("is_new", F.col("_version").isNull() | ~same)
        .withColumn("retyped", F.coalesce(retyped, F.lit(False)))
        .drop("_version", "_shape", "_physical")
    )


def describe_new(resolved: DataFrame, today: DataFrame, stored_fields: DataFrame) -> DataFrame:
    """Change type and number of changes of the versions that :func:`resolve` found new.

    Without any stored fields all of them are first versions.
    """
    new = resolved.where("is_new")
    if stored_fields.isEmpty():
        return new.withColumns(
            {"change_type": F.lit("INITIAL"), "n_changes": F.lit(0), "widened": F.lit(False)}
        )
    later = new.where("version > 1").select(*TABLE_KEY, "version")
    before = stored_fields.withColumn("version", F.col("version") + 1).join(
        later, [*TABLE_KEY, "version"], "left_semi"
    )
    after = today.join(later, TABLE_KEY)
    key = [*TABLE_KEY, "version"]
    changes = diff(before, after, key=key, mode_flips_break=True)
    named = classify_changes(changes, new, key)
    return new.join(named, key).withColumn(
        "change_type",
        F.when(F.col("version") == 1, F.lit("INITIAL")).otherwise(F.col("change_type")),
    )


def rename_candidates(changes: DataFrame, key: Sequence[str] = TABLE_KEY) -> DataFrame:
    """Dropped and added fields that could be one renamed field.

    A pair is reported only where the parent lost exactly one field of a type and gained
    exactly one; anything else is ambiguous and is reported as counts, so no group is
    ever paired with itself.
    """
    key = list(key)
    parent = F.regexp_extract("path", r"^(.*)\.[^.]*$", 1)
    drop, add = F.col("change") == "DROP", F.col("change") == "ADD"
    return (
        changes.where(drop | add)
        .groupBy(
            *key, parent.alias("parent"), F.coalesce("before_type", "after_type").alias("type")
        )
        .agg(
            F.count_if(drop).alias("n_dropped"),
            F.count_if(add).alias("n_added"),
            F.min(F.when(drop, F.col("path"))).alias("_from"),
            F.min(F.when(add, F.col("path"))).alias("_to"),
        )
        .where((F.col("n_dropped") > 0) & (F.col("n_added") > 0))
        .withColumn("certain", (F.col("n_dropped") == 1) & (F.col("n_added") == 1))
        .select(
            *key, "parent", "type", "n_dropped", "n_added",
            F.when(F.col("certain"), F.col("_from")).alias("renamed_from"),
            F.when(F.col("certain"), F.col("_to")).alias("renamed_to"),
        )
    )
