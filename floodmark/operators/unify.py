"""Read across schema versions, rewrite old versions forward, and make types storable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the widest decimal that Spark and Parquet store.
MAX_PRECISION = 38


def _fit(column: Column, have: T.DataType, want: T.DataType, strict: bool) -> Column:
    """Value in the target type; struct fields match by name and missing ones are null."""
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        fields = [
            (
                _fit(column[f.name], types[f.name], f.dataType, strict)
                if f.name in types
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(column, lambda x: _fit(x, have.elementType, want.elementType, strict))
    if have == want:
        return column
    return column.cast(want) if strict else column.try_cast(want)


def conform(df: DataFrame, target: T.StructType, strict: bool = True) -> DataFrame:
    """The frame in the target's columns and types.

    Strict casts fail the job on a value that does not fit. Otherwise such a value
    becomes null and :func:`cast_failures` counts it.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (
                _fit(F.col(f"`{f.name}`"), types[f.name], f.dataType, strict)
                if f.name in types
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target.fields
        ]
    )


def cast_failures(df: DataFrame, target: T.StructType) -> DataFrame:
    """Number of values by column that the target type cannot hold."""
    types = {f.name: f.dataType for f in df.schema.fields}
    shared = [f for f in target.fields if f.name in types and types[f.name] != f.dataType]
    lost = [
        F.count_if(
            F.col(f"`{f.name}`").isNotNull()
            & _fit(F.col(f"`{f.name}`"), types[f.name], f.dataType, False).isNull()
        ).alias(f.name)
        for f in shared
    ]
    return df.agg(*(lost or [F.lit(0).alias("none")]))


def unify(versions: Sequence[DataFrame], target: T.StructType, strict: bool = True) -> DataFrame:
    """One frame over all versions of a table.

    Each version is read with its own schema and cast, because merging the file schemas
    refuses even an INT that became a BIGINT.
    """
    first, *rest = [conform(v, target, strict) for v in versions]
    for frame in rest:
        first = first.unionByName(frame)
    return first


def rewrite_forward(df: DataFrame, target: T.StructType) -> DataFrame:
    """Rows of an old version in the new schema; refused if the new one dropped a column."""

    def dropped(have: T.StructType, want: T.StructType, prefix: str) -> list[str]:
        kept = {f.name: f.dataType for f in want.fields}
        lost = []
        for f in have.fields:
            if f.name not in kept:
                lost.append(prefix + f.name)
            elif isinstance(f.dataType, T.StructType) and isinstance(kept[f.name], T.StructType):
                lost += dropped(f.dataType, kept[f.name], f"{prefix}{f.name}.")
        return lost

    lost = dropped(df.schema, target, "")
    if lost:
        raise ValueError(f"cannot rewrite forward, dropped: {', '.join(lost)}")
    return conform(df, target)


def view_text(
    versions: Sequence[tuple[str, T.StructType]],
    target: T.StructType,
    renames: dict[str, str] | None = None,
) -> str:
    """SELECT over all versions of a table for a view.

    ``versions`` names a relation and its schema each. ``renames`` maps a new column to
    the old one it replaced: the new value is taken where a version has both.
    """
    branches = []
    for relation, schema in versions:
        have = set(schema.names)
        columns = []
        for f in target.fields:
            sources = [f"`{n}`" for n in (f.name, (renames or {}).get(f.name)) if n in have]
            value = "NULL" if not sources else sources[0]
            if len(sources) > 1:
                value = f"COALESCE({', '.join(sources)})"
            columns.append(f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`")
        branches.append(f"SELECT {', '.join(columns)} FROM {relation}")
    return "\nUNION ALL\n".join(branches)


def storable(df: DataFrame, big_decimals: str = "string") -> DataFrame:
    """Columns in types that Parquet files can hold.

    TIME becomes microseconds since midnight, intervals become months, days and
    microseconds, VARIANT becomes JSON text. ``big_decimals`` says what to do with
    decimals of more than 9 digits after the point: ``string``, ``double`` or ``decimal``.
    """
    if big_decimals not in ("string", "double", "decimal"):
        raise ValueError(f"unknown strategy {big_decimals!r} for big decimals")

    def convert(column: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.DecimalType) and dtype.scale > 9 and big_decimals != "decimal":
            return column.cast(big_decimals)
        if isinstance(dtype, T.TimeType):
            micros = F.time_diff(F.lit("MICROSECOND"), F.lit("00:00:00").cast("time(6)"), column)
            return micros.cast("bigint")
        if isinstance(dtype, T.YearMonthIntervalType):
            # An interval may lack its smaller fields, as INTERVAL DAY does.
            column = column.cast(T.YearMonthIntervalType(0, 1))
            months = F.extract(F.lit("YEAR"), column) * 12 + F.extract(F.lit("MONTH"), column)
            return _interval(column, months, F.lit(0), F.lit(0))
        if isinstance(dtype, T.DayTimeIntervalType):
            column = column.cast(T.DayTimeIntervalType(0, 3))
            seconds = F.extract(F.lit("SECOND"), column)
            micros = (
                F.extract(F.lit("HOUR"), column).cast("bigint") * 3_600_000_000
                + F.extract(F.lit("MINUTE"), column).cast("bigint") * 60_000_000
                + (seconds * 1_000_000).cast("bigint")
            )
            return _interval(column, F.lit(0), F.extract(F.lit("DAY"), column), micros)
        if isinstance(dtype, T.VariantType):
            return F.to_json(column)
        if isinstance(dtype, T.ArrayType):
            return F.transform(column, lambda x: convert(x, dtype.elementType))
        if isinstance(dtype, T.StructType):
            fields = [convert(column[f.name], f.dataType).alias(f.name) for f in dtype.fields]
            return F.when(column.isNotNull(), F.struct(*fields))
        return column

    return df.select(
        *[
            convert(F.col(f"`{f.name}`"), f.dataType).alias(f.name, metadata=f.metadata)
            for f in df.schema.fields
        ]
    )


def _interval(column: Column, months: Column, days: Column, micros: Column) -> Column:
    parts = F.struct(
        months.cast("int").alias("months"),
        days.cast("int").alias("days"),
        micros.cast("bigint").alias("micros"),
    )
    return F.when(column.isNotNull(), parts)


def range_value(low: Column, high: Column) -> Column:
    """A range with a null bound marked as unbounded."""
    return F.struct(
        low.alias("start"),
        high.alias("end"),
        low.isNull().alias("unbounded_low"),
        high.isNull().alias("unbounded_high"),
    )


def geography(column: Column, name: str) -> Column:
    """Well-known text of a place, marked as such in the column's metadata."""
    return column.cast("string").alias(name, metadata={"geo_format": "wkt"})
