"""Which files can hold a value: bounds, null counts and Bloom filters of each file's columns.

Bounds are kept in forms that keep order (a number as double, a text's first characters), so
a comparison that includes equality never leaves out a file it must read. A filter is cut
into pages by a hash of the value; each page has one bitmap for each of three hashes and
takes some 8,192 values, so filters grow with the file and a look-up reads one page of it.
Both are aggregates by file that combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.operators.keyed import first_per_key
from floodmark.sources.files import plain_text, relative_path

BOUNDS = """path string, column string, kind string, row_count bigint, nulls bigint,
 low_number double, high_number double, low_text string, high_text string, hashed_as string, pages bigint"""
FILTERS = "path string, column string, page bigint, bits array<binary>"

# Bits of a bitmap as Spark builds it, hashes, values a page takes for a false
# positive rate of 1.1 %, and characters of a text that bounds keep.
BITS = 32_768
HASHES = 3
PAGE_VALUES = 8_192
TEXT_BOUND = 64


@dataclass(frozen=True)
class Need:
    """Rows a reader wants by one column: from ``low`` to ``high`` (both included, either may be left out), or one of ``values``.

    A null value never matches. The values are part of the plan, so they are a list of some thousands at most.
    """

    column: str
    low: object = None
    high: object = None
    values: tuple | None = None

    def __post_init__(self) -> None:
        if (self.values is None) == (self.low is None and self.high is None):
            raise ValueError("a need has bounds or values")

    def matches(self, dtype: T.DataType) -> Column:
        column = F.col(f"`{self.column}`")
        if self.values is not None:
            return F.coalesce(column.isin([F.lit(v).cast(dtype) for v in self.values if v is not None]), F.lit(False))
        tests = [column >= F.lit(self.low).cast(dtype)] if self.low is not None else []
        tests += [column <= F.lit(self.high).cast(dtype)] if self.high is not None else []
        return F.coalesce(tests[0] if len(tests) == 1 else tests[0] & tests[1], F.lit(False))


def kind_of(dtype: T.DataType) -> str | None:
    """How bounds of a type are kept; None for types that have none."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return "number"
    kinds = {T.DateType: "date", T.TimestampType: "instant", T.TimestampNTZType: "wall", T.StringType: "text"}
    return kinds.get(type(dtype))


def _number(value: Column, dtype: T.DataType) -> Column:
    """A value as a double in the same order."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        start = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
        return F.timestamp_diff("MICROSECOND", start, value).cast("double")
    return value.cast("double")


def _hashed(value: Column, dtype: T.DataType) -> tuple[Column, str] | None:
    """A value as filters take it, and the name of that form: equal values are equal in it."""
    if isinstance(dtype, T.IntegralType):
        return value.cast("bigint"), "integer"
    if isinstance(dtype, T.StringType):
        return value, "text"
    if isinstance(dtype, (T.DateType, T.DecimalType)):
        return value.cast("string"), dtype.simpleString()
    return None


def _place(value: Column) -> tuple[Column, list[Column]]:
    """The hash that picks a value's page, and its place in each of the page's bitmaps."""
    places = [F.pmod(F.xxhash64(F.lit(i), value), F.lit(BITS)) for i in range(1, HASHES + 1)]
    return F.xxhash64(F.lit(0), value), places


def bounds(files: DataFrame, root: str, columns: Sequence[str], filtered: Sequence[str] = ()) -> DataFrame:
    """One row per file and column. ``file`` is the name the reader gave the file.

    ``files`` reads Parquet files; only the named columns are read, each once.
    """
    types = {f.name: f.dataType for f in files.schema.fields}
    aggregates, each = [F.count(F.lit(1)).alias("row_count")], []
    for i, name in enumerate(columns):
        dtype, value = types[name], F.col(f"`{name}`")
        kind = kind_of(dtype)
        if kind is None:
            raise ValueError(f"a column of type {dtype.simpleString()} has no bounds")
        ordered = F.left(value, F.lit(TEXT_BOUND)) if kind == "text" else _number(value, dtype)
        aggregates += [F.count(value).alias(f"_n{i}"), F.min(ordered).alias(f"_low{i}"), F.max(ordered).alias(f"_high{i}")]
        form = _hashed(value, dtype) if name in filtered else None
        if name in filtered and form is None:
            raise ValueError(f"a column of type {dtype.simpleString()} has no filter")
        text, number = (f"_low{i}", f"_high{i}"), (None, None)
        if kind != "text":
            text, number = number, text
        side = [F.col(c) if c else F.lit(None) for c in (*number, *text)]
        each.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("kind"),
                (F.col("row_count") - F.col(f"_n{i}")).alias("nulls"),
                side[0].cast("double").alias("low_number"),
                side[1].cast("double").alias("high_number"),
                side[2].cast("string").alias("low_text"),
                side[3].cast("string").alias("high_text"),
                F.lit(form[1] if form else None).cast("string").alias("hashed_as"),
                (F.ceil(F.col(f"_n{i}") / PAGE_VALUES) if form else F.lit(None)).cast("bigint").alias("pages"),
            )
        )
    found = files.groupBy(F.col("_metadata.file_path").alias("file")).agg(*aggregates)
    path = relative_path(plain_text(F.col("file")), root).alias("path")
    order = [c.strip().split(" ")[0] for c in BOUNDS.split(",")]
    return found.select("file", path, "row_count", F.inline(F.array(*each))).select("file", *order)


def filters(files: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """Pages of each file's filter of one column, as wide as ``bounds`` measured the file."""
    value, _ = _hashed(F.col(f"`{column}`"), files.schema[column].dataType)
    which, places = _place(F.col("v"))
    sized = found.where((F.col("column") == column) & (F.col("pages") > 0)).select("file", "path", "pages")
    rows = files.select(F.col("_metadata.file_path").alias("file"), value.alias("v")).where("v is not null")
    bits = [F.bitmap_construct_agg(p).alias(f"_b{i}") for i, p in enumerate(places)]
    return (
        rows.join(sized, "file")
        .groupBy("path", F.pmod(which, F.col("pages")).alias("page"))
        .agg(*bits)
        .select("path", F.lit(column).alias("column"), "page", F.array(*[f"_b{i}" for i in range(HASHES)]).alias("bits"))
    )


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def prune(paths: DataFrame, found: DataFrame, pages: DataFrame, need: Need, dtype: T.DataType) -> DataFrame:
    """Those of ``paths`` that can hold a row the reader needs.

    A file is left out only if its own bounds or filter rule the row out; a file without
    them, or with those of another type, stays.
    """
    mine = first_per_key(found.where(F.col("column") == need.column).drop("column"), ["path"], [F.coalesce(-F.col("pages"), F.lit(1))])
    kind = kind_of(dtype)
    if kind is None:
        return paths
    low, high = ("low_text", "high_text") if kind == "text" else ("low_number", "high_number")

    def form(value) -> Column:
        literal = F.lit(value).cast(dtype)
        return F.left(literal, F.lit(TEXT_BOUND)) if kind == "text" else _number(literal, dtype)

    wanted = None if need.values is None else [v for v in need.values if v is not None]
    if wanted is None:
        inside = F.lit(True)
        if need.low is not None:
            inside = inside & (F.col(high) >= form(need.low))
        if need.high is not None:
            inside = inside & (F.col(low) <= form(need.high))
    elif not wanted:
        return paths.limit(0)
    else:
        inside = F.exists(F.array(*[form(v) for v in wanted]), lambda v: (v >= F.col(low)) & (v <= F.col(high)))
    possible = (F.col("row_count") > F.col("nulls")) & inside
    same = F.col("kind").eqNullSafe(F.lit(kind))
    met = paths.join(mine, "path", "left").where(~same | F.coalesce(possible, F.lit(True)))
    hashed = _hashed(F.lit(None), dtype)
    if wanted is None or hashed is None:
        return met.select(*paths.columns)
    asked = []
    for v in wanted:
        which, places = _place(_hashed(F.lit(v).cast(dtype), dtype)[0])
        asked.append(F.struct(which.alias("which"), *[p.alias(f"p{i}") for i, p in enumerate(places)]))

    def hit(x: Column) -> Column:
        test = F.pmod(x["which"], F.col("pages")) == F.col("page")
        for i in range(HASHES):
            test = test & _is_set(F.col("bits")[i], x[f"p{i}"])
        return test

    mapped = F.col("pages").isNotNull() & same & F.col("hashed_as").eqNullSafe(F.lit(hashed[1]))
    filtered = met.where(mapped)
    held = pages.where(F.col("column") == need.column).drop("column")
    hits = filtered.select("path", "pages").join(held, "path").where(F.exists(F.array(*asked), hit)).select("path").distinct()
    return met.where(~mapped).select(*paths.columns).unionByName(filtered.select(*paths.columns).join(hits, "path", "left_semi"))
