"""Row text, digests, order-independent fingerprints and hash buckets.

Everything here uses MD5 and SHA-2, so another engine can recompute the same values.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose text never holds the separator.
PLAIN_TYPES = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _field_text(name: str, dtype: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(dtype, T.MapType):
        column = F.to_json(F.array_sort(F.map_entries(column)), {"ignoreNullFields": "false"})
    elif isinstance(dtype, (T.ArrayType, T.StructType)):
        column = F.to_json(column, {"ignoreNullFields": "false"})
    elif isinstance(dtype, T.BinaryType):
        column = F.hex(column)
    text = column.cast("string")
    if not isinstance(dtype, PLAIN_TYPES):
        # A length in front of each text keeps ('a|b', 'c') and ('a', 'b|c') apart.
        text = F.concat(F.char_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(text, F.lit("-"))


def row_text(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """One unambiguous text per row: values joined by ``|``, texts with their length in front."""
    names = list(columns) if columns is not None else sorted(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat_ws("|", *[_field_text(n, types[n]) for n in names])


def prefix_number(digest: Column, digits: int) -> Column:
    """The first hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def fingerprint_aggregates(df: DataFrame, columns: Iterable[str] | None = None) -> list[Column]:
    """Aggregates that identify a group of rows whatever their order.

    The fingerprint is the sum of a 48-bit number per row. Sums and counts combine before
    the shuffle, so a group holding most of the rows costs no more than any other. The
    number is summed in three 16-bit parts: plain BIGINT sums are much faster than decimal
    ones and leave room for 2**47 rows a group.
    """
    number = prefix_number(F.sha2(row_text(df, columns), 256), 12)
    parts = [F.shiftright(number, shift).bitwiseAND(F.lit(0xFFFF)) for shift in (32, 16, 0)]
    total = F.lit(0).cast("decimal(38,0)")
    for part in parts:
        total = (total * 65536 + F.coalesce(F.sum(part), F.lit(0))).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("row_count"),
        total.cast("string").alias("fingerprint"),
    ]


def hash_shard(key: Column, shards: int) -> Column:
    """Shard of a key, the same in any engine that has MD5."""
    return prefix_number(F.md5(key.cast("string")), 8) % F.lit(shards)


def in_sample(key: Column, rate: float) -> Column:
    """Whether a key belongs to the repeatable sample at ``rate``; a null key counts as empty text."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie between 0 and 1")
    millionths = round(rate * 1_000_000)
    if rate and not millionths:
        raise ValueError("a rate below a millionth would take nothing")
    return hash_shard(F.coalesce(key.cast("string"), F.lit("")), 1_000_000) < F.lit(millionths)
