"""Lookups on error texts and field types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error classes in order of precedence, with the texts that mark them.
ERROR_CLASSES = [
    ("quota", ["quota"]),
    ("auth", ["unauthenticated", "permission"]),
    ("store_unavailable", ["connection refused", "no such host"]),
    ("transient", ["timeout", "deadline"]),
]
UNKNOWN_ERROR = "unknown"

# Field types and the wider types each may become.
WIDENINGS = {
    "INT64": ["FLOAT64", "NUMERIC", "BIGNUMERIC"],
    "FLOAT64": ["NUMERIC", "BIGNUMERIC"],
    "NUMERIC": ["BIGNUMERIC"],
    "DATE": ["DATETIME", "TIMESTAMP"],
    "DATETIME": ["TIMESTAMP"],
}

# Other names of the field types.
TYPE_ALIASES = {
    "INTEGER": "INT64",
    "FLOAT": "FLOAT64",
    "BOOLEAN": "BOOL",
    "STRUCT": "RECORD",
    "DECIMAL": "NUMERIC",
    "BIGDECIMAL": "BIGNUMERIC",
}


def error_class(message: Column) -> Column:
    """Class of an error text; the first matching class wins, case matters, null stays null."""
    result = F.when(message.isNull(), F.lit(None).cast("string"))
    for name, marks in ERROR_CLASSES:
        hit = F.lit(False)
        for mark in marks:
            hit = hit | F.contains(message, F.lit(mark))
        result = result.when(hit, F.lit(name))
    return result.otherwise(F.lit(UNKNOWN_ERROR))


def standard_type(field_type: Column) -> Column:
    """Field type with its alias replaced by the usual name."""
    pairs = [F.lit(x) for pair in TYPE_ALIASES.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[field_type], field_type)


def is_widening(before: Column, after: Column) -> Column:
    """Whether every value of ``before`` has a place in ``after``."""
    result = F.lit(False)
    for narrow, wider in WIDENINGS.items():
        result = result | ((before == narrow) & after.isin(wider))
    return F.coalesce(result, F.lit(False))


def change_type(changes: Column, breaking: Column) -> Column:
    """NONE, ADDITIVE or BREAKING from a number of changes and whether any of them breaks."""
    return (
        F.when(F.coalesce(changes, F.lit(0)) == 0, F.lit("NONE"))
        .when(breaking, F.lit("BREAKING"))
        .otherwise(F.lit("ADDITIVE"))
    )
