"""Generated events and users for end-to-end trials, derived from a table of seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.functions.hashing import prefix_number

# Fixed values of the generated tables.
EVENT_TYPES = ["page_view", "click", "purchase", "signup", "logout"]
PLANS = ["free", "pro"]
MINUTES_PER_YEAR = 365 * 24 * 60


def _draw(seed: Column, label: str, upper: int) -> Column:
    """A repeatable number from 0 to ``upper``: like rounding a random share of it."""
    return prefix_number(F.md5(F.concat(seed, F.lit(":" + label))), 8) % F.lit(upper + 1)


def _name(number: Column, names: list[str], other: str) -> Column:
    result = F.when(number == 0, names[0])
    for i, name in enumerate(names[1:], start=1):
        result = result.when(number == i, name)
    return result.otherwise(other)


def events(seeds: DataFrame, key: str, per_seed: int) -> DataFrame:
    """``per_seed`` events for every seed row, the same each time they are generated."""
    numbered = seeds.select(
        F.col(key).cast("string").alias("_key"),
        F.explode(F.sequence(F.lit(1), F.lit(per_seed))).alias("_n"),
    )
    seed = F.concat_ws("-", "_key", "_n")
    start = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    minutes = _draw(seed, "minute", MINUTES_PER_YEAR).cast("int")
    return numbered.select(
        F.md5(seed).alias("event_id"),
        F.timestamp_add("MINUTE", minutes, start).alias("event_timestamp"),
        F.concat(F.lit("user_"), _draw(seed, "user", 1000).cast("string")).alias("user_id"),
        _name(_draw(seed, "type", 5), EVENT_TYPES, "other").alias("event_type"),
        F.round(_draw(seed, "amount", 100_000).cast("double") / 100, 2).alias("amount"),
        F.concat(F.lit("page_"), _draw(seed, "page", 50).cast("string")).alias("page"),
    )


def users(seeds: DataFrame, key: str) -> DataFrame:
    """One user for every seed row."""
    n = F.col(key).cast("string")
    start = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    return seeds.select(
        F.concat(F.lit("user_"), n).alias("user_id"),
        F.concat(F.lit("User "), n).alias("full_name"),
        F.concat(F.lit("user"), n, F.lit("@example.com")).alias("email"),
        F.timestamp_add("DAY", _draw(n, "day", 365).cast("int"), start).alias("created_at"),
        _name(_draw(n, "plan", 3), PLANS, "enterprise").alias("plan"),
    )
