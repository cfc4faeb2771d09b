"""MinHash near-dedup with sequential Bayesian verification.

Each document gets a signature of ``HASHES`` minima over its whole shingle set. Documents with
equal sets form a class and go on as one. Classes that share a band of a signature are linked
to the smallest class of that band; the components of these links bound who can be similar
to whom. Inside a component, pairs that share a band are compared batch by batch of their
signatures: a pair is given up as soon as the posterior probability that its similarity
reaches the threshold falls below ``miss``. Survivors are confirmed on their full sets. Pairs
that are connected already are not looked at again: what leaves a task is a forest.

A component of many classes is dealt into blocks. First every block is compared with itself
and with the first block; what this leaves outside the component's largest group is then
compared with all blocks. So a group of copies of any size is work of bounded tasks, and no
pair of it is written out.

Defined results: a text without words has an empty set and links with nothing; fewer words than a
shingle are one shingle; rows with null ids link with nothing and have a null component; rows
with equal ids are one node of the graph, so each reaches what any of them links with.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.base import keep, query, table
from floodmark.llm.components import components
from floodmark.llm.words import U64, encoded, in_slabs, mix, named, windows

BANDS, ROWS = 25, 5
HASHES = 128
BATCH = 32
#: Classes of a block.
BLOCK = 512

_RNG = np.random.default_rng(20240607)
_FACTOR = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * U64(2) + U64(1)
_SHIFT = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(texts: list, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct names of the shingles of each whole text, in turn."""
    for some in in_slabs([encoded(t).lower() for t in texts]):
        names, bounds = named(some)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(windows(names[a:b], min(width, b - a))) if b > a else names[a:b]


def minima(names: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(names), 512):
        values = names[None, k : k + 512] * _FACTOR[:, None]
        values += _SHIFT[:, None]
        values >>= U64(32)
        np.minimum(out, values.min(axis=1).astype(np.uint32), out=out)
    return out


def digest(names: np.ndarray) -> bytes:
    """128 bits of a set."""
    with np.errstate(over="ignore"):
        parts = [mix(names).sum(dtype=U64), mix(names ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)]
    return np.array(parts, "<u8").tobytes()


def text_key(text_col: str) -> Column:
    """What tells the texts of one id apart."""
    return F.unhex(F.md5(F.col(f"`{text_col}`").cast("binary"))).alias("text_key")


def sketch(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """id, n_shingles, digest of the set, minima, key of the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ids stay Arrow values: pandas would round large ones beside a null.
        for batch in batches:
            out = [(len(names), digest(names), minima(names).astype("<u4").tobytes()) for names in shingles(batch.column("text").to_pylist(), width)]
            more = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *more, batch.column("text_key")], ["id", "n_shingles", "digest", "minima", "text_key"])

    inner = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), text_key(text_col))
    return inner.mapInArrow(rows, "id long, n_shingles long, digest binary, minima binary, text_key binary")


@lru_cache
def least_matches(percent: int, miss: float) -> tuple[int, ...]:
    """Fewest equal minima after each batch with which a pair goes on.

    With a uniform prior, m equal of n gives similarity s the posterior Beta(m + 1, n - m + 1);
    it reaches t with the probability that at most m of n + 1 trials of chance t succeed.
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def survivors(one: np.ndarray, others: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Rows of ``others`` that share a band with ``one`` and stay probable batch after batch."""
    same = (others[:, : BANDS * ROWS] == one[: BANDS * ROWS]).reshape(len(others), BANDS, ROWS)
    alive = np.flatnonzero(same.all(axis=2).any(axis=1))
    equal = np.zeros(len(alive), np.int64)
    for k, need in enumerate(least):
        batch = slice(k * BATCH, (k + 1) * BATCH)
        equal = equal + (others[alive, batch] == one[batch]).sum(axis=1)
        alive, equal = alive[equal >= need], equal[equal >= need]
    return alive[np.argsort(-equal, kind="stable")]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def links(rows: pd.DataFrame, width: int, percent: int, miss: float) -> list[tuple[int, int]]:
    """A forest of confirmed links of one block. ``side``: 1 are compared with all; ``own``: known components."""
    if len(rows) < 2:
        return []
    rows = rows.sort_values(["rep", "digest"], ignore_index=True)
    sets = list(shingles(list(rows["text"]), width))
    least = least_matches(percent, miss)
    minima_of = np.stack([np.frombuffer(x, "<u4") for x in rows["minima"]])
    reps, compares, turn = rows["rep"].tolist(), rows["side"].to_numpy() == 1, np.arange(len(rows))
    forest, out = Forest(len(rows)), []
    first: dict[int, int] = {}
    for i, own in enumerate(rows["own"].tolist()):
        forest.up[forest.root(i)] = forest.root(first.setdefault(own, i))
    for i in range(len(rows)):
        if not compares[i]:
            continue
        others = np.flatnonzero((turn > i) | ~compares)
        for j in others[survivors(minima_of[i], minima_of[others], least)].tolist():
            a, b = forest.root(i), forest.root(j)
            if a != b and similar(sets[i], sets[j], percent):
                forest.up[a] = b
                out.append((reps[i], reps[j]))
    return out


def by_key(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal keys from sorted batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch[keys].to_numpy()
        edge = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            part = batch.iloc[a:b]
            if held and (held[-1][keys].iloc[-1].to_numpy() != key[a]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def compared(blocks: DataFrame, width: int, percent: int, miss: float) -> DataFrame:
    """(a, b): confirmed links inside the blocks; a block is (part, block_a, block_b)."""
    keys = ["part", "block_a", "block_b"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in by_key(batches, keys):
            found = links(group, width, percent, miss)
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    dealt = blocks.select(*keys, "rep", "own", "side", "digest", "minima", "text")
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(rows, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    miss: float = 1e-6,
    block: int = BLOCK,
) -> DataFrame:
    """id, n_shingles, component_id, kept; links need 100 * shared >= percent * union."""
    marks = keep(sketch(docs, id_col, text_col, width), "sketch")
    classes = keep(
        marks.where("n_shingles > 0 and id is not null")
        .groupBy("digest")
        .agg(F.min(F.struct("id", "text_key")).alias("least"), F.first("minima").alias("minima"))
        .select("digest", F.col("least.id").alias("rep"), "least.text_key", "minima"),
        "classes",
    )
    step = 4 * ROWS
    band_keys = F.array([F.xxhash64(F.lit(k), F.substring("minima", k * step + 1, step)) for k in range(BANDS)])
    bands = classes.select("rep", F.explode(band_keys).alias("band"))
    shared = bands.groupBy("band").agg(F.min("rep").alias("center"), F.count("*").alias("n")).where("n > 1")
    near = bands.join(shared, "band").where("rep != center").select(F.col("rep").alias("a"), F.col("center").alias("b"))
    parts = keep(components(near), "parts").withColumnRenamed("component", "part")

    # An id may stand for several classes; each goes on with the text that has its set.
    nodes = parts.withColumnRenamed("node", "rep").join(classes, "rep")
    sizes = nodes.groupBy("part").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("n_blocks"))
    dealt = F.xxhash64("rep", "digest")
    placed = nodes.join(sizes, "part").withColumn("block", F.pmod(dealt, F.col("n_blocks")).cast("int"))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("rep"), F.col(f"`{text_col}`").alias("text"), text_key(text_col))
    # Repeated rows are one before the texts move.
    texts = texts.where("rep is not null and text is not null").dropDuplicates(["rep", "text_key"])
    members = keep(texts.join(placed.hint("shuffle_hash"), ["rep", "text_key"]).drop("text_key"), "members")

    to = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("n_blocks") - 1)).otherwise(F.array("block"))
    first = members.withColumns({"block_a": F.explode(to), "block_b": F.lit(-1), "own": F.col("rep"), "side": F.lit(1)})
    found = keep(compared(first, width, percent, miss), "near-links")

    # What the first round left outside the largest group of a component of several blocks.
    large = parts.join(sizes.where("n_blocks > 1"), "part")
    if large.take(1):
        reached = components(found)
        owned = large.join(reached, "node", "left").select("part", F.col("node").alias("rep"), F.coalesce("component", "node").alias("own"))
        owned = keep(owned, "owned")
        groups = owned.groupBy("part", "own").agg(F.count("*").alias("n"))
        main = groups.groupBy("part").agg(F.max_by("own", F.struct("n", "own")).alias("main"), F.count("*").alias("groups"))
        rest = owned.join(main.where("groups > 1"), "part").select("part", "rep", "own", (F.col("own") != F.col("main")).alias("outside"))
        rest = keep(rest, "rest")
        left = members.select("part", "rep").join(rest.where("outside").select("rep"), "rep")
        outside = left.groupBy("part").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("n_outside"))
        again = members.join(rest.join(outside, "part").drop("part"), "rep")
        again = again.withColumn("row_block", F.pmod(dealt, F.col("n_outside")).cast("int"))
        rows = again.where("outside").withColumns({"block_a": F.col("row_block"), "block_b": F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)), "side": F.lit(1)})
        columns = again.withColumns({"block_a": F.explode(F.sequence(F.lit(0), F.col("n_outside") - 1)), "block_b": F.col("block"), "side": F.lit(0)})
        # A row that is on both sides of a task counts once, as one that is compared.
        twice = F.col("outside") & (F.col("row_block") == F.col("block_a"))
        both = rows.unionByName(columns.where(~twice))
        found = found.unionAll(keep(compared(both, width, percent, miss), "near-links"))

    equal = marks.where("n_shingles > 0 and id is not null").join(classes.select("digest", "rep"), "digest").where("id != rep")
    reached = components(found.unionAll(equal.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    out = marks.select("id", "n_shingles").join(reached.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


@query()
def op10_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), width=3, percent=85, miss=1e-6)
