"""Substring dedup: words inside passages that occur more than once, by recompression.

A text's words are its first symbols. A round names runs of two equal symbols, or pairs of
neighbours whose left symbol falls into one half of the names and whose right one into the
other. A name is a digest of the names it replaces, so all tasks name alike without asking
each other, and equal passages come out with the same symbols inside. A round bounds the
words of a symbol; so the words that decide whether an edge between top symbols exists reach
no further than ``REACH`` to both sides. Every window of words contains an edge with all of
its deciding words: where a window repeats, that edge repeats with them.

First the edges' names are counted over the corpus: windows with an edge that occurs once
cannot repeat. The other windows are named by 96 bits and counted exactly. Both counts go
through blocks (see exchange.py): no text, position or copy of a passage travels twice, and
a passage that a third of the documents share is one name of each chunk.

Defined results: null text has no words; a text shorter than the window keeps all words; equal
rows repeat each other; rows with equal ids are judged as rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.llm import exchange as X
from floodmark.llm.base import keep, query, table
from floodmark.llm.words import U64, encoded, mix, named, sequence, split, sums

#: Most words of a symbol after each round; the first round names runs, the others pairs.
ROUNDS = (2, 3, 5, 11)
#: Words to each side that decide an edge of the last round: 2, then the bound of each round before.
REACH = 2 + sum(ROUNDS[:-1])
#: Shortest window in which an edge of the last round is sure to lie with all its reach.
LEAST_WINDOW = 2 * REACH + ROUNDS[-1]
#: Bytes that are worked on at a time, about.
SLAB = 1 << 20
EDGE_BYTES = 6


def edges(names: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions where symbols of the last round begin, also every text's first word.

    ``bounds`` are the texts' first words and the end; symbols never cross them.
    """
    start, symbol = np.arange(len(names)), names
    wall = np.zeros(len(names) + 1, bool)
    wall[bounds] = True
    for k, most in enumerate(ROUNDS):
        if len(start) < 2:
            break
        length = np.diff(start, append=len(names))
        joinable = ~wall[start[1:]] & (length[:-1] + length[1:] <= most)
        if k == 0:
            equal = (symbol[:-1] == symbol[1:]) & ~wall[start[1:]]
            before = np.concatenate([[False], equal[:-1]])
            after = np.concatenate([equal[1:], [False]])
            merged = equal & ~before & ~after
        else:
            half = (mix(symbol ^ U64(k)) >> U64(63)).astype(bool)
            merged = joinable & half[:-1] & ~half[1:]
        left = np.flatnonzero(merged)
        symbol = symbol.copy()
        symbol[left] = mix(symbol[left] * U64(0x9E3779B97F4A7C15) + mix(symbol[left + 1]) + U64(k + 1))
        stays = np.ones(len(start), bool)
        stays[left + 1] = False
        start, symbol = start[stays], symbol[stays]
    return start


class Slab:
    """Some texts' words in one array, with their edges and window names."""

    def __init__(self, texts: list[bytes], window: int):
        self.window = window
        names, self.bounds = named(texts)
        self.size = len(names)
        self.end = np.repeat(self.bounds[1:], np.diff(self.bounds))
        self.prefix = sums(names)
        at = edges(names, self.bounds)
        first = np.repeat(self.bounds[:-1], np.diff(self.bounds))
        at = at[(at - REACH >= first[at]) & (at + REACH <= self.end[at])] if len(at) else at
        self.edge = at
        self.edge_name = X.cut(sequence(self.prefix, at - REACH, 2 * REACH), EDGE_BYTES)
        self.second = partial(sums, names, salt=1)

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of windows all of whose edges are repeated."""
        single = np.zeros(self.size + 1, np.int64)
        single[1:][self.edge[~repeated]] = 1
        single = np.cumsum(single)
        at = np.arange(max(0, self.size - self.window + 1))
        at = at[at + self.window <= self.end[at]]
        return at[single[at + self.window - REACH + 1] == single[at + REACH]]

    def window_names(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        name = sequence(self.prefix, at, self.window)
        return name, (sequence(self.second(), at, self.window) >> U64(32)).astype(np.uint32)

    def covered(self, at: np.ndarray) -> np.ndarray:
        step = np.zeros(self.size + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + self.window, -1)
        return np.cumsum(step[:-1]) > 0


def slabs(blobs, columns: list[str], text: str, window: int) -> Iterator[tuple[pa.Table, Slab]]:
    """Whole texts, a few at a time."""
    rows = X.unpacked(blobs, columns)
    texts, size, since = [], 0, 0
    for i, value in enumerate(rows[text]):
        texts.append(encoded(value.as_py()))
        size += len(texts[-1])
        if size >= SLAB or i + 1 == rows.num_rows:
            yield rows.slice(since, i + 1 - since), Slab(texts, window)
            texts, size, since = [], 0, i + 1


def distinct(names: list[np.ndarray], others: list[np.ndarray] | None = None):
    """Sorted distinct names, with their second parts, and which occur more than once."""
    name = np.concatenate([*names, np.empty(0, U64)])
    if others is None:
        name.sort()
        new = np.concatenate([[True], name[1:] != name[:-1]])[: len(name)]
        other = None
    else:
        other = np.concatenate([*others, np.empty(0, np.uint32)])
        order = np.lexsort((other, name))
        name, other = name[order], other[order]
        new = np.concatenate([[True], (name[1:] != name[:-1]) | (other[1:] != other[:-1])])[: len(name)]
    at = np.flatnonzero(new)
    return name[at], other[at] if other is not None else None, np.diff(at, append=len(name)) > 1


def bits(data: bytes) -> np.ndarray:
    """Flags as written by flags()."""
    out = np.unpackbits(np.frombuffer(data, np.uint8, offset=1))
    return out[: len(out) - data[0]].astype(bool)


def flags(values: np.ndarray) -> bytes:
    packed = np.packbits(values)
    return bytes([8 * len(packed) - len(values)]) + packed.tobytes()


def edge_verdicts(names: np.ndarray, extras: list[bytes], sizes: list[int]) -> list[bytes]:
    """Which edges occur more than once."""
    _, inverse = np.unique(names, return_inverse=True)
    twice = np.concatenate([bits(x) for x in extras])
    total = np.bincount(inverse, weights=1 + twice)
    return [flags(x) for x in X.cut_up(total[inverse] > 1, sizes)]


def window_verdicts(names: np.ndarray, extras: list[bytes], sizes: list[int]) -> list[bytes]:
    """Which windows occur more than once, by all 96 bits."""
    other = np.concatenate([np.frombuffer(x, "<u4", count=n) for x, n in zip(extras, sizes, strict=True)])
    twice = np.concatenate([bits(x[4 * n :]) for x, n in zip(extras, sizes, strict=True)])
    order = np.lexsort((other, names))
    name, rest = names[order], other[order]
    new = np.concatenate([[True], (name[1:] != name[:-1]) | (rest[1:] != rest[:-1])])
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=1 + twice[order])
    out = np.empty(len(names), bool)
    out[order] = total[group] > 1
    return [flags(x) for x in X.cut_up(out, sizes)]


def repeated_edges(slab: Slab, names: np.ndarray, verdict: np.ndarray) -> np.ndarray:
    return verdict[np.searchsorted(names, slab.edge_name)] if len(names) else np.zeros(0, bool)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, carry: bool = False) -> DataFrame:
    """Per row: id, n_words, n_removed, spans (removed word ranges, end exclusive), kept_text.

    With ``carry`` the rows come back with all their columns, the text replaced where words
    were removed (the kept words joined by one space) and unchanged elsewhere.
    """
    if window < LEAST_WINDOW:
        raise ValueError(f"a window takes at least {LEAST_WINDOW} words")
    columns = docs.columns if carry else list(dict.fromkeys([id_col, text_col]))
    chunks = X.chunk_count(docs, text_col)
    packed = X.pack(docs, columns, chunks)

    def send_edges(chunk: int, blobs) -> pd.DataFrame:
        names, _, twice = distinct([slab.edge_name for _, slab in slabs(blobs, columns, text_col, window)])
        return X.blocks(chunk, chunks, names, lambda a, b: flags(twice[a:b]), EDGE_BYTES)

    seen = keep(X.answered(X.over_chunks(packed, send_edges, X.BLOCKS), edge_verdicts, EDGE_BYTES), "edges")

    def candidates(blobs, right: pd.DataFrame):
        held = list(slabs(blobs, columns, text_col, window))
        names, _, _ = distinct([slab.edge_name for _, slab in held])
        verdict = X.in_order(right, bits).astype(bool)
        for rows, slab in held:
            at = slab.candidates(repeated_edges(slab, names, verdict))
            yield rows, slab, at, slab.window_names(at)

    def send_windows(chunk: int, blobs, right: pd.DataFrame) -> pd.DataFrame:
        found = [x[3] for x in candidates(blobs, right)]
        names, other, twice = distinct([x[0] for x in found], [x[1] for x in found])
        return X.blocks(chunk, chunks, names, lambda a, b: other[a:b].astype("<u4").tobytes() + flags(twice[a:b]))

    sent = X.over_chunks(packed, send_windows, X.BLOCKS, seen)
    judged = keep(X.answered(sent, window_verdicts), "windows")

    if carry:
        schema = docs.schema
    else:
        schema = T.StructType(
            [
                docs.schema[id_col],
                T.StructField("n_words", T.LongType()),
                T.StructField("n_removed", T.LongType()),
                T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
                T.StructField("kept_text", T.StringType()),
            ]
        )

    def finish(chunk: int, blobs, right: pd.DataFrame) -> pd.DataFrame:
        found = list(candidates(blobs, right[right["step"] == 0]))
        names, other, _ = distinct([x[3][0] for x in found], [x[3][1] for x in found])
        verdict = X.in_order(right[right["step"] == 1], bits).astype(bool)
        if len(verdict) != len(names):
            raise RuntimeError("a chunk's windows changed between two passes")
        out = []
        for rows, slab, at, (name, rest) in found:
            place = np.searchsorted(names, name)
            while len(step := np.flatnonzero(other[place] != rest)):  # equal first parts
                place[step] += 1
            out.append(result(rows, slab.covered(at[verdict[place]]), slab.bounds))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=[f.name for f in schema])

    def result(rows: pa.Table, gone: np.ndarray, bounds: np.ndarray) -> pd.DataFrame:
        texts, n_words, n_removed, spans = rows[text_col].to_pylist(), [], [], []
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            mask = gone[a:b]
            n_words.append(b - a)
            n_removed.append(int(mask.sum()))
            if carry:
                if not n_removed[-1]:
                    continue
            elif not n_removed[-1]:
                texts[i] = b" ".join(split(texts[i])).decode("utf-8", "surrogatepass")
                spans.append([])
                continue
            words = split(texts[i])
            texts[i] = b" ".join([w for w, x in zip(words, mask.tolist(), strict=True) if not x]).decode("utf-8", "surrogatepass")
            turn = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            spans.append(turn.reshape(-1, 2).tolist())
        if carry:
            at = rows.column_names.index(text_col)
            return X.to_pandas(rows.set_column(at, text_col, pa.array(texts, rows.schema.field(at).type)))
        return pd.DataFrame({id_col: X.to_pandas(rows.select([id_col]))[id_col], "n_words": n_words, "n_removed": n_removed, "spans": spans, "kept_text": texts})

    steps = seen.withColumn("step", F.lit(0)).unionByName(judged.withColumn("step", F.lit(1)))
    return X.over_chunks(packed, finish, schema, steps)


@query()
def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = remove_repeats(table(spark, sf, "documents"), "doc_id", "text", window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "spans")
