"""Corpus-wide counts of names (of words, n-grams, passages) that come back to where they arose.

Documents are dealt into chunks by a hash. A chunk sends each distinct name
once, in sorted blocks, one block for each range of names (bucket); the bucket's task adds up
what all chunks sent and answers every block in its own order, so no name travels back. A
name that fills a third of the corpus is one entry of each chunk; buckets are ranges of
evenly spread names. Rows are blocks, so that shuffles move a few bytes per name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.llm.base import keep
from floodmark.llm.words import U64

#: Characters of text in a chunk, about; a chunk is what one task holds at a time.
CHUNK_CHARS = 8 << 20

BLOCKS = "chunk int, bucket int, names binary, extra binary"
ANSWERS = "chunk int, bucket int, answer binary"


def chunk_count(docs: DataFrame, text: str, size: int = CHUNK_CHARS) -> int:
    """Chunks of bounded size, at least as many as shuffle partitions."""
    chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-chars // size))


def pack(docs: DataFrame, columns: list[str], chunks: int, spread: bool = True) -> DataFrame:
    """(chunk, blob): rows as compressed Arrow streams, dealt by a hash of their values and their place.

    Equal rows have places of their own, so a row that fills a third of the table is spread over
    all chunks. The table that is written holds the deal: each step and each task that runs again
    sees the same one. Rows keep all given columns inside the blob, so no column of theirs can
    clash with ours.

    Without ``spread`` rows are dealt by their values alone: nothing is written, and rows that
    are equal in all columns lie in one chunk.
    """
    inner = docs.select(*[F.col(f"`{c}`") for c in columns])
    place = [F.monotonically_increasing_id()] if spread else []
    key = F.pmod(F.xxhash64(*place, *[F.col(f"`{c}`") for c in columns]), F.lit(chunks)).cast("int")
    flat = inner.select(key.alias("chunk"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("row"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            rows = pa.RecordBatch.from_struct_array(batch.column("row"))
            chunk = batch.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            edges = np.flatnonzero(np.diff(chunk[order], prepend=-1, append=-1))
            ids, blobs = [], []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = rows.take(pa.array(order[a:b]))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                    writer.write_batch(part)
                ids.append(int(chunk[order[a]]))
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "blob"])

    dealt = flat.mapInArrow(packed, "chunk int, blob binary")
    return keep(dealt, "chunks") if spread else dealt


def unpacked(blobs, columns: list[str]) -> pa.Table:
    """A chunk's rows."""
    return pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in blobs]).rename_columns(columns)


# Integers and flags that may be null: numpy would make floats of them and round large ones.
_EXACT = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype(), pa.bool_(): pd.BooleanDtype()}


def to_pandas(rows: pa.Table) -> pd.DataFrame:
    """Rows as they are, also integers beyond 2**53 beside nulls."""
    return rows.to_pandas(types_mapper=_EXACT.get)


def over_chunks(packed: DataFrame, fn: Callable, schema: str, answers: DataFrame | None = None) -> DataFrame:
    """fn(chunk, blobs[, answers as pandas]) -> pandas, for each chunk."""

    def alone(left: pd.DataFrame) -> pd.DataFrame:
        out = fn(int(left["chunk"].iloc[0]), left["blob"])
        pa.default_memory_pool().release_unused()  # a worker lives on and may hold nothing of a chunk
        return out

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = fn(int((left if len(left) else right)["chunk"].iloc[0]), left["blob"], right)
        pa.default_memory_pool().release_unused()
        return out

    if answers is None:
        return packed.groupBy("chunk").applyInPandas(alone, schema)

    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(both, schema)


def narrow(values: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes each, the width in front."""
    kind = np.min_scalar_type(values.max()) if len(values) else np.dtype(np.uint8)
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def widen(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def short(names: np.ndarray, width: int) -> bytes:
    """The upper ``width`` bytes of each name."""
    return np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]).tobytes()


def long(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8").astype(U64)


def close(names: np.ndarray) -> bytes:
    """Sorted names with all 64 bits: their upper 3 bytes by steps, mostly of one byte, then the lower 5."""
    upper = names >> U64(40)
    return int(upper[0]).to_bytes(3, "little") + narrow(np.diff(upper, prepend=upper[:1])) + np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def open_up(data: bytes) -> np.ndarray:
    """Names as written by close()."""
    width = data[3]
    n = (len(data) - 4) // (width + 5)
    out = np.zeros((n, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8, offset=4 + n * width).reshape(n, 5)
    upper = np.cumsum(np.frombuffer(data, f"<u{width}", offset=4, count=n), dtype=U64) + U64(int.from_bytes(data[:3], "little"))
    return out.reshape(-1).view("<u8").astype(U64) | (upper << U64(40))


def cut(names: np.ndarray, width: int) -> np.ndarray:
    """Names as ``width`` bytes hold them."""
    return names if width == 8 else names & ~U64((1 << (64 - 8 * width)) - 1)


def slices(names: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted names: equal ranges of the name space."""
    if not len(names):
        return
    bucket = ((names >> U64(32)) * U64(buckets)) >> U64(32)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1])
    for a, b in zip(starts, [*starts[1:], len(names)], strict=True):
        yield int(bucket[a]), int(a), int(b)


def blocks(chunk: int, buckets: int, names: np.ndarray, extra: Callable[[int, int], bytes], width: int | None = 8) -> pd.DataFrame:
    """Blocks of sorted names; ``extra(a, b)`` gives what goes along with names a to b.

    Without a width the names are as close() writes them.
    """
    rows = [(chunk, k, short(names[a:b], width) if width else close(names[a:b]), extra(a, b)) for k, a, b in slices(names, buckets)]
    return pd.DataFrame(rows, columns=["chunk", "bucket", "names", "extra"])


def answered(sent: DataFrame, fn: Callable, width: int = 8) -> DataFrame:
    """fn(names, extras, sizes) -> one bytes value for each block, with a bucket's blocks together.

    ``names`` are those of all blocks one after the other, ``sizes`` the blocks' lengths.
    """

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk", ignore_index=True)
        parts = [long(x, width) for x in rows["names"]]
        out = fn(np.concatenate(parts), list(rows["extra"]), [len(p) for p in parts])
        return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "answer": out})

    return sent.groupBy("bucket").applyInPandas(answer, ANSWERS)


def cut_up(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1])


def in_order(right: pd.DataFrame, decode: Callable[[bytes], np.ndarray]) -> np.ndarray:
    """A chunk's answers, aligned with the sorted names it sent."""
    rows = right.sort_values("bucket")
    parts = [decode(x) for x in rows["answer"]]
    return np.concatenate(parts) if parts else np.empty(0)
