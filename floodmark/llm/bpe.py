"""Byte-level BPE encoding and decoding by recursive queries.

A text's pieces (matches of the splitting pattern) are encoded separately. Each task keeps a
DuckDB database in memory with the merge table: for every pair of tokens that make a token,
the pair and its rank. Rows (word, position, token) of the words it has not met before are
joined with it, and each word's leftmost pair of least rank is contracted, again and again,
until no word has a pair left. Decoding joins ids with the vocabulary's bytes and aggregates
them in order; the bytes that a round trip hashes are those that the ids decode to. A task
remembers a bounded number of words, so it asks for new ones only.

A word longer than ``SECTION`` bytes is contracted in sections that overlap by half, and two
sections are joined at a token that both have at the same place. Every two neighbours of the
result then are neighbours in the encoding of a section, and the encoding of a word is the one
sequence of tokens of which this is true. Sections that have no token in common are made
twice as long. So the work of a word is linear in its length, except for words whose sections
agree nowhere, and a query holds a bounded number of rows.

Defined results: null and empty texts have no ids; every row of the input gives a row, also where
ids repeat, are null or exceed 2**53; texts and words of any length are encoded whole; unknown
ids in a list to decode, and null ids, are left out; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.llm.base import query, table

#: Pieces, and segments made of pieces, that a task remembers; beyond it the memory starts anew.
PIECES, SEGMENTS = 1_000_000, 600_000
#: Characters that are encoded at a time, about.
SLAB = 4 << 20
MEMORY = "400MB"
#: Bytes of a section of a long word, and rows of all rounds of one query, at most, about.
SECTION, CONTRACTED = 64, 12_000_000

# Blank and line characters begin a new piece after any other character; so texts can be cut
# there first, unless they hold other white space.
_SEGMENT = re.compile("[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")

# Latin letters, perhaps with a blank in front and signs behind: two pieces at most.
_PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")

# A pair's code is its rank, its first position and the position after it, 23 bits for each
# position (longer words are refused): a word's least code is its leftmost pair of least rank.
LONGEST = 1 << 23
CONTRACT = """
with recursive states(word, pos, token, done) as (
  select word, pos, token, false from tokens
  union all
  (
    with pairs as (
      select s.word, s.pos, s.token, m.rank * 70368744177664 + s.pos * 8388608::bigint + s.follows as code
      from (
        select word, pos, token, lead(token) over w as next, lead(pos) over w as follows
        from states where not done window w as (partition by word order by pos)
      ) s left join merges m on m.left_token = s.token and m.right_token = s.next
    ), best as (select word, min(code) as best from pairs group by word)
    select p.word, pos, case when pos = best // 8388608 % 8388608 then (best // 70368744177664)::int else token end, best is null
    from pairs p join best b on p.word = b.word
    where best is null or pos <> best % 8388608
  )
)
select word, string_agg(token::varchar, ',' order by pos) as ids, string_agg(hex, '' order by pos) as hex
from states join vocabulary on id = token
where done group by word
"""

DECODE = """
select row, string_agg(hex, '' order by pos) as hex
from ids join vocabulary using (id) group by row
"""


class Codec:
    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.base = [self.ranks[bytes([b])] for b in range(256)]
        # Nothing is spilled to the worker's own disk: queries are bounded instead.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        self.fill("merges", left_token=pa.array(left, pa.int32()), right_token=pa.array(right, pa.int32()), rank=pa.array(rank, pa.int64()))
        self.fill("vocabulary", id=pa.array(self.ranks.values(), pa.int32()), hex=pa.array([t.hex() for t in self.ranks]))
        self.length = {r: len(t) for t, r in self.ranks.items()}
        self.words: dict[str, tuple[bytes, bytes]] = {}  # ids, and what they decode to
        self.ids: dict[str, bytes] = {}  # decimals joined by commas
        self.bytes: dict[str, bytes] = {}

    def fill(self, name: str, **columns: pa.Array) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create or replace table {name} as select * from given")
        self.db.unregister("given")

    def contract(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids of words (decimals joined by commas) and the bytes that they decode to, some words at a time."""
        out, since, rows = [], 0, 0
        for i, word in enumerate(words):
            rows += len(word) * (len(word) + 1) // 2
            if rows >= CONTRACTED or i + 1 == len(words):
                out += self._contract(words[since : i + 1])
                since, rows = i + 1, 0
        return out

    def _contract(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        if max(map(len, words)) >= LONGEST:
            raise ValueError(f"{LONGEST} bytes without a place to cut them")
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        token = np.array(self.base, np.int32)[np.frombuffer(b"".join(words), np.uint8)]
        self.db.register("tokens", pa.table({"word": word, "pos": pos.astype(np.int32), "token": token}))
        out: list[tuple[bytes, bytes]] = [(b"", b"")] * len(words)
        for k, ids, hexed in self.db.execute(CONTRACT).fetchall():
            out[k] = ids.encode(), bytes.fromhex(hexed)
        self.db.unregister("tokens")
        return out

    def encode_long(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words of any length, from those of their sections."""
        out: list[list[int] | None] = [None] * len(words)
        open_words, size = list(range(len(words))), SECTION
        while open_words:
            sections = {k: [words[k][a : a + size] for a in range(0, max(len(words[k]) - size // 2, 1), size // 2)] for k in open_words}
            found = iter([[int(i) for i in ids.split(b",")] for ids, _ in self.contract([s for k in open_words for s in sections[k]])])
            for k in open_words:
                out[k] = self.joined([next(found) for _ in sections[k]], size // 2)
            open_words, size = [k for k in open_words if out[k] is None], 2 * size
        return out

    def joined(self, sections: list[list[int]], step: int) -> list[int] | None:
        """Ids of a word from those of its sections, each ``step`` bytes after the one before; None if two agree nowhere."""
        ids = sections[0]
        places = list(accumulate([0, *map(self.length.__getitem__, ids)]))[:-1]
        for k, other in enumerate(sections[1:], 1):
            known = {}
            for i in range(len(ids) - 1, -1, -1):
                if places[i] < k * step:
                    break
                known[places[i], ids[i]] = i
            at = k * step
            for j, token in enumerate(other):
                i = known.get((at, token))
                if i is not None:
                    del ids[i:], places[i:]
                    ids += other[j:]
                    places += accumulate([at, *map(self.length.__getitem__, other[j:-1])])
                    break
                at += self.length[token]
            else:
                return None
        return ids

    def learn_words(self, words: list[str]) -> None:
        """Remember the ids of new words, and the bytes that these ids decode to."""
        short, known, lists = [], [], []
        for word in words:
            data = word.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(data)
            if rank is not None:  # a word that is a token is that token
                known.append(word), lists.append([rank])
            elif len(data) <= SECTION:
                short.append((word, data))
        for (word, _), found in zip(short, self.contract([d for _, d in short]), strict=True):
            self.words[word] = found
        long = sorted(set(words).difference(self.words, known))
        lists += self.encode_long([w.encode("utf-8", "surrogatepass") for w in long])
        for word, ids, data in zip([*known, *long], lists, self.decode(lists), strict=True):
            self.words[word] = b",".join([b"%d" % i for i in ids]), data

    def segments(self, text: str) -> list[str]:
        return self.pattern.findall(text) if _OTHER_SPACE.search(text) else _SEGMENT.findall(text)

    def learn(self, segments: set[str]) -> None:
        new = segments.difference(self.ids)
        if len(self.ids) + len(new) > SEGMENTS:
            self.ids.clear(), self.bytes.clear()
            new = segments
        pieces = {}
        for segment in new:
            plain = _PLAIN.fullmatch(segment)
            pieces[segment] = [p for p in plain.groups() if p] if plain else self.pattern.findall(segment)
        wanted = {p for found in pieces.values() for p in found}
        if len(self.words) + len(wanted) > PIECES:
            self.words.clear()
        self.learn_words(list(wanted.difference(self.words)))
        for segment, found in pieces.items():
            known = [self.words[p] for p in found]
            self.ids[segment] = b",".join([k[0] for k in known])
            self.bytes[segment] = b"".join([k[1] for k in known])

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """Per text: its ids as decimals joined by commas, and the bytes that they decode to."""
        cut = [self.segments(t) if t else [] for t in texts]
        self.learn({s for segments in cut for s in segments})
        for segments in cut:
            yield b",".join(map(self.ids.__getitem__, segments)), b"".join(map(self.bytes.__getitem__, segments))

    def decode(self, rows: list) -> list[bytes]:
        """The bytes of lists of ids."""
        out = [b""] * len(rows)
        sizes = np.array([0 if ids is None else len(ids) for ids in rows], np.int64)
        if sizes.sum():
            row = np.repeat(np.arange(len(rows)), sizes)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ids = pa.array([i for some in rows if some is not None for i in some], pa.int32())
            self.db.register("ids", pa.table({"row": row, "pos": pos, "id": ids}))
            for k, hexed in self.db.execute(DECODE).fetchall():
                out[k] = bytes.fromhex(hexed)
            self.db.unregister("ids")
        return out


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _in_slabs(texts: list[str | None]) -> Iterator[list[str | None]]:
    since, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= SLAB or i + 1 == len(texts):
            yield texts[since : i + 1]
            since, size = i + 1, 0


def _rows(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str, form, fields: list[T.StructField], kinds: list[pa.DataType]) -> DataFrame:
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            since = 0
            for texts in _in_slabs(batch.column("text").to_pylist()):
                found = [form(*x) for x in own.encode(texts)]
                # Ids of rows stay Arrow values: pandas would round large ones beside a null.
                cells = [pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(since, len(texts)), *cells], schema.names)
                since += len(texts)

    inner = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return inner.mapInArrow(work, schema).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """id, ids: the token ids of each whole text."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    form = lambda ids, _: ([int(x) for x in ids.split(b",")] if ids else [],)
    return _rows(docs, id_col, text_col, path, pattern, form, [T.StructField("ids", T.ArrayType(T.IntegerType()))], [pa.list_(pa.int32())])


def decode(rows: DataFrame, ids_col: str = "ids", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """All columns, with ``decoded`` (binary) for each list of ids."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    @F.arrow_udf("binary")
    def bytes_of(ids: pa.Array) -> pa.Array:
        return pa.array(codec(path, pattern).decode(ids.to_pylist()), pa.binary())

    return rows.withColumn("decoded", bytes_of(F.col(f"`{ids_col}`")))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """id, n_tokens, ids_sha256 (of decimals joined by commas), decoded_sha256."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    form = lambda ids, data: (ids.count(b",") + 1 if ids else 0, sha256(ids).hexdigest(), sha256(data).hexdigest())
    return _rows(docs, id_col, text_col, path, pattern, form, fields, [pa.int64(), pa.string(), pa.string()])


@query()
def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(table(spark, sf, "documents"), path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
