"""Best-fit packing: documents' tokens into fixed-length sequences by the sum-of-squares rule.

Each document is cut only where it is longer than a sequence. Full pieces are sequences of
their own. The other pieces are dealt into shards of bounded size; a shard places its pieces,
longest first, where the sum over all residual gaps of (open sequences with that gap)**2
becomes smallest, ties to the smallest gap. With every size at hand a shard of some thousand
pieces ends within a sequence or two of its tokens / length, so shards cost next to nothing.

Defined results: null or empty text has the end id alone; a row of its own for each row of
the input, also where ids repeat, are null or exceed 2**53; the strings of special tokens in a
text are those tokens, as the tokenizer takes them (``plain`` makes them ordinary text); an
empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from struct import pack as packed
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.llm.base import keep, query, table
from floodmark.llm.words import split

#: Pieces that one task packs at a time.
SHARD = 50_000
#: Words, and pieces of words, whose ids a Python worker remembers.
REMEMBERED, PIECES = 600_000, 800_000
SLAB = 300_000


# The printable form of bytes in byte-level vocabularies: printable bytes stand for themselves,
# the others follow from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in set(_PRINTED)]
BYTE_FORM = {b: chr(b) for b in _PRINTED} | {b: chr(256 + k) for k, b in enumerate(_OTHERS)}

# Words of plain Latin letters and ASCII signs: lower case and composition change nothing else.
_LATIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0134-\u0148\u014a-\u017e]+")


class WordIds:
    """Ids of whole texts; words between white space are encoded once and remembered.

    The tokenizer never joins characters across white space, so a text's ids are its words'.
    Pieces of Latin words go straight to the tokenizer's merges and are remembered as well.
    With ``plain`` the strings of special tokens are ordinary text; else they are those tokens.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.path, self.known, self.ids_of_piece = path, {}, {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.tokenize = self.tokenizer.model.tokenize
        # The vocabulary's own splitting pattern, that of its first pre-tokenizer.
        self.cut = regex.compile(json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        strings = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(len(split(s.decode())) != 1 or split(s.decode())[0] != s for s in strings):
            raise ValueError("a token of this vocabulary holds white space")
        self.special = re.compile(b"|".join(map(re.escape, strings))) if strings and not plain else None

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = words
        if len(self.ids_of_piece) > PIECES:
            self.ids_of_piece.clear()
        hard = []
        special = set()
        if self.special and self.special.search(b" ".join(new)):
            special = {w for w in new if self.special.search(w)}
        for word in new:
            text = word.decode("utf-8", "replace")
            if _LATIN.fullmatch(text) and word not in special:
                text = text.lower()
                # Letters alone are one piece.
                self.known[word] = self.piece(text) if text.isalpha() else b"".join(map(self.piece, self.cut(text)))
            else:
                hard.append(word)
        new = hard
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            for word, e in zip(part, encode([w.decode("utf-8", "replace") for w in part], add_special_tokens=False), strict=True):
                self.known[word] = np.array(e.ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        ids = self.ids_of_piece.get(piece)
        if ids is None:
            # Printable ASCII is its own form.
            form = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_FORM)
            found = self.tokenize(form)
            ids = self.ids_of_piece[piece] = packed(f"<{len(found)}I", *[t.id for t in found])
        return ids

    def encode(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.known.__getitem__, words))


_WORD_IDS: dict[tuple[str, bool], WordIds] = {}


def word_ids(path: str, plain: bool = False) -> WordIds:
    if (path, plain) not in _WORD_IDS:
        _WORD_IDS[path, plain] = WordIds(path, plain)
    return _WORD_IDS[path, plain]


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, length: int, end_id: int = 0, with_ids: bool = False, plain: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, optionally ids (little-endian)."""
    fields = [
        T.StructField("doc", docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = int(end_id).to_bytes(4, "little")

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer, plain)

        def some(batch: pa.RecordBatch, held: list[tuple[int, list[bytes]]]) -> pa.RecordBatch:
            ids_of.learn(set().union(*(words for _, words in held)))
            out = []
            for i, words in held:
                data = ids_of.encode(words) + end
                for k, at in enumerate(range(0, len(data), 4 * length)):
                    part = data[at : at + 4 * length]
                    out.append((i, k, at // 4, len(part) // 4, crc32(part), *([part] if with_ids else [])))
            source, *cells = zip(*out, strict=True)
            # Ids stay Arrow values: pandas would round large ones beside a null.
            doc = batch.column("doc").take(pa.array(source))
            return pa.RecordBatch.from_arrays([doc, *(pa.array(c, t) for c, t in zip(cells, kinds, strict=True))], [f.name for f in fields])

        for batch in rows:
            held, size = [], 0
            for i, text in enumerate(batch.column("text")):
                held.append((i, split(text.as_py())))
                size += len(held[-1][1])
                if size >= SLAB:
                    yield some(batch, held)
                    held, size = [], 0
            if held:
                yield some(batch, held)

    inner = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    return inner.mapInArrow(cut, T.StructType(fields))


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each size in the given order, and the number of sequences.

    A new sequence is opened only where no open one has room.
    """
    count = np.zeros(length + 1, np.int64)  # open sequences by gap
    waiting: list[list[int]] = [[] for _ in range(length + 1)]
    home, offset, opened = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for i, s in enumerate(sizes.tolist()):
        # What the sum of squares gains with each gap from s on: that gap's count falls by one
        # and the count of the gap that is left rises by one, where a gap is left.
        gain = 2 * (count[: length - s + 1] - count[s:]) + 2
        gain[0] -= 2 * count[0] + 1
        gain[count[s:] == 0] = np.iinfo(np.int64).max
        gap = s + int(np.argmin(gain))
        if count[gap]:
            count[gap] -= 1
            k = waiting[gap].pop()
        else:
            gap, k, opened = length, opened, opened + 1
        home[i], offset[i] = k, length - gap
        if gap > s:
            count[gap - s] += 1
            waiting[gap - s].append(k)
    return home, offset, opened


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    length: int = 2048,
    end_id: int = 0,
    with_ids: bool = False,
    plain: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    With ``plain`` the strings of special tokens inside texts are ordinary text.
    """
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    cut = keep(pieces(docs, id_col, text_col, tokenizer, length, end_id, with_ids, plain), "pieces")
    shards = max(1, -(-cut.where(F.col("length") < length).count() // SHARD))
    # Equal rows get equal keys; their order in a shard does not matter, as they are alike.
    key = F.xxhash64("doc", "piece", "ids_crc32")
    dealt = cut.withColumn("shard", F.when(F.col("length") < length, F.pmod(key, F.lit(shards))).cast("int"))
    schema = T.StructType([*dealt.schema.fields, T.StructField("home", T.LongType()), T.StructField("offset", T.LongType())])

    def place(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("piece", "ascending")])
        home, offset, _ = sum_of_squares(rows["length"].to_numpy(), length)
        return rows.append_column("home", pa.array(home)).append_column("offset", pa.array(offset))

    placed = dealt.where("shard is not null").groupBy("shard").applyInArrow(place, schema)
    # Shares of the numbers: even ones for the shards' sequences, odd ones for full pieces.
    mixed = placed.withColumn("sequence_id", (F.col("home") * shards + F.col("shard")) * 2)
    alone = dealt.where("shard is null").withColumn("offset", F.lit(0).cast("long"))
    alone = alone.withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1)
    names = [F.col("doc").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return mixed.select(*names).unionAll(alone.select(*names))


@query()
def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), tokenizer=public_tokenizers.path("word_bpe_49k.json"), length=2048, end_id=0)
