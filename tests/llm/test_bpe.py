import base64
import random
import time
from hashlib import sha256

import duckdb
import public_tokenizers
import pytest
import tiktoken

from floodmark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [
    "It's  we'll\tthey'RE 12345 x_y __ ...!!! naïve Ünïcödé 日本語 🙂🙂 é   x   y  z　",
    "a\x0b\x0cb\x1cc.\x1c.\x1d \x1f d\x85e  \n\n  f\r\n\t g   ",
    " leading", "trailing \n ", "\n", "   ", "<|endoftext|>", "\x00\x01", "ZZZZZZZZ" * 40, "ab" * 150,
]


def test_ids_are_the_librarys(library):
    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' where doc_id < 400").fetchall()]
    rng = random.Random(1)
    texts += ODD + ["".join(rng.choice(ODD[0] + ODD[1] + "    ") for _ in range(40)) for _ in range(400)]
    own = bpe.codec(PATH, public_tokenizers.PATTERN)
    for text, (ids, data) in zip(texts, own.encode(texts), strict=True):
        assert [int(x) for x in ids.split(b",") if x] == library.encode_ordinary(text), repr(text[:100])
        assert data == text.encode()


def test_rows_and_decoding(spark, library):
    rows = [(1, None, 1), (2, "", 2), (3, ODD[0], 3), (3, ODD[0], 3), (None, "x", 4), (4, "word " * 50_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long")
    got = bpe.round_trip(docs).collect()
    want = []
    for doc, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    ids = bpe.encode(docs)
    assert sorted((bytes(r.decoded).decode() for r in bpe.decode(ids).collect())) == sorted(t or "" for _, t, _ in rows)
    assert bpe.round_trip(docs.limit(0)).collect() == []


def test_long_words_are_the_librarys(library):
    rng = random.Random(5)
    own = bpe.Codec(PATH, public_tokenizers.PATTERN)
    tokens = sorted(own.ranks)
    texts = ["".join(rng.choice(kind) for _ in range(n)) for n in (63, 64, 65, 96, 97, 129, 700, 3000) for kind in ("ab", "abc", "ABab01+/", "-=", "=", "日本語テスト", "éèà")]
    texts += [b"".join(rng.choice(tokens) for _ in range(200)).decode("utf-8", "ignore").replace(" ", "") for _ in range(40)]
    for text in texts:
        ((ids, data),) = own.encode([text])
        assert [int(x) for x in ids.split(b",")] == library.encode_ordinary(text), text[:80]
        assert data == text.encode()


def test_a_megabyte_without_a_blank(library):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1 << 20))
    start = time.monotonic()
    ((ids, data),) = bpe.codec(PATH, public_tokenizers.PATTERN).encode([text])
    assert time.monotonic() - start < 60
    assert [int(x) for x in ids.split(b",")] == library.encode_ordinary(text) and data == text.encode()


def test_decode_leaves_out_unknown_ids(spark):
    ids = spark.createDataFrame([([None, 99_999_999],), (None,), ([],)], "ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(ids).collect()] == [b""] * 3
