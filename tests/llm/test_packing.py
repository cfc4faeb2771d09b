import random
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from floodmark.llm import packing
from floodmark.llm.words import split

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


ODD = [
    "It's I'LL 'tis don't__x _a_ a_b __ $_$ x's'll ''s 12,345.6 (a)[b] É́ é ﬁ İstanbul ΑΣ ΑΣ. ß ŉ ſ ĳ",
    "<|endoftext|> <|startoftext|>x </w> ÀÉ×÷ ª º ² ½ naïve ŒUVRE 日本語 テスト 🙂🙂 a b c \x0b\x0c\x1c\x1d x\x00y",
    "tab\tnew\nline\r\nend  ",
    "-_- _._ ._. a-_b 'S 'T D'Accord l'été ‘quote’ “x” ​ zero",
]


def test_ids_are_the_tokenizers(whole):
    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    rng = random.Random(3)
    texts += ODD + ["".join(rng.choice(ODD[0] + ODD[1] + ODD[3] + "   ") for _ in range(60)) for _ in range(300)]
    texts += ["a<|endoftext|>b it<|endoftext|>'s <|endoftext|><|startoftext|>É́<|startoftext|>1 <|ENDOFTEXT|> < |endoftext|> <|endoftext|"]
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    for known, want in [(packing.word_ids(PATH), whole), (packing.word_ids(PATH, True), lambda t: plain.encode(t, add_special_tokens=False).ids)]:
        for text in texts:
            words = split(text)
            known.learn(set(words))
            assert np.frombuffer(known.encode(words), "<u4").tolist() == want(text), text[:200]


def test_words_of_many_texts_stay_known():
    known = packing.WordIds(PATH)
    words = [b"%d" % i for i in range(320_000)]
    known.learn(set(words[:290_000]))
    known.learn(set(words[290_000:]))
    assert len(known.known) == len(words)


def check(rows, texts, whole, length):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, mine in by_doc.items():
        ids = whole(texts[doc] or "") + [0]
        assert sorted((r.piece, r.start, r.length) for r in mine) == [(k, a, min(length, len(ids) - a)) for k, a in enumerate(range(0, len(ids), length))]
        for r in mine:
            assert r.ids_crc32 == crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for mine in by_sequence.values():
        at = 0
        for r in sorted(mine, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_sequence)


def test_pack_documents(spark, whole):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, length=512).collect()
    n = check(rows, {r.doc_id: r.text for r in docs.collect()}, whole, 512)
    assert n <= 1.01 * sum(r.length for r in rows) / 512 + 1


def test_null_empty_long_and_repeated(spark, whole):
    texts = {1: None, 2: "", 3: "word " * 700, 4: " ", 5: "a " * 7, 6: "a " * 8}
    docs = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, piece int")
    assert check(packing.pack(docs, length=8).collect(), texts, whole, 8)
    twice = packing.pack(docs.unionAll(docs), length=8).collect()
    assert len(twice) == 2 * packing.pack(docs, length=8).count()
    assert packing.pack(docs.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None, "x"), (None, None)], "doc_id long, text string")
    assert len(packing.pack(nulls).collect()) == 2


def test_rule_keeps_order_and_room():
    rng = np.random.default_rng(0)
    sizes = np.sort(rng.integers(1, 100, 3000))[::-1]
    home, offset, opened = packing.sum_of_squares(sizes, 100)
    fill = np.bincount(home, weights=sizes)
    assert fill.max() <= 100 and len(fill) == opened and opened <= 1.03 * max(sizes.sum() / 100, (sizes > 50).sum()) + 1
    for k in range(50):
        mine = np.flatnonzero(home == k)
        assert offset[mine].tolist() == [0, *np.cumsum(sizes[mine])[:-1].tolist()]
