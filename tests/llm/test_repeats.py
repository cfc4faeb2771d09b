import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.llm import exchange as X
from floodmark.llm import repeats


def brute(rows, window):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[k : k + window]) for _, w in texts for k in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["é", "the", "the", "the"]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    shared = [draw(n) for n in (34, 35, 36, 60, 120)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += draw(rng.randint(0, 80))
            if rng.random() < 0.5:
                s = rng.choice(shared)
                a = rng.randint(0, 5)
                parts += s[a:]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(100, None), (101, ""), (102, "a " * 200), (103, "b " * 36), (104, "a a b " * 90), (None, "x y"), (105, "   ")]
    rows += [(7, rows[7][1]), (200, rows[8][1]), (201, rows[8][1]), (102, "a " * 35)]
    rows.append((300, " ".join(draw(30_000))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 35)


def test_spans_and_carried_columns(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(1, "one " + passage + " two", 5), (2, passage, 6), (3, "left  as\nit is", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk int")
    got = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    assert got[1].spans == [[1, 41]] and got[2].spans == [[0, 40]] and got[3].spans == []
    whole = {r.doc_id: r for r in repeats.remove_repeats(docs, carry=True).collect()}
    assert whole[1].text == "one two" and whole[2].text == "" and whole[3].text == "left  as\nit is"
    assert whole[3].chunk == 7


def test_equal_rows_are_spread(spark):
    """A row that fills a third of the table lies in all chunks, and each of its copies is a document."""
    texts = [" ".join(f"{k}-{j}" for j in range(40)) for k in range(200)]
    rows = [(7, texts[0])] * 100 + list(enumerate(texts))[:200]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    packed = X.pack(df, ["doc_id", "text"], 4)
    held = {}
    for chunk, blob in packed.collect():
        ids = X.unpacked([blob], ["doc_id", "text"])["doc_id"].to_pylist()
        held[chunk] = held.get(chunk, 0) + ids.count(7)
    assert sum(held.values()) == 101 and len(held) == 4 and max(held.values()) < 60
    assert sorted(packed.collect()) == sorted(packed.collect())
    got = repeats.remove_repeats(df, window=35).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 35)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(docs).collect() == []


def test_each_window_holds_an_edge_with_its_reach():
    rng = np.random.default_rng(0)
    for vocabulary in (1, 2, 3, 50, 10_000):
        names = rng.integers(0, vocabulary, 5_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at = repeats.edges(names, np.array([0, len(names)]))
        assert np.diff(at, append=len(names)).max() <= repeats.ROUNDS[-1]
    assert 35 >= repeats.LEAST_WINDOW


def test_edges_depend_on_their_reach_only():
    rng = np.random.default_rng(5)
    for vocabulary in (2, 3, 8, 1000):
        inner = rng.integers(0, vocabulary, 400).astype(np.uint64)
        sides = [rng.integers(0, vocabulary, 50).astype(np.uint64) for _ in range(4)]
        found = []
        for left, right in (sides[:2], sides[2:]):
            names = np.concatenate([left, inner, right])
            at = repeats.edges(names, np.array([0, len(names)])) - 50
            found.append(set(at[(at >= repeats.REACH) & (at <= 400 - repeats.REACH)].tolist()))
        assert found[0] == found[1]
