"""Ids beyond 2**53 beside null ids: no operator may round them."""

import pytest

from floodmark.llm import bpe, chat, katz, langid, near, packing, periodic, quality, repeats

BIG = 2**60 + 1
WORDS = " ".join(f"word{k}" for k in range(60))
ROWS = [(BIG, f"{WORDS} one two"), (None, f"{WORDS} one two"), (BIG + 1, f"{WORDS} one two"), (None, None), (BIG + 2, "quite another text"), (None, "quite another text")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if n == 1 else BIG + n) for n, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n long").coalesce(1)


def ids(df):
    return sorted([r.doc_id for r in df.select("doc_id").collect()], key=str)


WANT = sorted([i for i, _ in ROWS], key=str)


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: bpe.round_trip(d),
        lambda d: bpe.encode(d),
        lambda d: katz.score(d),
        lambda d: packing.pack(d),
        lambda d: repeats.remove_repeats(d),
        lambda d: near.near_duplicates(d),
        lambda d: periodic.find_runs(d),
        lambda d: langid.predict(d, None),
    ],
    ids=["bpe", "encode", "katz", "packing", "repeats", "near", "periodic", "langid"],
)
def test_ids_stay_whole(docs, operator):
    assert ids(operator(docs)) == WANT


def test_near_duplicates_join_the_right_ids(docs):
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect() if r.doc_id is not None}
    assert got == {BIG: BIG, BIG + 1: BIG, BIG + 2: BIG + 2}


def test_carried_columns(spark, docs):
    got = sorted(((r.doc_id, r.n) for r in repeats.remove_repeats(docs, carry=True).collect()), key=str)
    assert got == sorted(((r.doc_id, r.n) for r in docs.collect()), key=str)


def test_chat(spark):
    turns = [(i, k, r, "hi") for i in (BIG, None, BIG + 1) for k, r in enumerate(("user", "assistant"))]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = chat.format_paths(chat.chained(rows, "conv_id", "turn", "role", "text"))
    assert sorted([r.tree for r in got.collect()], key=str) == sorted([BIG, None, BIG + 1], key=str)


def test_quality(spark, docs):
    labels = spark.createDataFrame([(BIG, 1, 0), (BIG + 2, 0, 1)], "doc_id long, quality int, toxic int")
    assert ids(quality.classify(docs, labels).select("row.doc_id")) == WANT
