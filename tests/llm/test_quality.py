import random

import numpy as np

from floodmark.llm import quality
from floodmark.llm.words import U64


def made_up(n=500, seed=4):
    rng = random.Random(seed)
    parts = ["tion", "er", "an", "ou", "the", "re", "in", "st", "é", "ble"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(30, 200))]
        kind = rng.choice(["clean"] * 6 + ["toxic", "signs", "capitals", "same"])
        if kind == "toxic":
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["vilefoo", "vilebar", "vilebaz"])
        text = " ".join(words)
        if kind == "signs":
            text = " ".join(w + "%%%&&" for w in words)
        if kind == "capitals":
            text = text.upper() + "!!"
        if kind == "same":
            text = " ".join(w for w in words[:8] for _ in range(30))
        docs.append((i, text, kind))
        if i % 2 == 0:
            labels.append((i, 0 if kind in ("signs", "capitals", "same") else 1, int(kind == "toxic")))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = made_up(1500)
    df = spark.createDataFrame(docs, "doc_id long, text string, kind string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.classify(df, told).select("row.doc_id", "row.kind", "rejected", "weak").collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.doc_id % 2]
    bad = [r for r in held if r.kind != "clean"]
    clean = [r for r in held if r.kind == "clean"]
    assert np.mean([r.rejected for r in bad]) >= 0.95
    assert np.mean([r.rejected for r in clean]) <= 0.02
    assert np.mean([r.weak > 0.5 for r in bad]) >= 0.9 and np.mean([r.weak > 0.5 for r in clean]) <= 0.05


def test_odd_rows(spark):
    docs, labels = made_up(120)
    odd = [(1000, None), (1001, ""), (1002, " ... "), (None, docs[0][1]), (0, docs[0][1]), (1003, "x " * 200_000)]
    rows = [(i, t, 1, "y") for i, t, _ in docs] + [(i, t, 2, "z") for i, t in odd]
    df = spark.createDataFrame(rows, "doc_id long, text string, given int, score string")
    told = spark.createDataFrame([*labels, (None, 0, 1), (7777, 0, 1), (0, None, None), labels[2]], "doc_id long, quality int, toxic int")
    got = quality.classify(df, told).collect()
    assert len(got) == len(rows) and got[0].row.asDict().keys() == {"doc_id", "text", "given", "score"}
    by = {r.row.doc_id: r for r in got}
    assert by[1000].rejected and by[1001].rejected and by[1002].rejected and by[1000].n_words == 0 and by[1003].n_words == 200_000


def test_no_labels_and_no_documents(spark):
    docs, _ = made_up(80)
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    told = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(df, told).count() == 80
    assert quality.classify(df.limit(0), told).collect() == []


def test_estimate_finds_the_better_labeller():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    votes = [np.where(rng.random(20_000) < p, truth, ~truth).astype(int) for p in (0.95, 0.9, 0.85, 0.6)]
    votes = np.stack([*votes, np.full(20_000, quality.NONE)], axis=1)  # no given labels
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    bad = quality.estimate(patterns, counts.astype(float))[inverse.ravel()]
    assert np.mean((bad > 0.5) == truth) > 0.95


def test_word_list_needs_support():
    docs = [np.array([1, 2, 100 + k, 200 + k, 300 + k, 400 + k, 500 + k], U64) for k in range(9)]
    clean = [np.array([3, 1000 + k, 2000 + k], U64) for k in range(50)]
    assert quality.word_list(docs + clean, np.array([True] * 9 + [False] * 50)).tolist() == [1, 2]
    assert quality.word_list([docs[0]] * 9 + clean, np.array([True] * 9 + [False] * 50)).tolist() == []  # copies count once
    assert len(quality.word_list(clean, np.zeros(50, bool))) == 0


def test_labels_of_other_documents_do_not_fill_the_sample(spark):
    """Documents are a part of the labelled ones: their own labels are what the model learns from."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    kinds = ", ".join(f"cast({v} as {own.schema[c].dataType.simpleString()}) as {c}" for c, v in (("doc_id", "id + 1000000"), ("quality", "1"), ("toxic", "0")))
    others = spark.range(5000).selectExpr(*kinds.split(", "))
    few = own.count()
    alone = quality.classify(docs, own, fit_rows=few)
    among = quality.classify(docs, own.unionByName(others), fit_rows=few)
    scores = [sorted((r.doc_id, round(r.score, 6), r.rejected) for r in d.select("row.doc_id", "score", "rejected").collect()) for d in (alone, among)]
    assert scores[0] == scores[1] and any(r for _, _, r in scores[0])
