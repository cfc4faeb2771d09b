import random

import pytest

from floodmark.llm import near
from floodmark.llm.words import split


def brute(rows, width, percent):
    sets, up = [], {}
    for i, t in rows:
        w = split(t, lower=True)
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
        if i is not None:
            up.setdefault(i, i)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, _) in enumerate(rows):
        for y in range(x):
            j = rows[y][0]
            if i is None or j is None or not sets[x] or not sets[y]:
                continue
            if 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def corpus(seed, n=60, copies=90):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(copies):  # a chain of one large group, some members far from each other
        text = base[:]
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((1000 - i, " ".join(text)))
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(1, 80))]
        rows.append((i, " ".join(text)))
        if rng.random() < 0.4:
            text[rng.randrange(len(text))] = "changed"
            rows.append((200 + i, " ".join(text).upper()))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a"), (504, "A"), (505, "a b"), (506, "b a"), (None, "a"), (None, None)]
    rows += [rows[5], rows[5], (507, rows[5][1]), (503, "another text under the same id")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, block", [(1, 512), (2, 16)])
def test_same_as_brute_force(spark, seed, block):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as rep", "2 as part")
    got = near.near_duplicates(docs, width=3, percent=85, block=block).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 3, 85)


def test_empty_table(spark):
    assert near.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pruning_bounds_follow_the_miss_probability():
    loose, strict = near.least_matches(85, 1e-2), near.least_matches(85, 1e-9)
    assert all(a > b for a, b in zip(loose, strict, strict=True)) and list(loose) == sorted(loose)
    assert near.least_matches(85, 1e-6)[-1] < 0.85 * near.HASHES


@pytest.mark.parametrize("block", [512, 4])
def test_each_text_of_an_id_reaches_its_near_copies(spark, block):
    rng = random.Random(6)
    rows = []
    for k in range(12):  # two texts under id k, each the smallest of its class, each with a near copy
        for side in (1, 2):
            text = [f"w{k}x{side}x{rng.randrange(1000)}" for _ in range(60)]
            rows += [(k, " ".join(text))] * rng.randint(1, 2)
            rows.append((100 * side + k, " ".join([*text[:-1], "changed"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near.near_duplicates(docs, width=3, percent=85, block=block).collect()
    want = brute(rows, 3, 85)
    assert {r[2] for r in want} == set(range(12))
    assert sorted(map(tuple, got), key=str) == want
