import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from floodmark.llm import exchange, katz

END, START = "</end>", "<start>"


def brute(rows, order):
    """A plain Katz model over tuples."""
    docs = []
    for i, t in rows:
        tokens = [w.decode() for w in (t or "").encode().lower().split()] + [END]
        docs.append((i, i is not None and crc32(str(i).encode()) % 7 == 2, tokens))
    grams = [Counter() for _ in range(order)]
    for _, held, tokens in docs:
        if not held:
            padded = [START] * (order - 1) + tokens
            for p in range(len(tokens)):
                for k in range(order):
                    grams[k][tuple(padded[p + order - 1 - k : p + order])] += 1
    n, v = sum(grams[0].values()), len(grams[0])
    factors = []
    for g in grams:
        seen = Counter(g.values())
        factors.append(katz.discounts(np.array([0] + [seen[r] for r in range(1, katz.DISCOUNTED + 2)])))
    by = [defaultdict(dict) for _ in range(order)]
    for k, g in enumerate(grams):
        for gram, c in g.items():
            by[k][gram[:-1]][gram[-1]] = c
    memo = {}

    def chance(context, word):
        key = context, word
        if key not in memo:
            memo[key] = _chance(context, word)
        return memo[key]

    def _chance(context, word):
        k = len(context)
        followers = by[k].get(context, {})
        if not followers:
            return 1.0 if not k else chance(context[1:], word)
        total = sum(followers.values())
        d = lambda c: factors[k][c] if c <= katz.DISCOUNTED else 1.0
        mass = sum(d(c) * c for c in followers.values()) / total
        least = 1 / (2 * (total + 1))
        scale = (1 - least) / mass if 1 - mass < least else 1.0
        if word in followers:
            return scale * d(followers[word]) * followers[word] / total
        left = 1 - mass * scale
        return left if not k else left / (1 - sum(chance(context[1:], w) for w in followers)) * chance(context[1:], word)

    out = []
    for i, held, tokens in docs:
        padded = [START] * (order - 1) + tokens
        score = sum(math.log10(chance(tuple(padded[p : p + order - 1]), padded[p + order - 1])) for p in range(len(tokens)))
        base = sum(math.log10((grams[0][(t,)] + 1) / (n + v + 1)) for t in tokens)
        out.append((i, held, len(tokens), sum(grams[0][(t,)] > 0 for t in tokens), n, base, score))
    return out, chance, set(w for (w,) in grams[0])


def corpus():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice(words[: rng.choice([5, 20, 60])]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "UNSEEN words\x0bé É"), (None, "a b"), (3, rows[3][1]), (503, "the only " * 300)]
    return rows


@pytest.mark.parametrize("order", [1, 2, 3])
def test_same_as_brute_force(spark, order):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as held", "2 as chunk")
    got = sorted(map(tuple, katz.score(docs, order=order).collect()), key=lambda r: (str(r[0]), r[5]))
    want = sorted(brute(rows, order)[0], key=lambda r: (str(r[0]), r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_chances_sum_to_one():
    _, chance, words = brute(corpus(), 3)
    for context in ((), ("w1",), ("w1", "w2"), (START, START), ("only", "the"), ("none", "such")):
        assert abs(sum(chance(context, w) for w in [*words, "never seen"]) - 1) < 1e-9


def test_no_training_rows_and_empty_table(spark):
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    docs = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    (r,) = katz.score(docs).collect()
    assert tuple(r) == (held, True, 3, 0, 0, 0.0, 0.0)
    assert katz.score(docs.limit(0)).collect() == []


def test_bigrams_with_equal_upper_bytes_are_told_apart(spark):
    # The names of (start, n1381280) and (start, n284381) share their upper 40 bits, as do those of the contexts c and d.
    train = [i for i in range(60) if crc32(str(i).encode()) % 7 != 2]
    c, d = "n554803", "n1331045"
    texts = ["n1381280"] * 5 + ["n284381"] * 2 + [f"{c} x"] * 7 + [f"{d} y x"] * 3
    rows = [*zip(train, texts), (1000 + next(i for i in range(100) if crc32(str(1000 + i).encode()) % 7 == 2), f"n284381 {d} x {c} y")]
    got = sorted(map(tuple, katz.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    want = sorted(brute(rows, 2)[0])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_close_names_come_back_whole():
    rng = np.random.default_rng(4)
    for n in (1, 2, 1000):
        for high in (1 << 20, 1 << 45, 1 << 63):
            names = np.sort(rng.integers(0, high, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            assert (exchange.open_up(exchange.close(names)) == names).all()
