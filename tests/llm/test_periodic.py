import random
from hashlib import sha256
from zlib import crc32

import pytest

from floodmark.llm import periodic


def brute(words, least=12):
    """Runs by comparing the words with themselves shifted, for each period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            smaller = any(all(part[k] == part[k + d] for k in range(len(part) - d)) for d in range(1, q))
            if len(part) >= max(least, 2 * q) and not smaller:
                out.append((i, len(part), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_same_as_shifted_comparison(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n, kinds = rng.randrange(70), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 4 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randrange(3, 10)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        least = rng.choice([2, 3, 7, 12])
        want = brute(words, least)
        assert periodic.runs_in(words, least) == want
        assert periodic.runs_of([b"%d" % w for w in words], least) == want


def test_fibonacci_words_have_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert periodic.runs_in(b[:600]) == brute(b[:600])


def test_a_long_periodic_text_takes_linear_time():
    unit = [b"w%d" % (i * i % 9973) for i in range(40_000)]
    assert (0, 120_000, 40_000) in periodic.runs_of(unit * 3)


def planted(doc_id, text):
    words = [] if text is None else text.encode().split()
    n, h = len(words), None if doc_id is None else crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    told = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *told, sha256(lines.encode()).hexdigest(), sha256(kept).hexdigest())


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for k in range(150):
        words = [rng.choice(["a", "b", "cé", "d e", "F"]) for _ in range(rng.randrange(80))]
        if k % 3 == 0:
            words = words[:10] * rng.randrange(1, 7)
        rows.append((k, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(200, None), (201, ""), (202, " \n "), (2**60 + 1, "x y " * 9), (None, "x y " * 9), (3, rows[3][1]), (None, None), (203, "z " * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as runs", "3 as n_words", "4 as best")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)
    whole = periodic.find_runs(docs.where("doc_id = 203")).first()
    assert whole.n_words == 400 and [tuple(r) for r in whole.runs] == [(0, 400, 1)] and whole.collapsed_text == "z"


def test_empty_table(spark):
    assert periodic.find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
