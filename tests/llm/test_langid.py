from zlib import crc32

import numpy as np
import pytest

from floodmark.llm import langid

SF = "/root/testdata/sf0.01"


def test_windows_hold_every_group_of_bytes():
    for n in (0, 1, 4, 5, 255, 256, 257, 508, 509, 1000, 5000):
        data = bytes(np.random.default_rng(n).integers(97, 123, n, dtype=np.uint8))
        rows, sizes = langid.windows(data.decode())
        assert rows.shape[1] == langid.WINDOW and len(rows) == len(sizes)
        seen = {bytes(r[k : k + langid.WIDEST]) for r in rows for k in range(langid.WINDOW - langid.WIDEST + 1)}
        assert {data[k : k + langid.WIDEST] for k in range(n - langid.WIDEST + 1)} <= seen
        assert (sizes > 0).all() or n == 0


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    rows, labels = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    net = langid.Network.fresh(["a", "b", "c"])
    parts = ["bytes", "filters", "bias", "weights", "offset"]
    for name in parts:  # doubles, so that differences say something
        setattr(net, name, getattr(net, name).astype(np.float64))

    def loss():
        chance = langid.softmax(net.logits(rows))
        return -np.log(chance[np.arange(5), labels]).mean()

    for name, slope in zip(parts, net.slopes(rows, labels), strict=True):
        own = getattr(net, name)
        for at in rng.permutation(own.size)[:12]:
            spot = np.unravel_index(at, own.shape)
            if name == "bytes":
                spot = (rows.ravel()[at % rows.size], spot[1])
            if name == "filters" and not net.shape[spot]:
                continue
            own[spot] += 1e-6
            high = loss()
            own[spot] -= 2e-6
            low = loss()
            own[spot] += 1e-6
            assert abs((high - low) / 2e-6 - slope[spot]) < 1e-4


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in langid.op12_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [d for d in docs if got[d.doc_id].held_out and d.lang is not None and any(c.isalpha() for c in d.text or "")]
    right = sum(got[d.doc_id].lang_pred == d.lang for d in held)
    assert len(held) > 250 and right >= 0.97 * len(held)


def test_odd_rows(spark):
    en, de = "the cat and the dog went to the house of the man ", "der hund und die katze gehen zu dem haus von der frau "
    rows = [(k, (en if k % 2 else de) * (1 + k % 4), "en" if k % 2 else "de") for k in range(80)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 ?! 3", "de"), (103, en * 4000, None), (2**60 + 1, de, None), (None, en, "en"), (5, rows[5][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as c0", "2 as mark", "3 as turn", "4 as score")
    network = langid.learn(docs)
    assert network.languages == ["de", "en"]
    got = [(r.doc_id, r.lang_pred) for r in langid.predict(docs.repartition(3), network).collect()]
    want = [(i, "und" if t is None or not any(c.isalpha() for c in t) else "en" if t.startswith("the") else "de") for i, t, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("rows", [[], [(1, "some words", None)], [(1, None, "en")]])
def test_nothing_to_learn_from(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = langid.learn(docs)
    assert network is None
    assert [tuple(r) for r in langid.predict(docs, network).collect()] == [(i, "und", 0.0) for i, _, _ in rows]


def test_one_language(spark):
    docs = spark.createDataFrame([(1, "some words here", "en"), (2, "quelques mots", None)], "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.learn(docs)).collect()
    assert sorted(map(tuple, got)) == [(1, "en", 1.0), (2, "en", 1.0)]
