import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from floodmark.llm import forest


def brute(rows, cosine):
    good = [i is not None and lab is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v, lab in rows]
    up = {i: i for i, _, _ in rows if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    n = [0] * len(rows)
    for x, (i, v, a) in enumerate(rows):
        for y in range(x):
            j, w, b = rows[y]
            if good[x] and good[y] and a == b and len(v) == len(w):
                v_, w_ = np.array(v), np.array(w)
                if v_ @ w_ / math.sqrt((v_ @ v_) * (w_ @ w_)) >= cosine:
                    n[x] += 1
                    n[y] += 1
                    p, q = sorted((root(i), root(j)))
                    up[q] = p
    return sorted(((i, n[x], None if i is None else root(i), i is None or root(i) == i) for x, (i, _, _) in enumerate(rows)), key=str)


def corpus(seed):
    rng = np.random.default_rng(seed)
    rows, ids = [], iter(rng.permutation(2000).tolist())
    base = rng.normal(size=(14, 12))
    for k in range(330):
        spread = [0.05, 0.35, 2][k % 3]
        v = base[k % 14] + rng.normal(size=12) * spread
        rows.append((next(ids), [float(x) for x in np.float32(v)], int(k % 2)))
    tight = rng.normal(size=12)
    for _ in range(90):
        rows.append((next(ids), [float(x) for x in np.float32(tight + rng.normal(size=12) * 0.02)], 1))
    rows += [(next(ids), rows[0][1], rows[0][2]) for _ in range(5)]
    v = rows[1][1]
    rows += [(5000, v, None), (5001, None, 1), (5002, [], 1), (5003, [0.0] * 12, 1), (5004, [math.nan] * 12, 1), (5005, [None, *v[1:]], 1), (5006, v[:5], 1)]
    rows += [(5007, [math.inf] * 12, 1), (None, v, 1), rows[4], (rows[5][0], rows[6][1], rows[6][2]), (5008, [3 * x for x in v], rows[1][2])]
    return rows


@pytest.mark.parametrize("seed, leaf", [(1, 1024), (2, 40)])
def test_same_as_brute_force(spark, seed, leaf):
    rows = corpus(seed)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as leaf", "2 as cid")
    got = sorted(map(tuple, forest.near_vectors(vectors, cosine=0.93, leaf=leaf).collect()), key=str)
    want = brute(rows, 0.93)
    links = sum(w[1] for w in want)
    found = sum(g[1] for g in got)
    assert len(got) == len(want) and 0.99 * links <= found <= links
    if leaf == 1024:  # one leaf holds all: nothing can be missed
        assert got == want


def test_empty_table(spark):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert forest.near_vectors(vectors).collect() == []


def test_recall_with_the_registered_parameters_on_a_label_that_is_split(spark):
    """Pairs just above the threshold, in a label of several leaves: what the trees find against all pairs."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = 0.9305
    v = np.float32(np.concatenate([base, cosine * base + math.sqrt(1 - cosine**2) * away]))
    rows = [(k, x, 1) for k, x in enumerate(v.tolist())]
    got = forest.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = ((u @ u.T) >= 0.93).sum() - len(u)
    found = sum(r.n_links for r in got)
    assert links >= 5900 and 0.99 * links <= found <= links


def test_a_group_larger_than_a_leaf_is_not_copied_at_each_split(spark):
    """A tight group has about one place in each tree, and all its pairs are counted."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(4000, 32))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[:600] = v[0] + rng.normal(size=(600, 32)) * 0.017
    rows = [(k, x, 1) for k, x in enumerate(np.float32(v).tolist())]
    vectors = spark.createDataFrame(rows, "cid long, embedding array<float>, label int")
    placed = forest.leaves(vectors.withColumn("dim", F.size("embedding")), 4, forest.SPILL, 200)
    assert 4 * 600 <= placed.where("cid < 600").count() <= 2 * 4 * 600
    got = forest.near_vectors(vectors, id_col="cid", trees=4, leaf=200).collect()
    u = np.float32(v).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = ((u @ u.T) >= 0.93).sum() - len(u)
    assert links > 600 * 500 and sum(r.n_links for r in got) == links


def test_pairs_that_share_a_lower_leaf_are_left_to_it():
    rng = np.random.default_rng(4)
    codes = [sorted({7, *rng.integers(-300, 60, rng.integers(1, 90)).tolist()}) for _ in range(150)]
    i, j = np.triu_indices(150, 1)
    own = forest.first_met(pa.array([[], *codes], pa.list_(pa.int64()))[1:], 7, i, j)
    assert own.tolist() == [k for k, (a, b) in enumerate(zip(i, j)) if min({*codes[a]} & {*codes[b]}) == 7]
    linked = rng.random(len(i)) < 0.01
    label = forest.least_reached(150, i[linked], j[linked])
    want = np.arange(150)
    for _ in range(150):
        np.minimum.at(want, i[linked], want[j[linked]])
        np.minimum.at(want, j[linked], want[i[linked]])
    assert (label == want).all()
