import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.llm import topk


def brute(rows, k, scale):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 16])
def test_same_as_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SEEDS", 30)
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 7)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 6))
    rows = []
    for i in range(300):
        v = base[i % 12] + rng.normal(size=6) * rng.choice([0.01, 0.3, 2])
        rows.append((i, [float(x) for x in v * 10 ** rng.uniform(-2, 1)]))
    rows += [(None, [1.0] * 6), (400, None), (410, []), (420, [1.0, None] * 3), (430, [math.nan] * 6), (440, [math.inf] * 6), (450, [0.0] * 6)]
    rows += [(460, [1.0, 2.0]), (461, [2.0, 1.0]), (470, rows[3][1]), (471, rows[3][1]), (472, [3e9] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as block", "'x' as score")
    got = topk.top_k(vectors, F.col("vec_id") % 10 == 0, k=5, scale=64).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 64)


def test_fewer_rows_than_k_and_empty(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    got = topk.top_k(vectors, F.col("vec_id") == 0, k=10, scale=1).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 2), (0, 2, 2, 2)]
    assert topk.top_k(vectors.limit(0), F.lit(True)).collect() == []
