"""Nearest neighbours against all pairs: recall, exact scores, ties, vectors that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import rp_forest as R

EVERY_20TH = "vec_id % 20 = 0"


def held(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


@pytest.mark.parametrize("structure", ["none", "clusters"])
def test_recall(spark, structure):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(3000, 32))
    if structure == "clusters":
        points = points * 0.1 + rng.normal(size=(30, 32))[rng.integers(0, 30, 3000)]
    points = points.astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "vec_id long, embedding array<float>")
    got, exact, hits = held(R.search(df, F.expr(EVERY_20TH))), points.astype(np.float64), 0
    assert sorted(got) == list(range(0, 3000, 20))
    for q, found in got.items():
        far = np.sqrt(np.square(exact - exact[q]).sum(axis=1))
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(v != q and s == pytest.approx(far[v], rel=1e-12) for _, v, s in found)
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        far[q] = np.inf
        hits += len({v for _, v, _ in found} & set(np.argsort(far)[:10].tolist()))
    assert hits / (10 * len(got)) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
            (6, [1.0, 0.0, 0.0]), (None, [1.0, 0.1]), (40, [nan, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (60, [-0.0, 2.0])]
    rows += [(100 + i, [3.0, 3.0]) for i in range(1, 15)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, v string, ids int")
    got = held(R.search(df, F.expr(EVERY_20TH)))
    assert sorted(got) == [0, 20, 60]
    near = [v for _, v, _ in got[0]]
    assert near[0] == 20 and near[1:3] == [7, 60] and near[3:] == list(range(101, 108))
    assert [v for _, v, _ in got[20]][:2] == [0, 7]
    assert R.search(df.where("false"), F.expr(EVERY_20TH)).isEmpty()
