"""Nearest neighbours against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonetape.llm.neighbours import nearest


def brute(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in sorted({i for i, _ in good if i % 5 == 0}):
        own = min(tuple(v) for i, v in good if i == q)
        scored = []
        for i, v in good:
            if i != q and len(v) == len(own):
                s = 0.0
                for a, b in zip(own, v):
                    s += a * b
                scored.append((-s, i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return {q: x for q, x in out.items() if x}


def found(spark, rows, k, **more):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, dim string, id int").repartition(4)
    got = {}
    for r in nearest(table, F.col("id") % 5 == 0, k=k, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d)).astype(np.float32) * rng.choice([1e-3, 1, 50], (n, 1)).astype(np.float32)
    v[10:30] = v[10]
    return [(i, row.tolist()) for i, row in enumerate(v)]


@pytest.mark.parametrize("k,query_block,candidate_block", [(20, 4096, 8192), (3, 7, 11), (5, 50, 2)])
def test_exact(spark, k, query_block, candidate_block):
    rows = vectors(1, 220, 16)
    assert found(spark, rows, k, query_block=query_block, candidate_block=candidate_block) == brute(rows, k)


def test_odd_rows(spark):
    rows = vectors(2, 40, 4) + [(None, [1.0] * 4), (45, None), (50, [0.0] * 4), (55, [1.0, None, 1.0, 1.0]), (60, [float("nan")] * 4)]
    rows += [(65, [float("inf")] * 4), (70, [1.0, 2.0]), (75, [3.0, 1.0]), (80, [1.0] * 5), (5, [9.0] * 4), (0, rows[0][1]), (101, rows[7][1]), (101, rows[7][1])]
    assert found(spark, rows, 20) == brute(rows, 20)


def test_empty(spark):
    assert found(spark, [(1, None)], 20) == {}
    assert found(spark, [(0, [1.0, 2.0])], 20) == {}
