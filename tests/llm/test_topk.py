import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowml.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, part string, score string"


def brute(rows, k=20):
    good = [(i, [math.floor(64 * np.float32(x).astype(float)) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    return {q: [x for x in sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q))][:k]
            for q, v in good if q % 20 == 0}


def result(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.id))
    return out


def test_matches_brute_force_over_several_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6).astype(np.float32)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(400, [0.0] * 6), (401, None), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
                                                          (420, [float("nan")] + [0.0] * 5), (440, [float("inf")] + [0.0] * 5), (None, [0.1] * 6)]
    df = spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, block_rows=64, query_rows=5).collect()
    assert result(got) == brute(rows)


def test_few_rows_and_empty_table(spark):
    df = spark.createDataFrame([(0, [0.5]), (1, [0.25]), (2, [-0.5])], "vec_id long, embedding array<float>")
    assert result(topk.top_k(df, F.col("vec_id") % 20 == 0).collect()) == {0: [(-512, 1), (1024, 2)]}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.integers(1, 5), st.integers(1, 6), st.integers(0, 10**6))
def test_threshold_stop_is_exact(n, dims, k, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, (n, dims)).astype(float)
    ids = rng.permutation(n)
    q = rng.integers(-3, 4, (2, dims)).astype(float)
    for (got, scores), qv, own in zip(topk.threshold_search(x, ids, q, np.array([0, -1]), k, first=2), q, (0, -1)):
        want = sorted((-s, i) for s, i in zip(x @ qv, ids) if i != own)[:k]
        assert sorted((-s, i) for s, i in zip(scores, got)) == want


def test_reads_less_than_everything_when_a_vector_stands_out():
    x = np.zeros((4096, 2))
    x[:, 0] = np.arange(4096) % 7
    x[5] = 900, 900
    seen = []

    class Spy(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    topk.threshold_search(x.view(Spy), np.arange(4096), np.array([[1.0, 1.0]]), np.array([-1]), 1, first=4)
    assert max(seen) <= 16
