import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowml.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label string, id string, v string, key string, code string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def brute(rows, parts, entries, rounds):
    """{position in the sorted kept rows: (code, error)} and the codebooks, by plain loops."""
    kept = [(i, [math.floor(256 * x) for x in e], lab) for i, e, lab in rows
            if e and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[tuple(e[p * width:(p + 1) * width]) for p in range(parts)] for _, e, _ in kept]
    books = [[cut[k][p] for k in range(min(entries, len(kept)))] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for row in cut:
                held.setdefault(near(row[p], books[p])[1], []).append(row[p])
            books[p] = [tuple(sum(col) // len(held[k]) for col in zip(*held[k])) if k in held else c
                        for k, c in enumerate(books[p])]
    out = []
    for (i, _, lab), row in zip(kept, cut):
        found = [near(row[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, books


def compared(spark, rows, parts=4, entries=8, rounds=2):
    got, books = vc.compress(table_of(spark, rows), parts=parts, entries=entries, rounds=rounds)
    want, plain = brute(rows, parts, entries, rounds)
    by_label = {}
    for _, lab, _, err in want:
        by_label[lab] = by_label.get(lab, 0) + err
    key = lambda r: (r[0] is None, *(-1 if x is None else x for x in r[:1]), *r[1:])
    assert sorted(((r.id, r.code, r.error, r.label_error) for r in got.collect()), key=key) == sorted(
        ((i, c, e, by_label[lab]) for i, lab, c, e in want), key=key)
    assert books.entries.tolist() == [[list(c) for c in b] for b in plain]


def test_equals_plain_loops(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=8).round(2).tolist(), None if i % 7 == 0 else f"l{i % 3}") for i in range(300)]
    compared(spark, rows)
    compared(spark, rows, parts=2, entries=64, rounds=3)


def test_odd_rows(spark):
    rows = [(1, [0.1] * 8, "a"), (1, [0.1] * 8, "a"), (1, [-0.7] * 8, "b"), (None, [0.5] * 8, None), (2, None, "a"),
            (3, [0.1] * 7 + [None], "a"), (4, [0.1] * 7 + [float("nan")], None), (5, [], "a"),
            (6, [0.1] * 7 + [float("inf")], None), (7, [-0.001] * 8, None), (8, [0.3] * 8, "")]
    compared(spark, rows)          # fewer vectors than entries
    compared(spark, rows, entries=2)
    many = [(i, [float(i % 2)] * 8, None) for i in range(50)]   # ties and equal entries everywhere
    compared(spark, many, entries=20)


def test_empty_and_refused(spark):
    got, books = vc.compress(table_of(spark, [(1, None, "a")]))
    assert got.count() == 0 and books is None
    for bad in ([(1, [0.1] * 16, "a"), (2, [0.1] * 32, "a")], [(1, [0.1] * 15, "a")], [(1, [1e300] * 16, "a")]):
        with pytest.raises(ValueError):
            vc.compress(table_of(spark, bad))


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 80), st.integers(1, 3), st.sampled_from([2, 5, 300, 2 ** 27]))
def test_tree_equals_all_distances(seed, n, dims, spread):
    """Few different values make ties; large ones test the rounding of distances."""
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread, (n, dims))
    queries = np.concatenate([rng.integers(-spread, spread, (60, dims)), points[:20]])
    d2 = vc.squared(queries, points)
    entry, best, _ = vc.Gnat(points, degree=3, leaf=2).nearest(queries)
    assert (best == d2.min(axis=1)).all() and (entry == d2.argmin(axis=1)).all()


def test_subtrees_are_left_out():
    rng = np.random.default_rng(1)
    centres = rng.integers(-5000, 5000, (8, 4))
    points = (centres[:, None] + rng.integers(-40, 40, (8, 8, 4))).reshape(-1, 4)
    queries = points[rng.integers(0, 64, 2000)] + rng.integers(-30, 30, (2000, 4))
    measured = vc.Gnat(points).nearest(queries)[2]
    assert measured < 0.5 * len(queries) * len(points)


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist(), "a") for i in range(200)]
    got, books = vc.compress(table_of(spark, rows), parts=4, entries=32)
    source = {i: np.array(e) for i, e, _ in rows}
    for r in vc.decode(got, books).collect():
        away = ((np.floor(source[r.id] * 256) + 0.5) / 256 - np.array(r.vector)) ** 2
        assert math.isclose(away.sum() * 256 ** 2, r.error, rel_tol=1e-6, abs_tol=1e-6)
