import random

import numpy as np
import pytest

from flowml.llm import graph, jaccard


def shingle_sets(rows):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        out.setdefault(i, []).append(s)
    return out


def brute(rows):
    sets = [(i, s) for i, many in shingle_sets(rows).items() for s in many if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                i, j = find(i), find(j)
                root[max(i, j)] = min(i, j)
    return {i: find(i) for i, _ in sets}


def family(rng, size, copies, edits, start, shared=""):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    rows = []
    for c in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        rows.append((start + c, f"{shared} " + " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    shared = " ".join(f"s{i}" for i in range(12))
    out = family(rng, 60, 40, 3, 100) + family(rng, 80, 12, 2, 300, shared) + family(rng, 30, 9, 1, 400)
    for n in range(60):
        out += family(rng, rng.randint(1, 60), 1, 0, 1000 + n, shared if n % 2 else "")
    return out


@pytest.mark.parametrize("limits", [{}, {"region_points": 8, "levels": 2}, {"region_points": 3, "levels": 0}])
def test_components_match_brute_force(make_docs, rows, limits):
    got = jaccard.jaccard_components(make_docs(rows), **limits).collect()
    want, sizes = brute(rows), {i: len(s[0]) for i, s in shingle_sets(rows).items()}
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == sizes[r.doc_id] for r in got)


def test_odd_rows(odd_docs, make_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = jaccard.jaccard_components(odd_docs).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
    assert {r.doc_id: r.n_shingles for r in got}[2] == 0
    assert jaccard.jaccard_components(make_docs([])).collect() == []


def test_exactly_at_the_threshold(make_docs):
    # Ten shingles against 9, 8 and 7 of them: 0.9, 0.8 and 0.7.
    rows = []
    for n, cut in enumerate((13, 12, 11)):
        words = [f"{n}w{i}" for i in range(14)]
        rows += [(10 * n + 1, " ".join(words)), (10 * n + 2, " ".join(words[:cut]))]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(make_docs(rows)).collect()}
    assert got == {1: 1, 2: 1, 11: 11, 12: 11, 21: 21, 22: 22}


def test_signature_keeps_every_link():
    rng = np.random.default_rng(2)
    frequent = np.sort(rng.choice(2**40, 50, replace=False).astype(np.uint64))
    for _ in range(300):
        n = int(rng.integers(1, 60))
        x = np.unique(np.concatenate([rng.choice(2**40, n).astype(np.uint64), rng.choice(frequent, int(rng.integers(0, 20)))]))
        keep = x[rng.random(len(x)) > rng.random() * 0.25]
        y = np.unique(np.concatenate([keep, rng.choice(2**40, int(rng.integers(0, 1 + n // 8))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= 80 * (len(x) + len(y) - both):
            assert len(np.intersect1d(jaccard.signature(x, frequent), jaccard.signature(y, frequent)))


def test_sketches_never_drop_a_link():
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(1, 9000))
        x = np.unique(rng.choice(2**60, n).astype(np.uint64))
        keep = x[rng.random(len(x)) > rng.random() * 0.25]
        y = np.unique(np.concatenate([keep, rng.choice(2**60, int(rng.integers(0, 1 + n // 8))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= 80 * (len(x) + len(y) - both):
            apart = int(jaccard._apart(np.stack([jaccard.sketch(x), jaccard.sketch(y)]).astype(np.int16), 0, np.array([1]))[0])
            assert jaccard.may_link(apart, len(x), len(y))


def test_pivots_in_a_list_match_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(40):
        sets = []
        for _ in range(int(rng.integers(1, 6))):
            base = rng.choice(2**60, int(rng.integers(5, 120))).astype(np.uint64)
            for _ in range(int(rng.integers(1, 12))):
                sets.append(np.unique(base[rng.random(len(base)) > rng.random() * 0.3]))
        sets = [x for x in sets if len(x)]
        bits, sizes = np.stack([jaccard.sketch(x) for x in sets]).astype(np.int16), np.array([len(x) for x in sets])
        root = np.arange(len(sets))
        for a in range(len(sets)):
            for b in range(a):
                if jaccard.may_link(int(jaccard._apart(bits, a, np.array([b]))[0]), sizes[a], sizes[b]):
                    i, j = sorted((root[a], root[b]))
                    root[root == j] = i
        assert (jaccard.near_in_list(bits, sizes) == root).all()


@pytest.mark.parametrize("limits", [(1, 3)])
def test_candidate_limits_do_not_change_the_result(make_docs, rows, limits, monkeypatch):
    plain = jaccard.candidates
    monkeypatch.setattr(jaccard, "candidates", lambda t, r: plain(t, r, *limits))
    got = jaccard.jaccard_components(make_docs(rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 120)] + [(500, i) for i in range(501, 600)] + [(700, 700)]
    random.Random(1).shuffle(path)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(121)) and all(got[i] == 500 for i in range(500, 600)) and got[700] == 700
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_stage_keeps_one_of_each_group(make_docs, rows):
    docs = make_docs(rows + [(9000, None), (9001, "")])
    out = jaccard.stage(docs.sparkSession, docs, "")
    assert out.columns == docs.columns
    want = brute(rows)
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(want.values())) + [9000, 9001]


def test_points_of_a_shared_shingle_are_counted_without_a_window(make_docs, rows, monkeypatch):
    plans, plain = {}, jaccard.materialise

    def seen(df, name):
        plans.setdefault(name, df._jdf.queryExecution().analyzed().toString())
        return plain(df, name)

    monkeypatch.setattr(jaccard, "materialise", seen)
    got = jaccard.jaccard_components(make_docs(rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)
    assert "lists" in plans and not [n for n, p in plans.items() if "Window" in p]


def test_an_id_with_two_texts_links_them(make_docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(3, a), (5, a), (4, b), (5, b), (6, c), (7, c), (8, c), (8, a + " tail")]
    want = brute(rows)
    got = jaccard.jaccard_components(make_docs(rows)).collect()
    assert len(got) == len(rows) and want[4] == want[5] == want[6] == 3
    assert all(r.component_id == want[r.doc_id] for r in got)


def test_points_of_a_large_region_are_not_replicated(make_docs, monkeypatch):
    # Every text is linked to the last one only, and at one distance from all others: no pivot parts them.
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w if j != i % 50 + 5 else f"e{i}" for j, w in enumerate(words))) for i in range(45)]
    rows.append((45, " ".join(words)))
    held, plain = [], jaccard.materialise

    def seen(df, name):
        out = plain(df, name)
        if "data" in out.columns:
            held.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "materialise", seen)
    got = jaccard.jaccard_components(make_docs(rows), region_points=12, levels=3).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)
    assert len(held) > 1 and max(held) <= len(rows)


def test_long_lists_are_cut_by_size(make_docs):
    # Texts of 20 and of 40 words, of the same common ones: unlike by size alone.
    text = {n: " ".join(f"s{i}" for i in range(n)) for n in (20, 40)}
    rows = [(n * 100 + i, f"{text[n]} x{n}y{i}") for n in text for i in range(6)]
    docs = jaccard._text(make_docs(rows), "doc_id", "text")
    described = jaccard.described(docs, np.zeros(0, np.uint64)).where("n > 0").cache()
    tokens = described.selectExpr("explode(sign) s", "id u")
    near = jaccard.candidates(tokens, described, 1, 6)
    roots = {r.node: r.root for r in graph.components(near).collect()}
    assert {roots[2000 + i] for i in range(6)} == {2000} and {roots[4000 + i] for i in range(6)} == {4000}


def test_pivot_links_match_intersections():
    rng = np.random.default_rng(3)
    base = rng.choice(2**60, 40).astype(np.uint64)
    sets = [np.unique(base[rng.random(40) > rng.random() * 0.3]) for _ in range(30)] + \
        [np.unique(rng.choice(2**60, 9).astype(np.uint64)) for _ in range(5)]
    pivots = [*sets[:9], np.unique(rng.choice(2**60, 9).astype(np.uint64))]
    for cells in (1, 500, 1 << 24):
        edges = [(i, j) for part, of_points, of_pivots in jaccard.pivot_links(sets, pivots, cells)
                 for i, j in [*((i, int(j)) for i, j in enumerate(of_points) if j >= 0),
                              *((100 + int(i), int(j)) for i, j in zip(part, of_pivots))]]
        parts = [int(part[-1]) for part, *_ in jaccard.pivot_links(sets, pivots, cells)]
        assert parts[-1] == len(pivots) - 1 and (len(parts) == 1) == (cells > 500)
        root = {**{i: {i} for i in range(len(sets))}, **{100 + j: {100 + j} for j in range(len(pivots))}}
        want = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(pivots)
                if 100 * jaccard.common(a, b) >= 80 * (len(a) + len(b) - jaccard.common(a, b))]
        assert merged(root, [(i, 100 + j) for i, j in edges]) == merged(root, [(i, 100 + j) for i, j in want])


def merged(sets, pairs):
    of = {k: set(v) for k, v in sets.items()}
    for a, b in pairs:
        both = of[a] | of[b]
        for x in both:
            of[x] = both
    return {k: min(v) for k, v in of.items()}
