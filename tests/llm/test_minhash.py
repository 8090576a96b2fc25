import collections

import numpy as np
import pytest

from flowml.llm import common, minhash as mh


def plain_set(text):
    words = [w.lower() for w in (text or "").replace("\x0b", " ").split()] if text else []
    if not words:
        return frozenset()
    n = min(4, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute(rows):
    """Sorted (id, n, component, kept) by comparing all sets that share a shingle."""
    sets = [plain_set(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    first, holders = {}, collections.defaultdict(set)
    for (i, _), s in zip(rows, sets):
        if i is None or not s:
            continue
        if s in first:
            join(i, first[s])
            continue
        first[s] = i
        for x in s:
            holders[x].add(s)
    done = set()
    for group in holders.values():
        for a in group:
            for b in group:
                if a is not b and (id(a), id(b)) not in done:
                    done.add((id(a), id(b)))
                    shared = len(a & b)
                    if 100 * shared >= 80 * (len(a) + len(b) - shared):
                        join(first[a], first[b])
    return sorted(((i, len(s), None if i is None else root(i) if s or any(
        sets[k] for k, (j, _) in enumerate(rows) if j == i) else i, i is not None and root(i) == i)
        for (i, _), s in zip(rows, sets)), key=repr)


def checked(docs, **sizes):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in mh.near_duplicates(docs, **sizes).collect()),
                 key=repr)
    assert got == brute(rows)


def test_odd_rows(odd_docs, make_docs):
    checked(odd_docs)
    checked(make_docs([(3, "a b c d e f"), (5, "a b c d e f"), (4, "p q r s t u"), (5, "p q r s t u"), (9, "Q"), (8, "q")]))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    checked(docs)
    assert mh.near_duplicates(docs.limit(0)).count() == 0


def mutated(rng, words, share):
    out = list(words)
    for i in rng.choice(len(out), max(1, int(share * len(out))), replace=False):
        out[i] = f"w{rng.integers(10 ** 6)}"
    return " ".join(out)


def test_families_around_a_text_and_chains(make_docs):
    """Copies that are near their source but not near each other, chains of edits, and a passage
    that many unrelated texts share; lists so small that every path runs."""
    rng = np.random.default_rng(3)
    rows = []
    for f in range(4):
        source = [f"f{f}x{i}" for i in range(240)]
        rows.append((f * 1000 + 70, " ".join(source)))
        rows += [(f * 1000 + i, mutated(rng, source, 0.025)) for i in range(60)]
    chain = [f"c{i}" for i in range(200)]
    for i in range(40):
        rows.append((9000 + i, " ".join(chain)))
        chain[(5 * i) % 200] = f"n{i}"
    passage = " ".join(f"p{i}" for i in range(150))
    rows += [(10_000 + i, passage + " " + " ".join(f"u{i}x{j}" for j in range(150))) for i in range(80)]
    rows += [(20_000 + i, "same text in many rows of the table " * 5) for i in range(50)]
    docs = make_docs(rows)
    checked(docs)
    checked(docs, size=8)


def test_minima_collide_as_often_as_sets_are_alike():
    rng = np.random.default_rng(0)
    a, b = mh._hash_family()
    near = []
    for _ in range(60):
        x = np.unique(rng.integers(0, 2 ** 63, 540).astype(np.uint64))
        near.append((mh.minima(x[:500], a, b) == mh.minima(x[40:], a, b)).mean())
    assert abs(np.mean(near) - 460 / 540) < 0.01


def test_agreement_and_centre():
    rng = np.random.default_rng(1)
    source = rng.integers(0, 256, mh.PLACES).astype(np.uint8)
    signs = np.stack([source] * 40)
    for i in range(1, 40):
        signs[i, rng.choice(mh.PLACES, 60, replace=False)] = rng.integers(0, 256, 60)
    assert mh.centre(signs[::-1]) == 39
    assert (mh.agreement(signs, signs) == (signs[:, None] == signs[None]).sum(-1)).all()


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_groups_of_a_sorted_partition(rows):
    import pyarrow as pa
    keys = np.sort(np.random.default_rng(rows).integers(0, max(1, rows // 3), rows))
    whole = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.arange(rows))], names=["part", "x"])
    batches = [whole.slice(i, 5) for i in range(0, rows, 5)]
    got = list(common.sorted_groups(batches, "part"))
    assert [g.column("part")[0].as_py() for g in got] == sorted(set(keys.tolist()))
    assert sum(g.num_rows for g in common.gathered(got, 10)) == rows


def test_points_and_tokens_alone_in_their_buckets_are_not_joined(make_docs, monkeypatch):
    """Before, every join of a bucket's points shuffled the signatures and tokens of all documents."""
    rng, seen = np.random.default_rng(6), {"signs": [], "tokens": []}
    rows = [(i, " ".join(f"d{i}x{j}" for j in range(60))) for i in range(300)]
    source = [f"s{j}" for j in range(200)]
    rows += [(1000 + i, mutated(rng, source, 0.01)) for i in range(8)]
    centres, attach = mh.part_centres, mh.attach_by_key

    def watched_centres(lists, signs, *rest):
        seen["signs"].append(signs.count())
        return centres(lists, signs, *rest)

    def watched_attach(left, facts, key, count):
        if left.columns == ["s", "u"]:
            seen["tokens"].append(left.count())
        return attach(left, facts, key, count)

    monkeypatch.setattr(mh, "part_centres", watched_centres)
    monkeypatch.setattr(mh, "attach_by_key", watched_attach)
    checked(make_docs(rows))
    assert seen["signs"] and max(seen["signs"]) < 60
    assert seen["tokens"] and seen["tokens"][0] < 308 * mh.BANDS / 10


@pytest.mark.parametrize("most", [1 << 28, 1 << 10])
def test_bits_pass_all_given_ids_and_few_others(spark, most):
    ids = spark.range(-500, 500).selectExpr("id * 7919 as u")
    bits = common.IdBits(ids, "u", most=most)
    table = spark.range(-20_000, 20_000).selectExpr("if(id = 3, null, id * 7919) as u", "binary(string(id)) as data")
    got = bits.rows(table, "u")
    assert got.schema == table.schema
    values = [r.u for r in got.collect()]
    assert set(range(-500 * 7919, 500 * 7919, 7919)) - {3 * 7919} <= set(values) and len(values) == len(set(values))
    assert most == 1 << 10 or len(values) < 1000 + 0.016 * 40_000
