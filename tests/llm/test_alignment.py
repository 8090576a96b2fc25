import collections
import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from flowml.llm import alignment as al

ZERO = (0, 0, 0, 0, 0, 0, "")


def plain_tokens(tools, text):
    """Tokens of the whole text with their ends, or None."""
    if not text:
        return None
    a = tools.a.encode(" " + text, add_special_tokens=False).ids
    b = tools.b.encode(text)
    spelt_a, spelt_b = [tools.bytes_a[i] for i in a], [tools.bytes_b[i] for i in b]
    if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
        return None
    return a, np.cumsum([len(x) for x in spelt_a]).tolist(), b, np.cumsum([len(x) for x in spelt_b]).tolist()


def brute(tools, texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, hash) of every text."""
    found, count = [], collections.Counter()
    for text in texts:
        t = plain_tokens(tools, text)
        if t is None:
            found.append(None)
            continue
        a, ae, b, be = t
        groups, links, i, j = [], [], 0, 0
        for e in sorted(set(ae) & set(be)):
            k, m = ae.index(e, i) + 1, be.index(e, j) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            links.append((a[k - 1], b[m - 1]))
            i, j = k, m
        count.update(links)
        found.append((len(a), len(b), groups, links))
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append(ZERO)
            continue
        n_a, n_b, groups, links = f
        out.append((n_a, n_b, len(groups), len(links), sum(count[x] == top[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def checked(docs, **sizes):
    rows = docs.select("doc_id", "text").collect()
    tools = al.aligner(*al.public_files())
    want = [(r.doc_id, *x) for r, x in zip(rows, brute(tools, [r.text for r in rows]))]
    got, _ = al.align_documents(docs, **sizes)
    got = [(r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.hash) for r in got.collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_equals_whole_texts(spark, odd_docs, make_docs):
    checked(odd_docs)
    odd = make_docs([
        (1, "<|endoftext|> <s> </s> <0x41> plain"), (2, "▁ read as a space"), (3, " leading  and   runs "),
        (4, "café été naïve  x y　z"), (5, "日本語の文" * 40),
        (6, "tab\tnew\nline\r\n\x00\x1c\x85 end"), (7, "\U0001f600 \U0001f468‍\U0001f469 ok"), (8, "don't it's 12 345 a1b2"),
        (9, "word " * 300), (9, "word " * 300), (10, "x" * 900), (11, "▁" + "far away " * 200), (None, "a b"), (12, " ")])
    checked(odd)
    checked(odd, chunk=64, block_bytes=200, fan_in=2)     # every text is composed from many ranges
    checked(odd, chunk=17, fan_in=3)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    checked(docs, chunk=2_000, block_bytes=50_000)
    assert al.align_documents(docs.limit(0))[0].count() == 0


def test_pairs_are_the_corpus_counts(spark, make_docs):
    docs = make_docs([(i, "the cat sat on the mat") for i in range(20)] + [(30, "the dog")])
    found, pairs = al.align_documents(docs, block_bytes=60)
    the = [r for r in pairs.collect() if r.total == 41]
    assert len(the) == 1 and the[0].best
    assert sum(r.total for r in pairs.collect()) == sum(r.n_links for r in found.collect())


TEXT = st.text(st.sampled_from("abé あ'1.<|>▁\n\t \U0001f600"), min_size=1, max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["word", "it's", "été", "12", "a.b", "あい", "", " ", "\n", "x"]), max_size=20), TEXT)
def test_words_encode_alone_as_in_the_text(words, other):
    tools = al.aligner(*al.public_files())
    for text in (" ".join(words), other):
        if not text:
            continue
        a, b = [], []
        for wa, wb in zip(*tools.ids(al._SPLIT.split(b" " + text.encode()))):
            a, b = a + wa, b + wb
        assert a == tools.a.encode(" " + text, add_special_tokens=False).ids and b == tools.b.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10 ** 6), st.lists(st.integers(0, 60), max_size=6))
def test_fragments_are_a_monoid(seed, places):
    """Any cutting into ranges and any bracketing gives the fragment of the whole."""
    rng = np.random.default_rng(seed)
    ends = [sorted(set(rng.integers(1, 60, 25).tolist()) | {60}) for _ in range(2)]
    ids = [rng.integers(0, 9, len(e)).tolist() for e in ends]
    whole = al.align(ids[0], ends[0], ids[1], ends[1])[0]
    bounds = [0, *sorted(places), 60]
    parts, links = [], []
    for low, high in zip(bounds, bounds[1:]):
        got = [al._within(i, e, low, high) for i, e in zip(ids, ends)]
        f, found = al.align(*got[0], *got[1])
        parts.append(f)
        links += found
    assert al.compose(parts) == whole and links == al.align(ids[0], ends[0], ids[1], ends[1])[1]
    right = al.Fragment()
    for f in reversed(parts):
        right = f + right
    assert right == whole
    while len(parts) > 1:
        at = int(rng.integers(0, len(parts) - 1))
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    assert parts[0] + al.Fragment() == al.Fragment() + parts[0] == whole


def test_ranges_cover_and_read_a_word_twice_at_most():
    for text in ("word " * 400, "x" * 5000, "a " * 50 + "y" * 3000 + " b" * 50, "あ" * 1000 + " ab cd"):
        data = b" " + text.encode()
        got = al.byte_ranges(data, 100)
        assert [g[0] for g in got] == [0, *[g[1] for g in got[:-1]]] and got[-1][1] == len(data)
        assert all(at <= low < high <= to for low, high, at, to in got)
        assert sum(to - at for _, _, at, to in got) <= 3 * len(data)


def test_packed_numbers():
    for numbers in ([], [5], [0, 0, 7, 7], [70_000, 3, 70_000], list(range(1000))):
        assert al.unpacked(al.packed(np.array(numbers, np.int64))).tolist() == sorted(numbers)
