import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowml.llm import packing


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.public_vocabulary()[0])


TEXTS = [" a  b\n c\n\nd \n e\t f \xa0g\x0b\x0ch  ", "", "   ", "\n", "don't 12ab 'll  x's They're", "a b  c",
         "\x1c a", "<|endoftext|>x", " \xa0 x", "\U0001f600\U0001f600 naïve Ünïcödé ß中文 текст", "##a!!b%%c ...d",
         "x́yz é́", "½²x 3½", "word.\nNext LINE\r\n\r\n tab\t"]


@pytest.mark.parametrize("text", TEXTS)
def test_chunked_encoding_equals_the_library(library, text):
    got = np.frombuffer(packing.encoder(*packing.public_vocabulary()).encode(text), "<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Zé\n\t'.s!1\xa0 中ñ#"), max_size=40))
def test_chunked_encoding_property(text):
    from tokenizers import Tokenizer
    lib = test_chunked_encoding_property.__dict__.setdefault("lib", Tokenizer.from_file(packing.public_vocabulary()[0]))
    got = np.frombuffer(packing.encoder(*packing.public_vocabulary()).encode(text), "<u4").tolist()
    assert got == lib.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_bins_hold_everything_once(lengths):
    bins = packing.best_two_fit(lengths, 40)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= 40 for b in bins)
    # No two bins could be one: at most one bin is at most half full.
    assert sum(sum(lengths[i] for i in b) <= 20 for b in bins) <= 1


def test_two_smaller_pieces_replace_the_smallest():
    # Greedy takes 6 + 3 (one place left); 6 + (2 + 2) fills the bin.
    assert [sorted([6, 3, 2, 2][i] for i in b) for b in packing.best_two_fit([6, 3, 2, 2], 10)] == [[2, 2, 6], [3]]


def test_pieces_and_sequences(spark, library, odd_docs, make_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = packing.pack_documents(odd_docs).collect()
    want = {}
    for i, t in rows:
        ids = np.asarray(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.setdefault(i, []).append(ids)
    by_row = {}
    for r in got:
        by_row.setdefault((r.id, r.row), []).append(r)
    assert len(by_row) == len(rows)
    for (i, _), parts in by_row.items():
        parts.sort(key=lambda r: r.piece)
        ids = next(x for x in want[i] if len(x) == sum(p.length for p in parts))
        assert [p.piece for p in parts] == list(range(len(parts)))
        for n, p in enumerate(parts):
            assert p.length == 2048 or n == 0
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(p, p[1:])) and sum(x for _, x in p) <= 2048
    assert packing.pack_documents(make_docs([])).collect() == []


def test_sequences_are_near_the_bound(spark):
    got = packing.op8_best_two_fit(spark, "/root/testdata/sf0.01").toPandas()
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 2048) + 2
