"""Alignment of two tokenizers over the same bytes.

Every document is encoded by tokenizer A (byte-level BPE) and tokenizer B (sentencepiece with
byte fallback). Where a token of A and a token of B end at the same byte, the text is cut; what
lies between two cuts is a *group* of A ids and B ids, and the two tokens that end at a cut are
a *link*. Links are counted over the corpus by their pair of ids.

**Fragments.** The alignment of a byte range is a fragment: an open prefix (the ids up to and
with the first cut, whose group may have begun before the range), closed groups, and an open
suffix (the ids after the last cut). A token belongs to the range in which it ends, so the
fragments of adjacent ranges compose: the suffix of the left and the prefix of the right close
one group. Composition is associative and the empty fragment is its identity. A long document
is cut into byte ranges that are aligned in separate tasks, wherever in a word or token they
begin, and its fragments are composed level by level, ``FAN_IN`` at a time.

**Words.** A space between two visible characters starts a new token in both vocabularies
(both pre-split there or hold no piece with an inner space), so the text between two such
spaces, a *word*, encodes the same alone as in its document. Words are closed fragments and
are kept in a bounded cache; a document without such spaces is one word. A range reads its
first and last words whole, as far as they reach into its neighbours.

**Counts.** A block of documents sends its distinct pairs with their counts into one exchange and
gets back the corpus count of each, and whether it is the highest of its B id; a pair that every block
holds is treated as a hot key. Documents name their words by numbers within the block, so a
document's sums follow from the block's. Nothing grows on the driver.

Defined results: null and empty texts, and texts whose tokens do not spell out space+text (B
reads U+2581 as a space), have no tokens: zeros and an empty hash; rows that repeat an id are aligned each;
an empty table gives no rows; other columns are ignored; strings of special tokens are plain text.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import hashlib
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowml.llm.common import attach_by_key, table
from flowml.session import drop_scratch, materialise

#: Documents longer than this are aligned in byte ranges of about this length.
CHUNK_BYTES = 65_536
#: Bytes of text of a block.
BLOCK_BYTES = 2 << 20
#: Fragments composed at once.
FAN_IN = 8
#: Words kept by a Python worker; they have at most so many bytes and occur so often in a block.
CACHE_WORDS, CACHE_LENGTH, CACHE_SEEN = 60_000, 64, 3
#: Words encoded together.
SLICE_WORDS = 10_000
#: A pair of ids is a << ID_BITS | b.
ID_BITS = 24

# A space between visible characters: ASCII, or a Latin letter of two UTF-8 bytes.
_SEEN = rb"(?:(?<=[!-~])|(?<=\xc3[\x80-\xbf]))"
_SPLIT = re.compile(_SEEN + rb"(?= [!-~\xc3])")
# Characters whose classes (letter, number, space) no two libraries see differently.
_PLAIN = re.compile("[\t\n -~\u00a1-\u024f\u0391-\u03a1\u03a3-\u03c9\u0410-\u044f\u2010-\u2027\u2030-\u205e"
                    "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]+").fullmatch


@dataclass(frozen=True)
class Fragment:
    """Alignment of a byte range. ``head`` and ``tail`` are ids as ``a,a|b``; ``body`` the closed
    groups between the first cut and the last, ``groups`` their number. Without a cut all ids
    are in ``head``."""

    cuts: bool = False
    head: str = "|"
    body: str = ""
    groups: int = 0
    tail: str = "|"

    def __add__(self, other: Fragment) -> Fragment:
        if not self.cuts:
            return Fragment(other.cuts, _joined(self.head, other.head), other.body, other.groups, other.tail)
        if not other.cuts:
            return Fragment(True, self.head, self.body, self.groups, _joined(self.tail, other.head))
        middle = _joined(self.tail, other.head)
        return Fragment(True, self.head, ";".join(x for x in (self.body, middle, other.body) if x),
                        self.groups + 1 + other.groups, other.tail)

    def whole(self) -> tuple[str, int]:
        """(groups as text, their number) of a document."""
        return (f"{self.head};{self.body}" if self.body else self.head), self.groups + 1


def _joined(left: str, right: str) -> str:
    (a, b), (c, d) = left.split("|"), right.split("|")
    return f"{a},{c}".strip(",") + "|" + f"{b},{d}".strip(",")


def closed(text: str, groups: int) -> Fragment:
    """The fragment of closed groups written as text."""
    head, _, body = text.partition(";")
    return Fragment(True, head, body, groups - 1)


def compose(fragments: Iterable[Fragment]) -> Fragment:
    """The fragment of adjacent ranges, in order."""
    total = Fragment()
    for f in fragments:
        total = total + f
    return total


def _text(ids_a: list[int], ids_b: list[int]) -> str:
    return ",".join(map(str, ids_a)) + "|" + ",".join(map(str, ids_b))


def align(a: list[int], a_end: list[int], b: list[int], b_end: list[int]) -> tuple[Fragment, list[int]]:
    """(fragment, links) of tokens with the bytes at which they end."""
    parts, links, i, j, from_a, from_b = [], [], 0, 0, 0, 0
    while i < len(a) and j < len(b):
        if a_end[i] < b_end[j]:
            i += 1
        elif a_end[i] > b_end[j]:
            j += 1
        else:
            links.append(a[i] << ID_BITS | b[j])
            i, j = i + 1, j + 1
            parts.append(_text(a[from_a:i], b[from_b:j]))
            from_a, from_b = i, j
    rest = _text(a[from_a:], b[from_b:])
    if not parts:
        return Fragment(False, rest), links
    return Fragment(True, parts[0], ";".join(parts[1:]), len(parts) - 1, rest), links


class Word(NamedTuple):
    """A whole word: token counts, its groups as text, and its links, one for each group."""

    n_a: int
    n_b: int
    text: str
    links: tuple[int, ...]


@contextlib.contextmanager
def _no_cycles():
    """Many small objects without reference cycles are made: the collector need not look for any."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


@dataclass
class Aligner:
    """Both tokenizers and the cache of words of one Python worker."""

    file_a: str
    file_b: str
    ranks: str
    cache: dict[bytes, Word | None] = field(default_factory=dict)

    def __post_init__(self):
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_file=self.file_b)
        self.fast, self.bytes_a = _ranked(self.ranks)
        self.bytes_b = [_piece(self.b, i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.names = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))

    @functools.cached_property
    def a(self):
        """A's own file, loaded when the first text needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.file_a)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def ids(self, words: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of words under A and B, each word encoded on its own."""
        if not words:
            return [], []
        texts = [w.decode("utf-8", "replace") for w in words]
        # The ranks hold the same vocabulary for a faster library.
        found_a = [self.fast(t) if _PLAIN(t) else None for t in texts]
        others = [i for i, f in enumerate(found_a) if f is None]
        if others:
            for i, e in zip(others, self.a.encode_batch([texts[i] for i in others], add_special_tokens=False)):
                found_a[i] = e.ids
        # Every word starts with the space that B adds by itself.
        return found_a, self.b.encode([t[1:] for t in texts], num_threads=1)

    def spelt(self, word: bytes, a: list[int], b: list[int]) -> bool:
        """Do the tokens of both spell out the word?"""
        return (b"".join(map(self.bytes_a.__getitem__, a)) == word
                and b"".join(map(self.bytes_b.__getitem__, b)) == word)

    def aligned(self, words: list[bytes]) -> list[Word | None]:
        """The records of whole words (at the end of a word both end, so no group stays open).

        The words are put one after the other, so the cuts of all are the bytes at which both
        lists of ends agree.
        """
        a, b = self.ids(words)
        size = np.array(list(map(len, words)), np.int64)
        if not (self._spell(words, size, a, self.bytes_a) and self._spell(words, size, b, self.bytes_b)):
            good = [i for i, w in enumerate(words) if self.spelt(w, a[i], b[i])]
            out: list[Word | None] = [None] * len(words)
            for i, r in zip(good, self._records([a[i] for i in good], [b[i] for i in good])):
                out[i] = r
            return out
        return self._records(a, b)

    @staticmethod
    def _spell(words: list[bytes], size: np.ndarray, ids: list[list[int]], entries: list[bytes]) -> bool:
        """Do the tokens spell out every word? Equal lengths word by word, and equal bytes in all."""
        found = [b"".join(map(entries.__getitem__, i)) for i in ids]
        return bool((np.array(list(map(len, found)), np.int64) == size).all()) and b"".join(found) == b"".join(words)

    def _records(self, a: list[list[int]], b: list[list[int]]) -> list[Word]:
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        end_a, end_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        _, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        links = (flat_a[at_a] << ID_BITS | flat_b[at_b]).tolist()
        name_a, name_b = (list(map(self.names.__getitem__, f.tolist())) for f in (flat_a, flat_b))
        to_a, to_b = (at_a + 1).tolist(), (at_b + 1).tolist()
        groups = [f"{name_a[i]}|{name_b[m]}" if j - i == n - m == 1 else ",".join(name_a[i:j]) + "|" + ",".join(name_b[m:n])
                  for i, j, m, n in zip([0, *to_a], to_a, [0, *to_b], to_b)]
        # The last cut of a word is the end of its last token.
        to = (np.searchsorted(at_a, np.cumsum(n_a) - 1) + 1).tolist()
        return [Word(x, y, ";".join(groups[i:j]), tuple(links[i:j]))
                for x, y, i, j in zip(n_a.tolist(), n_b.tolist(), [0, *to], to)]

    def words(self, found: list[bytes], times: np.ndarray) -> list[Word | None]:
        """The records of distinct words; None for one whose tokens do not spell it out. Short
        words that occur several times are kept for later calls."""
        out = list(map(self.cache.get, found, [0] * len(found)))
        new = [i for i, r in enumerate(out) if r == 0]
        fresh = [found[i] for i in new]
        with _no_cycles():
            for at in range(0, len(new), SLICE_WORDS):
                for i, r in zip(new[at:at + SLICE_WORDS], self.aligned(fresh[at:at + SLICE_WORDS])):
                    out[i] = r
        keep = [i for i in new if times[i] >= CACHE_SEEN and len(found[i]) <= CACHE_LENGTH][:CACHE_WORDS]
        if len(self.cache) + len(keep) > CACHE_WORDS:
            self.cache.clear()
        self.cache.update((found[i], out[i]) for i in keep)
        return out

    def part(self, word: bytes, low: int, high: int) -> tuple[int, int, Fragment, tuple[int, ...]] | None:
        """(n_a, n_b, fragment, links) of the tokens of a word that end in (low, high], counted
        from the word's first byte."""
        (a,), (b,) = self.ids([word])
        if not self.spelt(word, a, b):
            return None
        a, a_end = _within(a, np.cumsum(self.size_a[a]).tolist(), low, high)
        b, b_end = _within(b, np.cumsum(self.size_b[b]).tolist(), low, high)
        fragment, links = align(a, a_end, b, b_end)
        return len(a), len(b), fragment, tuple(links)


def _within(ids: list[int], ends: list[int], low: int, high: int) -> tuple[list[int], list[int]]:
    keep = [i for i, e in enumerate(ends) if low < e <= high]
    return [ids[i] for i in keep], [ends[i] for i in keep]


def _piece(processor, i: int) -> bytes:
    piece = processor.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode()


def _ranked(file: str):
    """(encoding function, bytes of every id) of a file of merge ranks."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(file, "rb") as lines:
        ranks = {base64.b64decode(x): int(i) for x, i in map(bytes.split, lines)}
    entries = [b""] * (max(ranks.values()) + 1)
    for entry, i in ranks.items():
        entries[i] = entry
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary, entries


_aligners: dict[tuple, Aligner] = {}


def aligner(*files: str) -> Aligner:
    """One aligner per Python worker and pair of files."""
    if files not in _aligners:
        _aligners[files] = Aligner(*files)
    return _aligners[files]


def public_files() -> tuple[str, str, str]:
    """Paths of the public vocabularies A and B, and of A's merge ranks."""
    import public_tokenizers

    return tuple(str(public_tokenizers.path(n)) for n in (
        "byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))


def byte_ranges(data: bytes, chunk: int) -> list[tuple[int, int, int, int]]:
    """(low, high, from, to): ranges of about ``chunk`` bytes, and the whole words they touch.

    A boundary is left out where no word has begun since the last one, so that a word is read
    by two ranges at most.
    """
    starts = np.array([0] + [m.start() for m in _SPLIT.finditer(data)] + [len(data)])
    bounds = [0]
    for at in range(chunk, len(data), chunk):
        begun = starts[np.searchsorted(starts, at, "right") - 1]
        if begun > bounds[-1] or bounds[-1] == 0:
            bounds.append(at)
    out = []
    for low, high in zip(bounds, [*bounds[1:], len(data)]):
        out.append((low, high, int(starts[np.searchsorted(starts, low, "right") - 1]),
                    int(starts[np.searchsorted(starts, high, "left")])))
    return out


#: kind 0: documents without tokens, 1: whole documents, 2: ranges of long documents, 3: blocks.
ALIGNED = ("kind int, block long, row long, id long, k int, ok boolean, n_a long, n_b long, n_links long, "
           "groups long, hash string, cuts boolean, head string, body string, tail string, words binary, "
           "pairs array<long>, counts array<long>, starts binary, places binary")
_ARROW = pa.schema([pa.field(n, {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(),
                                 "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}[t])
                    for n, t in (f.split(" ") for f in ALIGNED.split(", "))])


def packed(numbers: np.ndarray) -> bytes:
    """Numbers (their order does not matter) as differences of two bytes, or four where one is large;
    the first byte says which."""
    gaps = np.diff(np.sort(numbers), prepend=0)
    width = 2 if not len(gaps) or gaps.max() < 1 << 16 else 4
    return bytes([width]) + gaps.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, f"<u{data[0]}", offset=1), dtype=np.int64)


class Block:
    """Documents or ranges whose words are numbered together."""

    def __init__(self, number: int, tools: Aligner, lists: list[list[bytes]]):
        place: dict[bytes, int] = {}
        self.number, self.rows = number, []
        self.used = [np.array([place.setdefault(w, len(place)) for w in words], np.int64) for words in lists]
        self.times = np.zeros(len(place), np.int64)
        for used in self.used:
            self.times += np.bincount(used, minlength=len(place))
        self.records = tools.words(list(place), self.times)
        known = [r or Word(0, 0, "", ()) for r in self.records]
        self.ok = np.array([r is not None for r in self.records], bool)
        self.n_a, self.n_b = (np.array([r[i] for r in known], np.int64) for i in (0, 1))
        self.text = [r.text for r in known]
        self.links = [r.links for r in known]
        self.n_links = np.array(list(map(len, self.links)), np.int64)

    def spelt(self, i: int) -> bool:
        return bool(self.ok[self.used[i]].all())

    def left_out(self, i: int) -> None:
        """List ``i`` does not count."""
        self.times -= np.bincount(self.used[i], minlength=len(self.times))

    def counted(self, i: int) -> dict:
        used = self.used[i]
        return {"n_a": int(self.n_a[used].sum()), "n_b": int(self.n_b[used].sum()),
                "n_links": int(self.n_links[used].sum()), "words": packed(used)}

    def joined(self, used: np.ndarray) -> str:
        return ";".join(map(self.text.__getitem__, used.tolist()))

    def finished(self, row: int | None = None, parts: Sequence[tuple[int, ...]] = ()) -> pa.RecordBatch:
        """The rows and the block's own row: distinct pairs with counts, and each word's pairs.
        ``parts``: links of parts of words, numbered after the words."""
        links = [*self.links, *parts]
        times = np.concatenate([self.times, np.ones(len(parts), np.int64)])
        if times.any():
            sizes = np.array(list(map(len, links)), np.int64)
            flat = np.fromiter(chain.from_iterable(links), np.int64, int(sizes.sum()))
            pairs, places = np.unique(flat, return_inverse=True)
            counts = np.zeros(len(pairs), np.int64)
            np.add.at(counts, places, np.repeat(times, sizes))
            starts = np.concatenate([[0], np.cumsum(sizes)])
            self.rows.append({"kind": 3, "block": self.number, "row": row, "pairs": pairs, "counts": counts,
                              "starts": starts.astype("<i8").tobytes(), "places": places.astype("<i4").tobytes()})
        return pa.RecordBatch.from_pylist(self.rows, schema=_ARROW)


def _fresh_blocks() -> Iterator[int]:
    """Numbers that no other task of the job gives out."""
    task, n = TaskContext.get().partitionId(), 0
    while True:
        yield task << 32 | n
        n += 1


def _whole_documents(docs: DataFrame, files: tuple[str, ...], block_bytes: int) -> DataFrame:
    """Aligns (row, id, data) documents that are not cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, fresh = aligner(*files), _fresh_blocks()

        def block(items: list[tuple]) -> pa.RecordBatch:
            made = Block(next(fresh), tools, [_SPLIT.split(b" " + data) if data else [] for _, _, data in items])
            for i, (row, doc, data) in enumerate(items):
                if not data or not made.spelt(i):
                    made.left_out(i)
                    made.rows.append({"kind": 0, "row": row, "id": doc})
                    continue
                counted = made.counted(i)
                made.rows.append({"kind": 1, "block": made.number, "row": row, "id": doc, **counted,
                                  "groups": counted["n_links"],
                                  "hash": hashlib.sha256(made.joined(made.used[i]).encode()).hexdigest()})
            return made.finished()

        for batch in batches:
            items, size = [], 0
            for row, doc, data in zip(*(batch.column(i) for i in range(3))):
                items.append((row.as_py(), doc.as_py(), data.as_py()))
                size += len(items[-1][2] or b"")
                if size >= block_bytes:
                    yield block(items)
                    items, size = [], 0
            if items:
                yield block(items)

    return docs.select("row", "id", "data").mapInArrow(run, ALIGNED)


def _ranges(docs: DataFrame, chunk: int) -> DataFrame:
    """(row, id, k, low, high, base, data) of the byte ranges of long documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "id", "k", "low", "high", "base", "data"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for row, doc, data in zip(*(batch.column(i) for i in range(3))):
                data = b" " + data.as_py()
                out = [(row.as_py(), doc.as_py(), k, low, high, at, data[at:to])
                       for k, (low, high, at, to) in enumerate(byte_ranges(data, chunk))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return docs.select("row", "id", "data").mapInArrow(
        run, "row long, id long, k int, low long, high long, base long, data binary")


def _range_fragments(ranges: DataFrame, files: tuple[str, ...]) -> DataFrame:
    """Aligns byte ranges; every range is a block of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, fresh = aligner(*files), _fresh_blocks()
        for batch in batches:
            for row, doc, k, low, high, base, data in zip(*(batch.column(i) for i in range(7))):
                low, high, base, data = low.as_py(), high.as_py(), base.as_py(), data.as_py()
                words = _SPLIT.split(data)
                ends = base + np.cumsum([len(w) for w in words])
                begins = ends - [len(w) for w in words]
                inner = (begins >= low) & (ends <= high)
                # Block numbers below zero are those of ranges.
                made = Block(-1 - next(fresh), tools, [[w for w, i in zip(words, inner) if i]])
                # At most one word at either end belongs to the range in part.
                parts = [tools.part(words[i], low - int(begins[i]), high - int(begins[i]))
                         for i in np.flatnonzero(~inner & (ends > low) & (begins < high))]
                ok = made.spelt(0) and None not in parts
                entry = {"kind": 2, "block": made.number, "row": row.as_py(), "id": doc.as_py(), "k": k.as_py(), "ok": ok}
                if not ok:
                    entry |= {"groups": 0, "cuts": False, "head": "|", "body": "", "tail": "|", "words": packed(np.zeros(0, np.int64))}
                    made.left_out(0)
                    made.rows.append(entry)
                    yield made.finished()
                    continue
                used, counted = made.used[0], made.counted(0)
                middle = closed(made.joined(used), counted["n_links"]) if len(used) else Fragment()
                before = [p[2] for p in parts[:1]] if len(parts) and not inner[0] and ends[0] > low else []
                after = [p[2] for p in parts[len(before):]]
                whole = compose([*before, middle, *after])
                numbers = np.arange(len(parts)) + len(made.links)
                made.rows.append({
                    **entry, "n_a": counted["n_a"] + sum(p[0] for p in parts),
                    "n_b": counted["n_b"] + sum(p[1] for p in parts),
                    "n_links": counted["n_links"] + sum(len(p[3]) for p in parts),
                    "groups": whole.groups, "cuts": whole.cuts, "head": whole.head, "body": whole.body,
                    "tail": whole.tail, "words": packed(np.concatenate([used, numbers]))})
                yield made.finished(row.as_py(), [p[3] for p in parts])

    return ranges.mapInArrow(run, ALIGNED)


def reduced(fragments: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(row, ok, cuts, head, body, groups, tail): the fragments (row, k, ...) of each document
    composed in order, ``fan_in`` at a time and level by level."""
    schema = "row long, k int, ok boolean, cuts boolean, head string, body string, groups long, tail string"
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("k").to_pylist()
        f = compose(Fragment(r["cuts"], r["head"], r["body"], r["groups"], r["tail"]) for r in rows)
        return pa.table({"row": pa.array([key[0].as_py()], pa.int64()), "k": pa.array([key[1].as_py()], pa.int32()),
                         "ok": [all(r["ok"] for r in rows)], "cuts": [f.cuts], "head": [f.head], "body": [f.body],
                         "groups": pa.array([f.groups], pa.int64()), "tail": [f.tail]})

    now = fragments.select(*names)
    while True:
        widest = now.agg(F.max("k")).first()[0]
        if not widest:
            return now.drop("k")
        # Composed level by level and written, so a lost task costs one level of one group.
        now = materialise(now.groupBy("row", F.expr(f"cast(k div {fan_in} as int)").alias("level"))
                          .applyInArrow(run, schema), "fragments")


def link_facts(pairs: DataFrame, vocabulary_b: int) -> DataFrame:
    """(pair, total, best, blocks) of the pairs (block, pair, n): corpus count, whether it is the
    highest of its B id, and how many blocks hold the pair."""
    totals = materialise(pairs.groupBy("pair").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("blocks"))
                         .withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1))), "pair-counts")
    if vocabulary_b > 1 << ID_BITS:
        raise ValueError(f"a vocabulary of {vocabulary_b} entries does not fit {ID_BITS} bits")
    # One row per B id: no more than the vocabulary holds.
    top = F.broadcast(totals.groupBy("b").agg(F.max("total").alias("top")))
    return materialise(totals.join(top, "b").select("pair", "total", (F.col("total") == F.col("top")).alias("best"),
                                                    "blocks"), "pair-facts")


def _sums(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """(kind, row, id, n_a, n_b, n_links, groups, hash, n_best, count_sum) of documents and ranges."""
    schema = ("kind int, row long, id long, n_a long, n_b long, n_links long, groups long, hash string, "
              "n_best long, count_sum long")
    kept = [f.split(" ")[0] for f in schema.split(", ")][:8]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = {c: left.column(c) for c in kept}
        best, count = [], []
        if right.num_rows:
            starts = np.frombuffer(right.column("starts")[0].as_py(), "<i8")
            places = np.frombuffer(right.column("places")[0].as_py(), "<i4")
            facts = right.column("facts").combine_chunks().flatten()

            def by_word(name: str) -> np.ndarray:
                values = facts.field(name).cast(pa.int64()).to_numpy()
                summed = np.concatenate([[0], np.cumsum(values[places])])
                return summed[starts[1:]] - summed[starts[:-1]]

            best_of, count_of = by_word("best"), by_word("total")
            for words in left.column("words").to_pylist():
                used = unpacked(words)
                best.append(int(best_of[used].sum()))
                count.append(int(count_of[used].sum()))
        else:
            best = count = [0] * left.num_rows
        return pa.table({**columns, "n_best": pa.array(best, pa.int64()), "count_sum": pa.array(count, pa.int64())})

    return rows.select("block", "words", *kept).groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(run, schema)


def align_documents(docs: DataFrame, files: tuple[str, ...] | None = None, id_col: str = "doc_id",
                    text_col: str = "text", chunk: int = CHUNK_BYTES, block_bytes: int = BLOCK_BYTES,
                    fan_in: int = FAN_IN) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): (id, n_a, n_b, n_groups, n_links, n_best, count_sum, hash) of every
    document, and (a, b, total, best) of every pair of ids linked in the corpus."""
    files = files or public_files()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).cast("binary").alias("data"))
    long = F.coalesce(F.octet_length("data") >= chunk, F.lit(False))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Only the ranges of long documents are dealt anew; short documents are aligned where they are read.
    dealt = _ranges(rows.where(long), chunk).repartition(parts, "row", "k")
    made = materialise(_whole_documents(rows.where(~long), files, block_bytes)
                       .unionByName(_range_fragments(dealt, files)), "aligned")
    ranges = made.where("kind = 2")
    refused = ranges.where("not ok").select("row").distinct()
    held = made.where("kind = 3").select("block", "row", "pairs", "counts", "starts", "places")
    # Blocks of whole documents have no row number.
    blocks = held.where("row is null").unionByName(
        held.where("row is not null").join(refused, "row", "left_anti"))
    zipped = F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "z")
    pairs = materialise(blocks.select("block", zipped).select(
        "block", "place", F.col("z.pairs").alias("pair"), F.col("z.counts").alias("n")), "pairs")
    facts = link_facts(pairs, _pieces(files[1]))
    back = attach_by_key(pairs.select("block", "place", "pair"), facts, "pair", "blocks") \
        .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "total", "best"))).alias("facts"))
    known = blocks.select("block", "starts", "places").join(back, "block").toDF("block", "starts", "places", "facts")
    summed = materialise(_sums(made.where("kind = 1 or kind = 2"), known), "aligned-sums")
    drop_scratch(docs.sparkSession, pairs)
    short = summed.where("kind = 1").select("id", "n_a", "n_b", F.col("groups").alias("n_groups"), "n_links", "n_best",
                                            "count_sum", "hash")
    # Long documents: counts are summed over ranges, groups come from the composed fragments.
    total = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_links", "n_best", "count_sum")]
    long_sums = summed.where("kind = 2").groupBy("row").agg(F.first("id").alias("id"), *total)
    text = F.concat_ws(";", "head", F.when(F.col("body") != "", F.col("body")))
    tree = reduced(ranges, fan_in).select("row", "ok", (F.col("groups") + 1).alias("n_groups"),
                                          F.sha2(text.cast("binary"), 256).alias("hash"))
    zero = F.lit(0).cast("long")
    counted = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    joined = long_sums.join(tree, "row").select(
        "id", *[F.when(F.col("ok"), F.col(c)).otherwise(zero).alias(c) for c in counted],
        F.when(F.col("ok"), F.col("hash")).otherwise(F.lit("")).alias("hash"))
    none = made.where("kind = 0").select("id", *[zero.alias(c) for c in counted], F.lit("").alias("hash"))
    pairs_of_ids = facts.select(F.shiftright("pair", ID_BITS).alias("a"),
                                F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)).alias("b"), "total", "best")
    return short.unionByName(joined).unionByName(none), pairs_of_ids


def _pieces(file: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=file).get_piece_size()


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = align_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.col("hash").alias("groups_sha256"))
