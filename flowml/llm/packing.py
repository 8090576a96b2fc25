"""Packing documents into training sequences: best-two-fit.

Documents are encoded once (byte-level BPE plus an end id 0) and cut into pieces of at most
one sequence. Full pieces are sequences of their own. The others are dealt by hash to groups
of bounded size, and each group is packed on its own: bins are filled greedily with the
largest piece that fits; when none fits, the smallest piece of the bin is taken out if two
unpacked pieces together fill the widened gap more tightly.

A group holds thousands of pieces of all lengths, so it loses at most a few bins against one
global packing, and memory and time per task do not depend on the input size.

Defined results: null and empty text is the end id alone (one piece of length 1); a document
longer than a sequence has its remainder first and full pieces after it; equal lengths are
taken in the order of their hash, row and piece; rows that repeat an id are packed each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowml.llm.common import table
from flowml.session import materialise

SEQUENCE = 2048
END_ID = 0
#: Rows of a packing group on average; memory of a packing task follows this, not the input.
GROUP_ROWS = 16_384
#: Entries of the word cache of one Python worker (about 200 bytes each).
CACHE_WORDS = 600_000

# The places where the byte-level pre-tokeniser always separates: a run of Latin letters
# with the space before it ends at white space or ASCII punctuation; other text up to white
# space stays together; white space stands alone. Nothing merges across such places.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_CHUNK = re.compile(rf" ?[{_LETTERS}]+(?=[\s!-/:-@\[-`{{-~]|$)| ?\S+|\s+(?!\S)|\s+")
# White space on which the library's and Python's patterns differ, and text that the
# vocabulary file treats specially: such documents are encoded whole.
_WHOLE = re.compile(r"[\x1c-\x1f\x85]|<\|")


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes, with a bounded cache of chunks.

    ``vocabulary`` is the tokenizers file, ``ranks`` the same vocabulary as merge ranks: the
    faster library encodes the chunks that the cache lacks.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken

        self.vocabulary, self._library = vocabulary, None
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.chunks = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.cache: dict[str, bytes] = {}

    @property
    def library(self):
        """The tokenizers object, loaded when the first text needs it."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.vocabulary)
        return self._library

    def encode(self, text: str) -> bytes:
        if _WHOLE.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return array("I", ids).tobytes()
        chunks, cache = _CHUNK.findall(text), self.cache
        new = set(chunks).difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = set(chunks)
        one = self.chunks.encode_ordinary
        for chunk in new:
            cache[chunk] = array("I", one(chunk)).tobytes()
        return b"".join(map(cache.__getitem__, chunks))


_encoders: dict[tuple, Encoder] = {}


def encoder(*files: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if files not in _encoders:
        _encoders[files] = Encoder(*files)
    return _encoders[files]


def public_vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str, str]:
    """Paths of a public byte-level vocabulary in both forms, and its pattern."""
    import public_tokenizers

    return (str(public_tokenizers.path(f"{name}.json")), str(public_tokenizers.path(f"{name}.tiktoken")),
            public_tokenizers.PATTERN)


def cut(n: int, sequence: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: the remainder, then full ones."""
    first = n % sequence or sequence
    return [(0, first)] + [(s, sequence) for s in range(first, n, sequence)] if n > sequence else [(0, n)]


def pieces(docs: DataFrame, vocabulary: tuple[str, str, str], id_col: str = "doc_id", text_col: str = "text",
           sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """(row, id, piece, start, length, ids_crc32[, ids]) of every document.

    ``with_ids`` also returns the ids themselves (uint32 bytes), for writing sequences.
    """
    schema = "row long, id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(*vocabulary)
        end = np.asarray([END_ID], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = enc.encode(text or "") + end
                for k, (start, n) in enumerate(cut(len(ids) // 4, sequence)):
                    part = ids[4 * start:4 * (start + n)]
                    out.append((row, doc, k, start, n, zlib.crc32(part)) + ((part,) if with_ids else ()))
            columns = list(zip(*out)) or [()] * (6 + with_ids)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["row", "id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=names[:len(columns)])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def best_two_fit(lengths, capacity: int) -> list[list[int]]:
    """Bins (lists of positions in ``lengths``), each of total at most ``capacity``.

    Lengths are 1..capacity. A bit mask of the lengths still unpacked finds the largest that
    fits in one step.
    """
    left: dict[int, list[int]] = defaultdict(list)
    for i in range(len(lengths) - 1, -1, -1):
        left[int(lengths[i])].append(i)
    mask = 0
    for n in left:
        mask |= 1 << n

    def largest(limit: int) -> int:
        return (mask & ((1 << (limit + 1)) - 1)).bit_length() - 1 if limit > 0 else -1

    def take(n: int) -> int:
        nonlocal mask
        i = left[n].pop()
        if not left[n]:
            mask &= ~(1 << n)
        return i

    def pair(least: int, room: int) -> tuple[int, int] | None:
        """Two unpacked lengths whose sum is over ``least`` and as near ``room`` as possible."""
        best, found = least, None
        a = largest(room - 1)
        while a > 0 and 2 * a > best:
            b = largest(min(room - a, a))
            if b == a and len(left[a]) < 2:
                b = largest(a - 1)
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == room:
                    break
            a = largest(a - 1)
        return found

    bins: list[list[int]] = []
    while mask:
        used, mine = 0, []  # mine: (length, position)
        while (n := largest(capacity - used)) > 0:
            mine.append((n, take(n)))
            used += n
        gap = capacity - used
        if gap and mask and len(mine) > 1:
            small = mine[-1]  # the last taken is the smallest
            if (two := pair(small[0], gap + small[0])):
                mine.pop()
                mine += [(n, take(n)) for n in two]
                if not left[small[0]]:
                    mask |= 1 << small[0]
                left[small[0]].append(small[1])
        bins.append([i for _, i in mine])
    return bins


def pack(parts: DataFrame, sequence: int = SEQUENCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds (sequence_id, offset) to pieces (row, id, piece, start, length, ids_crc32).

    ``parts`` must be materialised (it is read twice). Groups are numbered by the hash of
    (row, piece); their count follows the number of pieces.
    """
    full = parts.where(F.col("length") == sequence)
    rest = parts.where(F.col("length") < sequence)
    groups = max(1, -(-rest.count() // group_rows))
    dealt = rest.withColumn("hash", F.xxhash64("row", "piece")) \
        .withColumn("group", F.pmod("hash", F.lit(groups)))
    names = ["row", "id", "piece", "start", "length", "ids_crc32"]
    schema = ("row long, id long, piece int, start long, length long, ids_crc32 long, "
              "sequence_id long, offset long")

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["hash", "row", "piece"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        where, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for b, members in enumerate(best_two_fit(lengths, sequence)):
            at = 0
            for i in members:
                where[i], offset[i] = b, at
                at += lengths[i]
        out = pdf[names].copy()
        out["sequence_id"] = where * groups + int(pdf["group"].iloc[0]) if len(pdf) else where
        out["offset"] = offset
        return out

    packed = dealt.groupBy("group").applyInPandas(fill, schema)
    # Full pieces are numbered below zero, apart from the packed bins.
    alone = full.select(*names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, vocabulary: tuple[str, str, str] | None = None, id_col: str = "doc_id",
                   text_col: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    return pack(materialise(pieces(docs, vocabulary or public_vocabulary(), id_col, text_col, sequence), "pieces"),
                sequence)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every piece of every document with its place in a sequence."""
    return pack_documents(docs).select(F.col("id").alias("doc_id"), "piece", "start", "length",
                                       "ids_crc32", "sequence_id", "offset")


def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, table(spark, sf_dir, "documents"), sf_dir)
