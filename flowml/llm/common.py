"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words in every contract here (ASCII only).
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"


@contextmanager
def few_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """For jobs run inside: so many rows are read from files and sent to Python at a time. A
    setting of the session is by number of rows, and rows here may hold megabytes."""
    before = {key: spark.conf.get(key) for key in _AT_ONCE}
    try:
        for key in _AT_ONCE:
            spark.conf.set(key, str(rows))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (a null id falls in fold 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(0))


def attach_by_key(rows: DataFrame, facts: DataFrame, key: str, count: str,
                  n_hot: int = 1000) -> DataFrame:
    """Inner join of ``rows`` to ``facts`` (one row per ``key``; ``count`` says how many rows
    of ``rows`` have that key), safe when one key holds a large share of the rows.

    Keys holding at least a ``1/n_hot`` share number at most ``n_hot``, whatever the input,
    so broadcasting those facts is bounded; their rows then never meet in one task. The
    others go through an ordinary shuffled join. Pass materialised inputs: each side is
    read twice.
    """
    total = facts.agg(F.coalesce(F.sum(count), F.lit(0)).cast("long")).first()[0]
    is_hot = F.col(count) * F.lit(n_hot) >= F.lit(max(total, 1))
    hot, cold = facts.where(is_hot), facts.where(~is_hot)
    left = rows.join(F.broadcast(hot), key)
    right = (rows.join(F.broadcast(hot.select(key)), key, "left_anti")
             .join(cold.hint("merge"), key))
    return left.unionByName(right)


def keep_rows(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids`` (a null id matches a null id); columns unchanged."""
    chosen = ids.select(F.col(id_col).alias("__keep"))
    return docs.join(chosen, F.col(id_col).eqNullSafe(F.col("__keep")), "left_semi")


class IdBits:
    """Bits of hashed ids, broadcast: finds the rows of given ids where they lie, without a shuffle.

    All rows of the ids pass, and a few others: an id sets two bits, which another one meets with
    a probability of at most ``(2 / per_id) ** 2``. The number of bits follows the number of ids up
    to ``most`` (32 MB); beyond that more others pass, so it only ever saves work.
    """

    def __init__(self, ids: DataFrame, col: str = "id", per_id: int = 16, most: int = 1 << 28):
        self.size = min(most, 1 << max(10, (per_id * ids.count()).bit_length()))
        hashed, last = self.hashed(col), F.lit(self.size - 1)
        bits = ids.select(F.explode(F.array(
            hashed.bitwiseAND(last), F.shiftrightunsigned(hashed, 32).bitwiseAND(last))).alias("h")) \
            .groupBy(F.shiftright("h", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("bits")).toPandas()
        words = np.zeros(self.size // 64, np.uint64)
        words[bits["word"].to_numpy().astype(np.int64)] = bits["bits"].to_numpy().astype(np.int64).view(np.uint64)
        self.words = ids.sparkSession.sparkContext.broadcast(words)

    @staticmethod
    def hashed(col: str) -> Column:
        return F.xxhash64(col)

    @staticmethod
    def mask(words: np.ndarray, hashes: pa.Array) -> pa.Array:
        """Which of the rows pass; ``words`` is the broadcast value, so that tasks carry nothing else."""
        h, out = hashes.to_numpy().view(np.uint64), True
        for at in (h, h >> np.uint64(32)):
            at = at & np.uint64(len(words) * 64 - 1)
            out = out & ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1)
        return pa.array(out)

    def rows(self, df: DataFrame, col: str) -> DataFrame:
        """The rows of ``df`` that pass by ``col``; columns unchanged."""
        words = self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.select(batch.schema.names[:-1]).filter(IdBits.mask(words.value, batch.column(batch.num_columns - 1)))

        return df.select(*df.columns, self.hashed(col).alias("__hashed")).mapInArrow(run, df.schema)


def sorted_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The groups of equal ``key`` (a long) of a partition that is sorted by it, one at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.names.index(key)).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            part = batch.slice(low, high - low)
            if held and held[0].column(key)[0].as_py() != int(keys[low]):
                yield _one(held)
                held = []
            held.append(part)
    if held:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def gathered(batches: Iterable[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows``, so that many small results cost little."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield _one(held)
            held, n = [], 0
    if held:
        yield _one(held)
