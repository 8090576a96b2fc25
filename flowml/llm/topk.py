"""Exact top-k inner-product search with the threshold algorithm.

Vectors are quantised to integers and cut into blocks. Inside a block every dimension has a
list of the vectors sorted by that component. For a query the lists are read in step, each
from the end that its component favours, to depth 1, 2, 4, ... times a base; every vector
met for the first time is scored in full. The sum over dimensions of the query's component
times the last value read bounds all vectors not yet met; the search of the block stops when
that bound is below the k-th best score so far. The best k of each block are merged.

Queries are a stated set that meets all vectors, block by block: a query chunk and a vector
block are brought together by an equi-join on the pair's number. The k-th score a query has
in one block is not known in the others, so each block is read until its own bound holds;
this costs reads, never results.

Defined results: null vectors, and vectors with a null or non-finite component, take no part
(neither as query nor as candidate); so do vectors of another dimension than the most common
one; equal scores go to the smaller id; a query is never its own answer, but another row with
the same vector is; rows that repeat an id are one vector each, and none of them answers a
query of that id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowml.llm.common import table
from flowml.session import materialise

SCALE = 64
TOP = 20
BLOCK_ROWS = 8_192
QUERY_ROWS = 1_024
FIRST_DEPTH = 64
#: Queries that advance together.
BATCH = 64


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): components floor(scale * x) of the usable vectors, as doubles hold them exactly."""
    x = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    usable = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)) \
        .select(F.col(id_col).cast("long").alias("id"), x.alias("d"))
    usable = usable.where(F.forall("d", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))
    return usable.select("id", F.transform("d", lambda e: F.floor(e * scale).cast("long")).alias("v"))


def threshold_search(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
                     k: int = TOP, first: int = FIRST_DEPTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of each query's best ``k`` among ``vectors``, by Fagin's threshold algorithm.

    Queries advance in batches: a vector is scored when the first query of the batch meets it
    in one of its lists, and counts for a query once that query has met it. Integers are held
    as float64; sums stay exact below 2**53.
    """
    n, dims = vectors.shape
    order = np.argsort(vectors, axis=0, kind="stable")       # ascending list of each dimension
    ranked = np.take_along_axis(vectors, order, axis=0)
    up = np.empty((dims, n), np.int32)                       # place of a vector in the ascending list
    np.put_along_axis(up, np.ascontiguousarray(order.T), np.arange(n, dtype=np.int32)[None], axis=1)
    down = np.int32(n - 1) - up
    out: list = [None] * len(queries)
    for at in range(0, len(queries), BATCH):
        batch = queries[at:at + BATCH]
        # The depth at which each query meets each vector; at once if no component favours an end.
        meets = np.zeros((len(batch), n), np.int32)
        for i, q in enumerate(batch):
            if q.any():
                meets[i] = np.minimum(np.min(down[q > 0], axis=0, initial=n), np.min(up[q < 0], axis=0, initial=n))
        own = ids[None] == query_ids[at:at + BATCH, None]
        scores = np.zeros((len(batch), n))
        known = np.zeros(n, bool)
        active, depth = np.arange(len(batch)), first
        while len(active):
            depth = min(depth, n)
            met = meets[active] < depth
            new = np.flatnonzero(met.any(0) & ~known)
            scores[:, new] = (vectors[new] @ batch.T).T
            known[new] = True
            seen = np.where(met & ~own[active], scores[active], -np.inf)
            kth = np.partition(seen, n - k, axis=1)[:, n - k] if n >= k else np.full(len(active), -np.inf)
            # No vector still unmet can score more than this.
            q = batch[active]
            bound = np.maximum(q, 0) @ ranked[n - depth] + np.minimum(q, 0) @ ranked[depth - 1]
            over = (bound < kth) | (depth >= n)
            for i in np.flatnonzero(over):
                good = np.flatnonzero((seen[i] >= kth[i]) & np.isfinite(seen[i]))
                best = good[np.lexsort((ids[good], -seen[i, good]))[:k]]
                out[at + active[i]] = ids[best], seen[i, best]
            active, depth = active[~over], depth * 4
    return out


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
          k: int = TOP, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, id, score): the best ``k`` of all other vectors for each query row."""
    spark = vectors.sparkSession
    rows = materialise(quantised(vectors, id_col, vec_col).withColumn("dims", F.size("v")), "quantised")
    dims = rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").select("dims").head()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    rows = rows.where(F.col("dims") == dims[0]).drop("dims")
    width = int(dims[0])
    asked = rows.withColumnRenamed("id", id_col).where(is_query).withColumnRenamed(id_col, "id")
    blocks = max(1, -(-rows.count() // block_rows))
    chunks = max(1, -(-asked.count() // query_rows))

    def packed(df: DataFrame, parts: int) -> DataFrame:
        """One row per block: its number, ids and components, as bytes of bounded size."""
        def whole(key, got):
            flat = got.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return pa.table({
                "part": pa.array([key[0].as_py()], pa.int64()),
                "ids": pa.array([got.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                "data": pa.array([flat.astype("<i8").tobytes()], pa.binary())})

        dealt = df.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
        return dealt.groupBy("part").applyInArrow(whole, "part long, ids binary, data binary")

    stored = materialise(packed(rows, blocks), "vector-blocks")
    queries = materialise(packed(asked, chunks), "query-blocks")
    # Every query chunk meets every block once: both sides name the pair, an equi-join brings them together.
    left = stored.select("part", "ids", "data", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")) \
        .select((F.col("part") * chunks + F.col("chunk")).alias("pair"), "ids", "data")
    right = queries.select(F.col("part").alias("chunk"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")) \
        .select((F.col("block") * chunks + F.col("chunk")).alias("pair"), "q_ids", "q_data")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, q_ids, q_data in zip(*(c.to_pylist() for c in batch.columns)):
                ids, q_ids = np.frombuffer(ids, "<i8"), np.frombuffer(q_ids, "<i8")
                data = np.frombuffer(data, "<i8").reshape(-1, width).astype(np.float64)
                q_data = np.frombuffer(q_data, "<i8").reshape(-1, width).astype(np.float64)
                found = threshold_search(data, ids, q_data, q_ids, k)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(q_ids, [len(f[0]) for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[1] for f in found]).astype(np.int64), pa.int64())],
                    names=["query_id", "id", "score"])

    pairs = left.join(right.hint("merge"), "pair").drop("pair")
    found = pairs.mapInArrow(search, "query_id long, id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
