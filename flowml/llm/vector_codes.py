"""Vector code compression: product codes whose nearest entries are found in GNATs.

A vector is cut into equal consecutive parts; each part position has a codebook of entries and
a part is coded by the index of its nearest entry. Codebooks start as the parts of the vectors
of the smallest ids and are moved to the floored mean of their parts for a fixed number of
rounds. Everything is in integers, so the codes do not depend on partitions or their order.

The nearest entry comes from a GNAT (geometric near-neighbour access tree) over the entries of
a codebook. A node holds split points; every other entry of the node belongs to the child of
its nearest split point, and for each pair (split point i, child j) the node stores the smallest
and the largest distance from i to the entries of j. A query measures its distances to the
split points; with r its best distance so far, child j is left out, whole, when for some i

    d(q, i) + r < smallest(i, j)   or   d(q, i) - r > largest(i, j),

since by the triangle inequality every entry of j is then farther than r. Square roots are
rounded outward by a margin, so that no rounding error can leave out an entry at distance r
exactly; what is measured is compared by integer squared distances, ties to the lower index.

A pass over the vectors is map-only; an update sends one row per task, part and entry into an
aggregation. The driver sees codebooks only (parts x entries x part length numbers).

Defined results: vectors that are null, empty, or hold a null or non-finite component are left
out; rows that repeat an id are coded each (as seeds they are ordered by their components); a
null id comes after all others; with fewer vectors than entries the codebooks are shorter; an
empty table gives no rows; other columns are ignored. Vectors of several lengths, a length that
the parts do not divide, and components so large that squared distances leave 64 bits raise
ValueError.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowml.llm.common import attach_by_key, table
from flowml.session import materialise

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Split points of a node, and entries up to which a node is a leaf.
DEGREE, LEAF = 6, 4
#: Relative margin of distances, far above the rounding error of a square root.
MARGIN = 1e-9


def squared(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact squared distances (queries x points) of integer vectors."""
    out = np.zeros((len(q), len(x)), np.int64)
    for c in range(q.shape[1]):
        diff = q[:, c, None] - x[None, :, c]
        out += diff * diff
    return out


@dataclass
class Node:
    """``items``: split points (or all entries of a leaf). ``low[i, j]``, ``high[i, j]``: range of
    the distances from split point i to the entries of child j."""

    items: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    children: list = field(default_factory=list)


class Gnat:
    """Nearest entry of many queries at once. ``points``: int64 (entries x part length)."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.points, self.degree, self.leaf = np.asarray(points, np.int64), degree, leaf
        self.root = self._build(np.arange(len(self.points)))

    def _build(self, items: np.ndarray) -> Node:
        if len(items) <= max(self.leaf, self.degree):
            return Node(items)
        splits = [0]                                    # farthest-first from the lowest index
        near = squared(self.points[items], self.points[items[:1]])[:, 0]
        while len(splits) < self.degree and near.max() > 0:
            splits.append(int(near.argmax()))
            near = np.minimum(near, squared(self.points[items], self.points[items[splits[-1:]]])[:, 0])
        if len(splits) == 1:
            return Node(items)                          # all entries are equal
        chosen = items[splits]
        rest = np.delete(items, splits)
        far = squared(self.points[rest], self.points[chosen])
        home = far.argmin(axis=1)
        low, high = np.full((len(chosen),) * 2, np.inf), np.full((len(chosen),) * 2, -np.inf)
        node = Node(chosen, low, high)
        for j in range(len(chosen)):
            mine = home == j
            node.children.append(self._build(rest[mine]) if mine.any() else None)
            if mine.any():
                d = np.sqrt(far[mine].astype(np.float64))
                low[:, j], high[:, j] = d.min(axis=0) * (1 - MARGIN), d.max(axis=0) * (1 + MARGIN)
        return node

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of each query, and how many distances were measured."""
        n = len(queries)
        best, entry, measured = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.points)), 0

        def visit(node: Node, rows: np.ndarray) -> None:
            nonlocal measured
            d2 = squared(queries[rows], self.points[node.items])
            measured += d2.size
            least = d2.min(axis=1)
            first = np.where(d2 == least[:, None], node.items[None], len(self.points)).min(axis=1)
            better = (least < best[rows]) | ((least == best[rows]) & (first < entry[rows]))
            best[rows[better]], entry[rows[better]] = least[better], first[better]
            if not node.children:
                return
            d = np.sqrt(d2.astype(np.float64))
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                r = np.sqrt(best[rows].astype(np.float64))[:, None]
                slack = MARGIN * (d + r)
                out = ((d + r + slack < node.low[:, j]) | (d - r - slack > node.high[:, j])).any(axis=1)
                if not out.all():
                    visit(child, rows[~out])

        if n and len(self.points):
            visit(self.root, np.arange(n))
        return entry, best, measured


def largest_component(dims: int) -> int:
    """Components up to this size keep every sum of squared differences within 64 bits."""
    return math.isqrt((2 ** 63 - 1) // dims) // 2


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
              scale: int = SCALE) -> DataFrame:
    """(id, label, v): integer components of the usable vectors; ``label`` as text."""
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    rows = vectors.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).select(
        F.col(id_col).cast("long").alias("id"), label.alias("label"),
        F.transform(F.col(vec_col), lambda e: e.cast("double")).alias("d"))
    rows = rows.where(F.forall("d", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))
    # Kept as doubles (whole numbers) until their size is checked.
    return rows.select("id", "label", F.transform("d", lambda e: _floor(e * scale)).alias("v"))


def _floor(x):
    """Floor as a double: ``floor`` of a double beyond 64 bits has no long."""
    whole = F.rint(x)
    return F.when(whole > x, whole - 1).otherwise(whole)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _parts(v: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(v, parts, axis=1)]


class Codebooks:
    """Entries by part: int64 (parts x entries x part length), with a GNAT over each part's."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.trees = [Gnat(e) for e in entries]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _moved(rows: DataFrame, books: Codebooks, dims: int) -> Codebooks:
    """One round: every part to its nearest entry, every entry to the floored mean of its parts."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)  # sums, then the count
        for batch in batches:
            for p, x in enumerate(_parts(_matrix(batch.column(0), dims), parts)):
                entry = shared.value.trees[p].nearest(x)[0]
                np.add.at(total[p], entry, np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1))
        at = np.argwhere(total[:, :, -1] > 0)
        sums = total[at[:, 0], at[:, 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0], pa.int64()), pa.array(at[:, 1], pa.int64()), pa.array(list(sums), pa.list_(pa.int64()))],
            names=["part", "entry", "sums"])

    found = rows.select("v").mapInArrow(run, "part long, entry long, sums array<long>")
    exact = found.select("part", "entry", F.posexplode("sums").alias("place", "x")) \
        .groupBy("part", "entry", "place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    # Bounded: parts x entries x (part length + 1) numbers.
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for r in exact.collect():
        sums.setdefault((r.part, r.entry), {})[r.place] = int(r.x)
    new = books.entries.copy()
    for (p, e), s in sums.items():
        new[p, e] = [s[i] // s[width] for i in range(width)]
    return Codebooks(new)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of materialised ``rows`` (id, label, v); None for an empty table."""
    seen = rows.agg(F.min(F.size("v")), F.max(F.size("v")),
                    F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    if seen[0] is None:
        return None
    dims = seen[0]
    if seen[1] != dims or dims % parts:
        raise ValueError(f"vectors of {seen[0]} to {seen[1]} components cannot be cut into {parts} equal parts")
    if seen[2] > largest_component(dims):
        raise ValueError(f"a scaled component of size {seen[2]:g} is beyond {largest_component(dims)}")
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    first = np.array([[int(x) for x in r.v] for r in seeds], np.int64)
    books = Codebooks(np.stack(_parts(first, parts)))
    for _ in range(rounds):
        books = _moved(rows, books, dims)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, code, error): two hex digits a part, and the squared distance over all parts."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, entries, width = books.entries.shape
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([f"{e:0{digits}x}" for e in range(entries)], object)
        for batch in batches:
            code, error = np.full(batch.num_rows, "", object), np.zeros(batch.num_rows, np.int64)
            for p, x in enumerate(_parts(_matrix(batch.column(2), parts * width), parts)):
                entry, d2, _ = shared.value.trees[p].nearest(x)
                code, error = code + names[entry], error + d2
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()),
                                              pa.array(error, pa.int64())], names=["id", "label", "code", "error"])

    return rows.select("id", "label", "v").mapInArrow(run, "id long, label string, code string, error long")


def decode(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """Adds ``vector``: the middle of the entry's cells, in the components' own scale."""
    shared = codes.sparkSession.sparkContext.broadcast(books)
    parts, entries, _ = books.entries.shape
    digits = max(2, len(f"{entries - 1:x}"))
    at = codes.columns.index("code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for code in batch.column(at).to_pylist():
                picks = [int(code[digits * p:digits * (p + 1)], 16) for p in range(parts)]
                made.append((np.concatenate([shared.value.entries[p][e] for p, e in enumerate(picks)]) + 0.5) / scale)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.float64()))],
                                             names=[*batch.schema.names, "vector"])

    fields = ", ".join(f"`{c}` {t}" for c, t in codes.dtypes)
    return codes.mapInArrow(run, f"{fields}, vector array<double>")


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """((id, code, error, label_error), codebooks) of the usable vectors of a table."""
    rows = materialise(quantised(vectors, id_col, vec_col, label_col), "quantised")
    books = fit(rows, parts, entries, rounds)
    if books is None:
        return rows.sparkSession.createDataFrame([], "id long, code string, error long, label_error long"), None
    coded = materialise(encode(rows, books).withColumn(
        "key", F.coalesce(F.concat(F.lit("v"), F.col("label")), F.lit("null"))), "codes")
    facts = materialise(coded.groupBy("key").agg(F.sum("error").alias("label_error"),
                                                 F.count(F.lit(1)).alias("rows")), "label-errors")
    return attach_by_key(coded, facts, "key", "rows").select("id", "code", "error", "label_error"), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                        F.lit(books.sha256() if books else "").alias("codebooks_sha256"))


def _round_sql(n: int) -> str:
    """Assignment to the codebooks c{n} and, from it, the codebooks c{n + 1}."""
    distance = "CAST(list_sum(list_transform(x, lambda v, i: (v - c[i]) * (v - c[i]))) AS BIGINT)"
    return f"""
f{n} AS (SELECT rn, p, x, k, {distance} AS d FROM parts JOIN c{n} USING (p)),
a{n} AS (SELECT rn, p, any_value(x) AS x, min(d * 64 + k) % 64 AS k, min(d) AS d FROM f{n} GROUP BY rn, p),
s{n} AS (SELECT p, k, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
         FROM (SELECT p, k, x, unnest(range(1, len(x) + 1)) AS i FROM a{n}) GROUP BY p, k, i),
g{n} AS (SELECT p, k, list(m ORDER BY i) AS c FROM s{n} GROUP BY p, k),
c{n + 1} AS (SELECT p, k, coalesce(g{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN g{n} USING (p, k))"""


SQL = f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rn,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT rn, p, list_slice(e, CAST(p * len(e) / 16 AS BIGINT) + 1, CAST((p + 1) * len(e) / 16 AS BIGINT)) AS x
  FROM (SELECT rn, e, unnest(range(0, 16)) AS p FROM v)),
c0 AS (SELECT p, rn - 1 AS k, x AS c FROM parts WHERE rn <= 64),
{",".join(_round_sql(n) for n in range(ROUNDS + 1))},
coded AS (SELECT rn, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM a{ROUNDS} GROUP BY rn),
flat AS (SELECT p, k, unnest(range(1, len(c) + 1)) AS i, unnest(c) AS m FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY p, k, i)) FROM flat) AS codebooks_sha256
FROM v JOIN coded USING (rn)
"""
