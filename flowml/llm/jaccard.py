"""Exact Jaccard join of documents as sets of five-word shingles, in the metric space of the
Jaccard distance (1 - similarity): links are pairs at distance 0.2 or less.

1. Equal sets are one point. A point's *signature* is its 20 % of shingles that come first in
   one global order (plus one): two points within the radius share a shingle of their
   signatures. The points that share one are compared by sketches: how many of a set's
   shingles fall on each of 512 buckets. The sum of the differences of two sketches bounds the
   sets' difference from below, so only pairs that cannot be links are told apart. What stays
   connected is a region; points of two regions are farther apart than the radius. That separates unrelated
   documents, whose distance is 1 from every pivot, without comparing them. The order is by
   hash, with shingles that are frequent in a sample of the documents last; the sample only
   bends the order, any order gives the same links.
2. A region is joined with pivots. Points within the radius of a pivot are linked to it; what
   else such a point y can link to lies, by the triangle inequality, in the window of points z
   with d(z, pivot) <= d(y, pivot) + 0.2, so y is finished if no point of another component
   is in that window. Pivots are taken until all points are finished.
3. A region too large for one task is dealt to tasks, and its points meet pivots there, round by
   round, a bounded number at a time. Only points outside the region's largest component become
   pivots, each at most once; when none is left, of two linked points one was a pivot, which met
   all, or both are in that component. Nothing is replicated but the pivots of a round, whose
   copies are no more than the points, so no size is left out and the disk is in proportion.

Defined results: null text, and text without words, is the empty set, linked with nothing; a
text of fewer than five words has its whole sequence as its one shingle; a row with a null id
is linked with nothing and has a null component; rows that repeat an id are one node; an
empty table gives no rows; other columns are ignored. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowml.functions.hashing import hash_u32
from flowml.llm.common import IdBits, attach_by_key, keep_rows, table
from flowml.llm.graph import components
from flowml.session import drop_scratch, materialise

WORDS = 5
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 80
RADIUS = 1 - PERCENT / 100
#: Points and shingles of a region that one task joins.
REGION_POINTS = 2_000
REGION_SHINGLES = 8_000_000
#: Pivots of a large region: so many at first, 16 times as many a round, REGION_POINTS from round LEVELS on.
PIVOTS = 16
LEVELS = 4
#: Numbers of the table in which a task holds the shingles of some pivots.
PIVOT_CELLS = 1 << 24
#: Frequent shingles that are put last: at most so many, seen in so many sampled documents.
FREQUENT, FREQUENT_SEEN, SAMPLED = 65_536, 2, 16
#: Buckets of a point's sketch.
SKETCH = 512
#: Points sharing a shingle: up to PAIR_POINTS they are paired, up to LIST_POINTS compared in
#: one task; longer lists are cut by size, and what is longer still is put in one region unseen.
PAIR_POINTS, LIST_POINTS = 16, 4_096
#: Signature shingles (with repeats) that are shuffled at a time.
TOKENS_AT_ONCE = 1 << 24
FILTER_BITS = 26
_MUL = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text (UTF-8 bytes).

    ``bytes.lower`` and ``bytes.split`` treat ASCII letters and ASCII white space only.
    """
    parts = (text or b"").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = min(words, len(parts))
    with np.errstate(over="ignore"):
        s = h[:len(h) - n + 1].copy()
        for i in range(1, n):
            s = s * _MUL + h[i:len(h) - n + 1 + i]
        s = (s ^ (s >> np.uint64(31)) ^ np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
        s ^= s >> np.uint64(29)
    return np.unique(s)


def signature(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles in the global order that a point within the radius cannot all miss."""
    n = len(found)
    if not n:
        return found
    keep = n - (-(-PERCENT * n // 100)) + 1
    if len(frequent):
        at = np.searchsorted(frequent, found)
        common = frequent[np.minimum(at, len(frequent) - 1)] == found
        found = np.concatenate([found[~common], found[common]])
    return found[:keep]


def _text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles found in at least ``FREQUENT_SEEN`` of every ``SAMPLED``-th document, most
    frequent first, at most ``FREQUENT``. Used for ordering only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64), pa.int64())], names=["s"])

    sample = docs.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLED)) == 0).mapInArrow(run, "s long")
    top = sample.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= FREQUENT_SEEN) \
        .orderBy(F.desc("c"), "s").limit(FREQUENT)
    return np.sort(np.asarray([r.s for r in top.select("s").collect()], np.int64).view(np.uint64))


def sketch(found: np.ndarray) -> np.ndarray:
    """How many shingles fall on each bucket, in one byte each (255 stands for more)."""
    place = (found >> np.uint64(20)).astype(np.int64) % SKETCH
    return np.minimum(np.bincount(place, minlength=SKETCH), 255).astype(np.uint8)


def _sketches(data) -> np.ndarray:
    return np.frombuffer(b"".join(data), np.uint8).reshape(-1, SKETCH).astype(np.int16)


def described(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(id, n, set_id, sign, sketch): size, digest of the set, signature and sketch of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for batch in batches:
            sizes, digests, signs, maps = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signs.append(signature(found, last).view(np.int64))
                maps.append(sketch(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signs, pa.list_(pa.int64())), pa.array(maps, pa.binary())],
                names=["id", "n", "set_id", "sign", "sketch"])

    return docs.mapInArrow(run, "id long, n long, set_id binary, sign array<long>, sketch binary")


def _id_filter(ids: DataFrame) -> DataFrame:
    """Bits of the hashed ids, 64 to a row: at most 2**FILTER_BITS / 64 rows whatever the input."""
    h = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    return ids.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("bits"))


def _filter_words(ids: DataFrame):
    """The bits of :func:`_id_filter` as a broadcast array of fixed size."""
    rows = _id_filter(ids).toPandas()
    words = np.zeros((1 << FILTER_BITS) // 64, np.uint64)
    words[rows["word"].to_numpy().astype(np.int64)] = rows["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(words)


def _passes(words: np.ndarray, h: np.ndarray) -> pa.Array:
    return pa.array((words[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1)


def _hashed_id():
    return F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS)).alias("h")


def sets_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(region, id, n, data): the shingles (bytes) of the documents in ``members`` (id, region).

    Texts are not shuffled: a bit filter of fixed size passes the members (and few others)
    where the texts are read, and only the sets made there are joined exactly.
    """
    shared = _filter_words(members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(_passes(shared.value, batch.column(2).to_numpy()))
            found = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([f.tobytes() for f in found], pa.binary())], names=["id", "n", "data"])

    hashed = docs.where(F.col("id").isNotNull()).select("id", "text", _hashed_id())
    made = hashed.mapInArrow(run, "id long, n long, data binary").where("n > 0")
    return made.join(members, "id").select("region", "id", "n", "data")


def tokens_of(rows: DataFrame, points: DataFrame) -> DataFrame:
    """(s, u): the signature shingles of the rows whose id is among ``points`` (id). The bit
    filter may pass a copy of a point besides; that adds an equal point, no wrong link."""
    shared = _filter_words(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(_passes(shared.value, batch.column(2).to_numpy()))
            sign = batch.column(1)
            n = np.diff(sign.offsets.to_numpy())
            yield pa.RecordBatch.from_arrays(
                [sign.flatten(), pa.array(np.repeat(batch.column(0).to_numpy(), n), pa.int64())], names=["s", "u"])

    return rows.select("id", "sign", _hashed_id()).mapInArrow(run, "s long, u long")


def _apart(sketches: np.ndarray, p: int, others: np.ndarray) -> np.ndarray:
    return np.abs(sketches[others] - sketches[p]).sum(1, dtype=np.int64)


def may_link(apart, a, b):
    """Can sets of sizes a and b whose sketches differ by so much be within the radius? Their
    difference is at most (1 - t) / (1 + t) of the sum of sizes, and the smaller at least t of
    the larger."""
    return (apart * (100 + PERCENT) <= (100 - PERCENT) * (a + b)) & (100 * a >= PERCENT * b) & (100 * b >= PERCENT * a)


def near_in_list(sketches: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each point the smallest position of its component under :func:`may_link`, by
    pivots and triangle windows in the space of the sketches."""
    n = len(sizes)
    parent, open_ = np.arange(n), np.arange(n)
    widest = (100 - PERCENT) * 2 * int(sizes.max(initial=0)) // (100 + PERCENT)
    while len(open_) > 1 and (parent[open_] != parent[open_[0]]).any():
        p, rest = open_[0], open_[1:]
        far = _apart(sketches, p, rest)
        linked = may_link(far, sizes[p], sizes[rest])
        for c in np.unique(parent[rest[linked]]):
            a, b = min(c, parent[p]), max(c, parent[p])
            parent[parent == b] = a
        foreign = parent[rest] != parent[p]
        reach = far[foreign].min() if foreign.any() else np.iinfo(np.int64).max
        open_ = rest[~(linked & (far + widest < reach))]
    return parent


def shared_lists(tokens: DataFrame) -> DataFrame:
    """(s, u, c, v) of the tokens (s, u) whose shingle s stands in c > 1 of them, v being its smallest
    point; ``tokens`` is dropped. Shingles are dealt to passes by their hash, so that what is
    shuffled at once is bounded; tokens alone in their shingle are not shuffled a second time."""
    spark = tokens.sparkSession
    tokens = materialise(tokens.select("s", "u"), "tokens")
    passes, found = max(1, -(-tokens.count() // TOKENS_AT_ONCE)), None
    for at in range(passes):
        mine = tokens.where(F.pmod(F.xxhash64("s"), F.lit(passes)) == at) if passes > 1 else tokens
        # Summed up before the exchange: no task meets all points of a shared shingle.
        facts = materialise(mine.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("u").alias("v")).where("c > 1"), "shared")
        held = materialise(IdBits(facts, "s").rows(mine, "s"), "held-tokens")
        lists = materialise(attach_by_key(held, facts, "s", "c"), "lists")
        drop_scratch(spark, facts, held)
        found = lists if found is None else found.unionByName(lists)
    drop_scratch(spark, tokens)
    return found


def cut_by_size(lists: DataFrame, info: DataFrame) -> DataFrame:
    """The lists (s, u) cut by the points' sizes (u, n): sets within the radius are in one class of
    sizes or in two that follow each other, so a point goes to the part of its class and to the next."""
    own = F.floor(F.log("n") / F.lit(np.log(100 / PERCENT) + 1e-9))
    sized = lists.select("s", "u").join(info.select("u", "n").distinct(), "u")
    parts = sized.select("s", "u", F.explode(F.array(own, own + 1)).alias("part"))
    return shared_lists(parts.select(F.xxhash64("s", "part").alias("s"), "u").distinct())


def candidates(tokens: DataFrame, rows: DataFrame, pair_points: int = PAIR_POINTS,
               list_points: int = LIST_POINTS) -> DataFrame:
    """Edges (u, v) whose components are the regions: no link connects two of them."""
    lists = shared_lists(tokens)
    info = rows.select(F.col("id").alias("u"), "n", "sketch")
    long = lists.where(F.col("c") > list_points)
    if not long.isEmpty():
        lists = lists.where(F.col("c") <= list_points).unionByName(cut_by_size(long, info))
    few = lists.where(F.col("c") <= pair_points).select("s", "u")
    pairs = few.join(few.withColumnRenamed("u", "v"), "s").where("u > v").select("u", "v").distinct()
    other = info.select(F.col("u").alias("v"), F.col("n").alias("n_v"), F.col("sketch").alias("sketch_v"))
    sized = pairs.join(info.select("u", "n"), "u").join(other.select("v", "n_v"), "v") \
        .where((100 * F.col("n") >= PERCENT * F.col("n_v")) & (100 * F.col("n_v") >= PERCENT * F.col("n"))) \
        .select("u", "v").distinct()

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                u, v, n, n_v = (part.column(i).to_numpy() for i in range(4))
                apart = np.abs(_sketches(part.column(4).to_pylist()) - _sketches(part.column(5).to_pylist())).sum(1)
                keep = may_link(apart, n, n_v)
                yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], names=["u", "v"])

    paired = sized.join(info, "u").join(other, "v").select("u", "v", "n", "n_v", "sketch", "sketch_v") \
        .mapInArrow(passing, "u long, v long")

    def run(key, pdf):
        pdf = pdf.sort_values("u", kind="stable")
        ids = pdf["u"].to_numpy()
        root = near_in_list(_sketches(pdf["sketch"]), pdf["n"].to_numpy())
        return pd.DataFrame({"u": ids, "v": ids[root]})

    some = lists.where((F.col("c") > pair_points) & (F.col("c") <= list_points)).select("s", "u")
    listed = some.join(info, "u").groupBy("s").applyInPandas(run, "u long, v long")
    many = lists.where(F.col("c") > list_points).select("u", "v")
    return paired.unionByName(listed).unionByName(many).where("u <> v").distinct()


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    return len(np.intersect1d(a, b, assume_unique=True))


def measured(shared: np.ndarray, a, b) -> tuple[np.ndarray, np.ndarray]:
    """(distance, linked) from intersection and set sizes; linked is decided in integers."""
    union = a + b - shared
    return 1 - shared / union, 100 * shared >= PERCENT * union


def join_region(sets: list[np.ndarray]) -> np.ndarray:
    """For each point of a region the smallest position of its component, by pivots and windows.

    Points whose sketch shows that they cannot be linked to a pivot are not intersected with
    it; the sketch's bound on their distance takes its place in the window test.
    """
    n = len(sets)
    parent = np.arange(n)
    if n < 2:
        return parent
    sizes = np.fromiter(map(len, sets), np.int64, n)
    sketches = np.stack([sketch(s) for s in sets]).astype(np.int16)
    open_ = np.arange(n)
    while len(open_) > 1 and (parent[open_] != parent[open_[0]]).any():
        p, rest = open_[0], open_[1:]
        apart = _apart(sketches, p, rest)
        far, linked = 2 * apart / (sizes[p] + sizes[rest] + apart), np.zeros(len(rest), bool)
        near = np.flatnonzero(may_link(apart, sizes[p], sizes[rest]))
        shared = np.fromiter((common(sets[p], sets[rest[i]]) for i in near), np.int64, len(near))
        far[near], linked[near] = measured(shared, sizes[p], sizes[rest[near]])
        for c in np.unique(parent[rest[linked]]):
            a, b = min(c, parent[p]), max(c, parent[p])
            parent[parent == b] = a
        foreign = parent[rest] != parent[p]
        reach = far[foreign].min() if foreign.any() else np.inf
        # Finished: linked to the pivot, and no point of another component in the window.
        done = linked & (far + RADIUS + 1e-9 < reach)
        open_ = rest[~done]
    return parent


def _sets(data) -> list[np.ndarray]:
    return [np.frombuffer(d, np.uint64) for d in data]


def _join_in_tasks(points: DataFrame) -> DataFrame:
    """Edges (u, v) of regions that fit a task: each point to the smallest of its component."""
    def run(key, pdf):
        pdf = pdf.sort_values("id", kind="stable")
        ids = pdf["id"].to_numpy()
        root = join_region(_sets(pdf["data"]))
        return pd.DataFrame({"u": ids, "v": ids[root]})

    return points.groupBy("region").applyInPandas(run, "u long, v long").where("u <> v")


def pivot_links(points: list[np.ndarray], pivots: list[np.ndarray],
                cells: int = PIVOT_CELLS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What links to pivots, some pivots at a time: (their positions, for each point the smallest
    of them in its component or -1, for each of them the smallest). Intersections are
    counted in a table of the pivots' shingles."""
    sizes = np.fromiter(map(len, points), np.int64, len(points))
    ends = np.r_[0, np.cumsum(sizes)]
    flat = np.concatenate(points) if points else np.zeros(0, np.uint64)
    at = 0
    while at < len(pivots):
        stop, total = at + 1, len(pivots[at])
        while stop < len(pivots) and (total + len(pivots[stop])) * (stop + 1 - at) <= cells:
            total += len(pivots[stop])
            stop += 1
        k, some = stop - at, pivots[at:stop]
        known = np.unique(np.concatenate(some))
        table = np.zeros((len(known), k), np.float32)
        for j, p in enumerate(some):
            table[np.searchsorted(known, p), j] = 1
        place = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        hit = known[place] == flat
        shared = np.zeros((len(points), k), np.int64)
        for i, (low, high) in enumerate(zip(ends, ends[1:])):
            mine = place[low:high][hit[low:high]]
            if len(mine):
                shared[i] = table[mine].sum(0)
        linked = measured(shared, np.fromiter(map(len, some), np.int64, k), sizes[:, None])[1]
        label = np.arange(k)
        while True:
            of_points = np.where(linked, label, k).min(1, initial=k)
            least = np.minimum(label, np.where(linked, of_points[:, None], k).min(0, initial=k))
            least = np.minimum(least, least[least])
            if (least == label).all():
                break
            label = least
        yield np.arange(at, stop), np.where(of_points < k, at + of_points, -1), at + label
        at = stop


def _meet(dealt: DataFrame, pivots: DataFrame) -> DataFrame:
    """Edges (u, v) that connect the points (region, chunk, chunks, id, data) of large regions with the
    pivots (region, id) within the radius: the pivots are sent to every chunk of their region."""
    active = dealt.join(pivots.select("region").distinct(), "region", "left_semi")
    sent = IdBits(pivots).rows(active, "id").join(pivots, ["region", "id"], "left_semi").select(
        "region", "id", "data", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))

    def run(key, left, right):
        u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(left) and len(right):
            ids, pids = left["id"].to_numpy(), right["id"].to_numpy()
            for part, of_points, of_pivots in pivot_links(_sets(left["data"]), _sets(right["data"])):
                u += [ids[of_points >= 0], pids[part]]
                v += [pids[of_points[of_points >= 0]], pids[of_pivots]]
        return pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)})

    return active.groupBy("region", "chunk").cogroup(sent.groupBy("region", "chunk")).applyInPandas(
        run, "u long, v long").where("u <> v").distinct()


def _swept(points: DataFrame, sizes: DataFrame, region_points: int, region_shingles: int, levels: int) -> DataFrame:
    """Edges (u, v) that connect the components of large regions, ``sizes`` being (region, c points, s shingles)."""
    spark = points.sparkSession
    chunks = F.greatest(F.ceil(F.col("c") / region_points), F.ceil(F.col("s") / region_shingles)).alias("chunks")
    # A chunk's worth of pivots at a time: their copies are as many rows as the region has.
    limit = F.greatest(F.lit(1), F.floor(F.col("c") / F.col("chunks"))).alias("limit")
    shape = sizes.select("region", "c", chunks).select("region", "chunks", limit)
    deal = F.pmod(F.xxhash64("id", F.lit("deal")), F.col("chunks")).alias("chunk")
    dealt = materialise(points.join(shape, "region").select("region", deal, "chunks", "id", "data"), "large-points")
    ids = dealt.select("region", "id").distinct()
    label, done, level = None, None, 0
    while True:
        now = ids.withColumn("root", F.col("id")) if label is None else ids.join(
            label.select(F.col("u").alias("id"), F.col("v").alias("r")), "id", "left") \
            .select("region", "id", F.coalesce("r", "id").alias("root"))
        counts = now.groupBy("region", "root").agg(F.count(F.lit(1)).alias("c"))
        largest = counts.groupBy("region").agg(F.max(F.struct("c", F.negate("root").alias("neg"))).alias("m")) \
            .select("region", F.negate("m.neg").alias("main"))
        outside = now.join(largest, "region").where("root <> main").select("region", "id")
        if done is not None:
            outside = outside.join(done, ["region", "id"], "left_anti")
        left = outside.groupBy("region").agg(F.count(F.lit(1)).alias("open"), F.min("id").alias("least")).join(shape, "region")
        most = F.col("limit") if level >= levels else F.least("limit", F.lit(PIVOTS * 16 ** level))
        chosen = outside.join(left, "region").where(
            (F.col("id") == F.col("least")) | (hash_u32(f"pivot{level}", F.col("id")) * F.col("open") < most * F.lit(2.0 ** 32)))
        pivots = materialise(chosen.select("region", "id"), "pivots")
        if pivots.isEmpty():
            edges = materialise(now.where("root <> id").select(F.col("id").alias("u"), F.col("root").alias("v")), "links")
            drop_scratch(spark, dealt, *([] if label is None else [label]))
            return edges
        met = materialise(_meet(dealt, pivots), "links")
        roots = components(met if label is None else met.unionByName(label))
        before, label = label, materialise(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).where("u <> v"), "labels")
        drop_scratch(spark, met, *([] if before is None else [before]))
        done, level = pivots if done is None else done.unionByName(pivots), level + 1


def links(points: DataFrame, region_points: int = REGION_POINTS, region_shingles: int = REGION_SHINGLES,
          levels: int = LEVELS) -> DataFrame:
    """Edges (u, v) that connect exactly the components of the links inside each region."""
    counts = points.groupBy("region").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).where("c > 1")
    large = counts.where((F.col("c") > region_points) | (F.col("s") > region_shingles) & (F.col("c") > 2))
    sizes = materialise(large, "large-regions")
    some = not sizes.isEmpty()
    small = points.join(counts.select("region"), "region", "left_semi")
    if some:
        small = small.join(sizes, "region", "left_anti")
    found = materialise(_join_in_tasks(small), "links")
    return found.unionByName(_swept(points, sizes, region_points, region_shingles, levels)) if some else found


def id_links(usable: DataFrame, groups: DataFrame) -> DataFrame:
    """Edges (u, v) between the representatives of the sets of one id, for ids with more than one
    set: each to the smallest."""
    pairs = usable.select("id", "set_id").distinct()
    several = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id")
    held = materialise(pairs.join(several, "id", "left_semi"), "shared-ids")
    reps = materialise(attach_by_key(held, groups, "set_id", "copies").select("id", "rep"), "shared-reps")
    least = reps.groupBy("id").agg(F.min("rep").alias("v"))
    return reps.join(least, "id").where("rep <> v").select(F.col("rep").alias("u"), "v").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       region_points: int = REGION_POINTS, region_shingles: int = REGION_SHINGLES,
                       levels: int = LEVELS) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``."""
    docs = _text(docs, id_col, text_col)
    rows = materialise(described(docs, frequent_shingles(docs)), "shingled")
    usable = rows.where("n > 0 and id is not null")
    groups = materialise(usable.groupBy("set_id").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "sets")
    tokens = tokens_of(usable, groups.select(F.col("rep").alias("id")))
    near = candidates(tokens, usable)
    regions = materialise(components(near).select(F.col("node").alias("id"), F.col("root").alias("region")), "regions")
    points = materialise(sets_of(docs, regions), "points")
    # Rows of one id are one node: its sets are linked, and all carry the smallest of its component.
    linked = links(points, region_points, region_shingles, levels).unionByName(id_links(usable, groups))
    found = materialise(components(linked), "components")
    facts = materialise(groups.select("set_id", "rep", "copies").join(
        found.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .select("set_id", "copies", F.coalesce("root", "rep").alias("component_id")), "set-components")
    named = attach_by_key(usable.select("id", "n", "set_id"), facts, "set_id", "copies")
    alone = rows.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    drop_scratch(docs.sparkSession, points)
    return named.select("id", "n", "component_id").unionByName(alone) \
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document of the smallest id stays."""
    found = jaccard_components(docs)
    return keep_rows(docs, found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).distinct())


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
