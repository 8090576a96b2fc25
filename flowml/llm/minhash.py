"""Near-duplicate documents by MinHash: many universal hash minima, bands, verified signatures.

1. A document is the set of its 4-word shingles; equal sets are one point. Its *signature* is
   the minimum of the set under each of 288 hash functions x -> (a x + b) >> 32 modulo 2**64
   (strongly universal on 32-bit keys). The minima are cut into 48 bands of 6; points with the
   same minima in a band share a *bucket*. One byte of every minimum is kept to compare points.
2. Two points are a candidate only if their signatures agree in ``LEAST`` places, and a link only
   if their full sets do: 100 * intersection >= 80 * union in integers. At a similarity of 0.8
   a pair shares no bucket with probability 5e-7 and agrees in too few places with 1e-7, and
   both fall fast above it.
3. Components come from alternating large-star and small-star steps.

No bucket is paired up. First every point meets its bucket's *centre* only, the point nearest to
the most frequent byte of each place; the best pairs of every point are verified, and copies of
one text, even millions, become one component. Buckets that still hold several components are
then compared across components: the points outside the bucket's largest one against all, as
long as their best candidates bring new links, then once more with all candidates. A bucket
too large for a task is split by a second band if it holds no large component, or else goes block
by block, so no size is left out and no pair is skipped.

Defined results: null text, and text without words, is the empty set, linked with nothing; a
text of fewer than four words has its whole sequence as its one shingle; a row with a null id is
linked with nothing, has a null component and is not kept; rows that repeat an id are one node,
and each carries its component (and is kept if the id is); an empty table gives no rows; other columns are
ignored. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowml.llm.common import IdBits, attach_by_key, gathered, sorted_groups, table
from flowml.llm.graph import components
from flowml.llm.jaccard import id_links, may_link, shingles, sketch
from flowml.session import drop_scratch, materialise

WORDS = 4
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 80
BANDS, ROWS = 48, 6
PLACES = BANDS * ROWS
#: Places in which the signatures of a candidate agree: five standard deviations below the mean of a pair at the threshold.
LEAST = 195
#: Points of a bucket that one task compares; points that one pivot is verified with at a time.
LIST_POINTS, PIVOT_POINTS = 4_096, 512
#: Buckets up to this size are compared whole at once.
FEW = 16
_SLICE = 1 << 18


def _hash_family() -> tuple[np.ndarray, np.ndarray]:
    a = [xxhash.xxh3_64_intdigest(f"factor {i}") | 1 for i in range(PLACES)]
    b = [xxhash.xxh3_64_intdigest(f"offset {i}") for i in range(PLACES)]
    return np.array(a, np.uint64), np.array(b, np.uint64)


def minima(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of a set (64-bit hashes, of which 32 bits are keys) under every function."""
    keys = found & np.uint64(0xFFFFFFFF)
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, _SLICE // len(a))
    with np.errstate(over="ignore"):
        for at in range(0, len(keys), step):
            np.minimum(out, (keys[at:at + step, None] * a + b).min(axis=0), out=out)
    return out >> np.uint64(32)


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key of every band's minima."""
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for part in least.reshape(BANDS, ROWS).T:
            h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def described(docs: DataFrame) -> DataFrame:
    """(id, n, set_id, sign, bands, sketch) of (id, text) documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _hash_family()
        for batch in batches:
            sizes, sets, signs, bands, sketches = [], [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), WORDS)
                sizes.append(len(found))
                least = minima(found, a, b) if len(found) else None
                sets.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signs.append(least.astype(np.uint8).tobytes() if len(found) else None)
                bands.append(band_keys(least) if len(found) else None)
                sketches.append(sketch(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()),
                 pa.array(signs, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["id", "n", "set_id", "sign", "bands", "sketch"])

    return docs.mapInArrow(run, "id long, n long, set_id binary, sign binary, bands array<long>, sketch binary")


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PLACES)


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many places the signatures agree (rows of x by rows of y)."""
    out = np.empty((len(x), len(y)), np.int16)
    step = max(1, (1 << 24) // max(1, len(y) * PLACES))
    for at in range(0, len(x), step):
        out[at:at + step] = (x[at:at + step, None] == y[None]).sum(-1, dtype=np.int16)
    return out


def centre(signs: np.ndarray) -> int:
    """The position of the point that agrees best with the most frequent byte of every place."""
    flat = signs + np.arange(PLACES, dtype=np.int64) * 256
    usual = np.bincount(flat.ravel(), minlength=PLACES * 256).reshape(PLACES, 256).argmax(axis=1)
    return int((signs == usual).sum(-1).argmax())


def shared_buckets(points: DataFrame) -> DataFrame:
    """(s, u, c): the points u of every bucket s of c > 1 points. Of buckets with the same points
    one stays."""
    spark = points.sparkSession
    tokens = materialise(points.select(F.explode("bands").alias("s"), "u"), "band-tokens")
    facts = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("u")).alias("x"),
                                    F.bit_xor(F.xxhash64("u", F.lit(1))).alias("y")).where("c > 1")
    once = materialise(facts.groupBy("c", "x", "y").agg(F.min("s").alias("s")).select("s", "c"), "buckets")
    # Most tokens are alone in their bucket: they are left out where they lie, before the join.
    held = materialise(IdBits(once, "s").rows(tokens, "s"), "held-tokens")
    lists = materialise(attach_by_key(held, once, "s", "c").select("s", "u", "c"), "bucket-points")
    drop_scratch(spark, tokens, held)
    return lists


def _in_tasks(rows: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over each group of equal ``part``; a task holds one group at a time."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def all_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(out for group in sorted_groups(batches, "part") for out in run(group))

    return rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(all_groups, schema)


def part_centres(lists: DataFrame, signs: DataFrame, size: int, few: int = FEW) -> DataFrame:
    """(s, u, v, near, c): every point u of the buckets (s, u, c) with the point v it is compared
    with, and in how many places they agree.

    Buckets are dealt to parts of about ``size`` points. In a part of up to ``few`` points v
    is the best partner of u, in others the part's centre (which is paired with itself).
    """
    chunk = F.pmod(F.xxhash64("u", F.lit("deal")), F.ceil(F.col("c") / F.lit(size)))
    dealt = lists.join(signs, "u").select(F.xxhash64("s", chunk).alias("part"), "s", "u", "c", "sign")

    def run(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        u, sign = group.column("u").to_numpy(), _signs(group.column("sign"))
        if 1 < len(u) <= few:
            near = agreement(sign, sign)
            np.fill_diagonal(near, -1)
            v = near.argmax(axis=1)
            near = near[np.arange(len(u)), v]
        else:
            mid = centre(sign)
            v, near = np.full(len(u), mid), (sign == sign[mid]).sum(-1)
        yield pa.RecordBatch.from_arrays(
            [group.column("s"), group.column("u"), pa.array(u[v]), pa.array(near, pa.int64()), group.column("c")],
            names=["s", "u", "v", "near", "c"])

    return materialise(_in_tasks(dealt, run, "s long, u long, v long, near long, c long"), "centres")


def hubs(met: DataFrame, signs: DataFrame, size: int) -> DataFrame:
    """(s, hub) of the buckets that were dealt to several parts: the centre of their parts' centres,
    level by level."""
    top = materialise(met.where(F.col("c") > size).select("s", F.col("v").alias("u")).distinct(), "part-centres")
    while True:
        counts = materialise(top.groupBy("s").agg(F.count(F.lit(1)).alias("c")), "centre-counts")
        if not counts.where("c > 1").head(1):
            return top.withColumnRenamed("u", "hub")
        again = materialise(attach_by_key(top, counts, "s", "c").select("s", "u", "c"), "centre-lists")
        top = materialise(part_centres(again, signs, size, 0).select("s", F.col("v").alias("u")).distinct(), "part-centres")


def nearest_centres(lists: DataFrame, signs: DataFrame, size: int = LIST_POINTS) -> DataFrame:
    """Candidates (u, v): each point with the partner it agrees best with, the one in its largest
    bucket, and the hub of that bucket where it was dealt to several parts."""
    met = part_centres(lists, signs, size)
    found = met.where((F.col("u") != F.col("v")) & (F.col("near") >= LEAST))
    picks = found.groupBy("u").agg(F.max(F.struct("near", "v"))["v"].alias("best"),
                                   F.max(F.struct("c", "near", "v"))["v"].alias("widest"))
    pairs = picks.select("u", F.explode(F.array("best", "widest")).alias("v"))
    if met.where(F.col("c") > size).head(1):
        large = lists.where(F.col("c") > size)
        sizes = materialise(hubs(met, signs, size).join(large.select("s", "c").distinct(), "s"), "hubs")
        wide = attach_by_key(large.select("s", "u"), sizes, "s", "c")
        pairs = pairs.unionByName(wide.groupBy("u").agg(F.max(F.struct("c", "hub"))["hub"].alias("v")))
    return pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def mixed_buckets(lists: DataFrame, labels: DataFrame) -> DataFrame | None:
    """(s, u, g, c, main, most): the points of buckets that hold several components g, with the
    bucket's size, its largest component and that one's size; None if there are none."""
    named = materialise(lists.select("s", "u").join(labels, "u", "left")
                        .select("s", "u", F.coalesce("root", "u").alias("g")), "named")
    facts = materialise(
        named.groupBy("s", "g").agg(F.count(F.lit(1)).alias("n")).groupBy("s").agg(
            F.sum("n").alias("c"), F.count(F.lit(1)).alias("gs"), F.max(F.struct("n", "g"))["g"].alias("main"),
            F.max("n").alias("most")).where("gs > 1").drop("gs"), "mixed")
    out = materialise(attach_by_key(named, facts, "s", "c"), "mixed-points") if facts.head(1) else None
    drop_scratch(lists.sparkSession, named)
    return out


def second_bands(large: DataFrame, bands: DataFrame) -> DataFrame:
    """(s, u): the buckets split by every other band: a link shares some second bucket as it
    shares the first, what shares one by chance or by a common passage seldom does."""
    return materialise(large.select("s", "u").join(bands.select("u", F.explode("bands").alias("s2")), "u")
                       .where("s <> s2").select(F.xxhash64("s", "s2").alias("s"), "u"), "second-bands")


def across(mixed: DataFrame, labels: DataFrame, signs: DataFrame, bands: DataFrame, size: int, best: bool,
           level: int = 0) -> DataFrame:
    """Candidates (u, v) of different components that share a bucket.

    The points outside the bucket's largest component, in blocks, meet all its points, in
    blocks. A pair is a candidate if the signatures agree in ``LEAST`` places and the sketches
    (an exact bound) allow a link. ``best``: of the candidates of a point only the best, and the best in the
    largest component.
    """
    # Points that share a bucket by chance or by a common passage are of many components; a bucket
    # with one large component is a family, which a second band would not split.
    large = (F.col("c") > size) & (2 * F.col("most") < F.col("c"))
    rest = None
    if level == 0 and mixed.where(large).head(1):
        inner = mixed_buckets(second_bands(mixed.where(large), bands), labels)
        rest = None if inner is None else across(inner, labels, signs, bands, size, best, 1)
        mixed = mixed.where(~large)
    few = F.ceil((F.col("c") - F.col("most")) / F.lit(size))
    all_ = F.ceil(F.col("c") / F.lit(size))
    mixed = mixed.join(signs, "u")
    carried = ["u", "g", "main", "sign", "n", "sketch"]
    left = mixed.where(F.col("g") != F.col("main")).select(
        "s", F.pmod(F.xxhash64("u", F.lit("few")), few).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), all_ - 1)).alias("j"), F.lit(0).alias("side"), *carried)
    right = mixed.select(
        "s", F.explode(F.sequence(F.lit(0).cast("long"), few - 1)).alias("i"),
        F.pmod(F.xxhash64("u", F.lit("all")), all_).alias("j"), F.lit(1).alias("side"), *carried)

    def run(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        side, u, g, main, n = (group.column(c).to_numpy() for c in ("side", "u", "g", "main", "n"))
        sign, sketches = _signs(group.column("sign")), group.column("sketch").to_pylist()
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        step = max(1, (1 << 22) // max(1, len(b)))
        for at in range(0, len(a), step):
            mine = a[at:at + step]
            near = agreement(sign[mine], sign[b])
            i, j = np.nonzero((near >= LEAST) & (g[mine][:, None] != g[b][None]))
            keep = allowed(sketches, n, mine[i], b[j])
            i, j = i[keep], j[keep]
            if best:
                pick = []
                for chosen in (np.arange(len(i)), np.flatnonzero(g[b[j]] == main[0])):
                    order = chosen[np.lexsort((u[b[j[chosen]]], -near[i[chosen], j[chosen]], i[chosen]))]
                    pick.append(order[np.concatenate([[True], np.diff(i[order]) != 0])[:len(order)]])
                pick = np.unique(np.concatenate(pick))
                i, j = i[pick], j[pick]
            x, y = u[mine][i], u[b][j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["u", "v"])

    both = left.unionByName(right).select(F.xxhash64("s", "i", "j").alias("part"), "side", *carried)
    found = _in_tasks(both, run, "u long, v long").distinct()
    return found if rest is None else found.unionByName(rest).distinct()


def allowed(sketches: list[bytes], n: np.ndarray, x: np.ndarray, y: np.ndarray, step: int = 8_192) -> np.ndarray:
    """May the sets at x and y be linked? (Sketches bound their difference from below.)"""
    out = np.zeros(len(x), bool)
    for at in range(0, len(x), step):
        i, j = x[at:at + step], y[at:at + step]
        one, two = (np.frombuffer(b"".join(map(sketches.__getitem__, k.tolist())), np.uint8).reshape(len(k), -1)
                    .astype(np.int16) for k in (i, j))
        out[at:at + step] = may_link(np.abs(one - two).sum(1, dtype=np.int64), n[i], n[j])
    return out


def verified(docs: DataFrame, pairs: DataFrame, size: int = PIVOT_POINTS) -> DataFrame:
    """The pairs (u, v) of ``pairs`` whose full sets are linked.

    Every point of a pair is sent to its partner's chunk of pairs: a pivot that many points
    are paired with is copied to as many chunks, each of bounded size.
    """
    ids = materialise(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct(), "members")
    bits = IdBits(ids)
    words = bits.words

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(IdBits.mask(words.value, batch.column(2)))
            found = [shingles(t.as_py(), WORDS).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "data"])

    held = docs.where(F.col("id").isNotNull()).select("id", "text", bits.hashed("id").alias("hashed")) \
        .mapInArrow(made, "id long, data binary").where("length(data) > 0")
    # Rows that repeat an id and a text are one.
    sets = materialise(held.withColumn("same", F.xxhash64("data")).dropDuplicates(["id", "same"]).drop("same"), "sets")
    # The point with more pairs is the pivot.
    degree = pairs.select(F.explode(F.array("u", "v")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("d"))
    ranked = materialise(pairs.join(degree.select(F.col("id").alias("u"), F.col("d").alias("du")), "u")
                         .join(degree.select(F.col("id").alias("v"), F.col("d").alias("dv")), "v"), "ranked-pairs")
    swap = F.col("du") > F.col("dv")
    turned = ranked.select(F.when(swap, F.col("v")).otherwise(F.col("u")).alias("x"),
                           F.when(swap, F.col("u")).otherwise(F.col("v")).alias("p"))
    chunks = turned.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("k"), F.count(F.lit(1)).alias("d"))
    chunks = materialise(chunks, "pivots")
    placed = attach_by_key(materialise(turned, "turned-pairs"), chunks, "p", "d")
    members = placed.select("p", F.pmod(F.xxhash64("x"), F.col("k")).alias("chunk"), F.col("x").alias("id")) \
        .join(sets, "id").select(F.xxhash64("p", "chunk").alias("part"), F.lit(1).alias("side"), "id", "data")
    pivots = chunks.select(F.col("p").alias("id"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("chunk")) \
        .join(sets, "id").select(F.xxhash64("id", "chunk").alias("part"), F.lit(0).alias("side"), "id", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pivot, held = None, None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for at, side, point, data in zip(*(batch.column(i) for i in range(4))):
                mine = np.frombuffer(data.as_py(), np.uint64)
                if (at.as_py(), 0) == (part, side.as_py()):
                    held.append(mine)                      # an id with several sets
                elif side.as_py() == 0:
                    part, pivot, held = at.as_py(), point.as_py(), [mine]
                elif at.as_py() == part and any(linked(p, mine) for p in held):
                    out.append((pivot, point.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([min(o) for o in out], pa.int64()),
                                              pa.array([max(o) for o in out], pa.int64())], names=["u", "v"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = members.unionByName(pivots).repartition(parts, "part").sortWithinPartitions("part", "side", "id")
    links = materialise(both.mapInArrow(run, "u long, v long").distinct(), "links")
    drop_scratch(docs.sparkSession, sets)
    return links


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Are two sorted sets within the threshold?"""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = LIST_POINTS) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    rows = materialise(described(docs), "minhashed")
    usable = rows.where("n > 0 and id is not null")
    groups = materialise(usable.groupBy("set_id").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"),
        *[F.first(c).alias(c) for c in ("n", "sign", "bands", "sketch")]), "sets")
    # Signatures, bands and sketches are kept once a set; the documents keep their set's name.
    slim = materialise(rows.select("id", "n", "set_id"), "document-sets")
    drop_scratch(docs.sparkSession, rows)
    rows, usable = slim, slim.where("n > 0 and id is not null")
    points = groups.select(F.col("rep").alias("u"), "bands")
    signs, bands = groups.select(F.col("rep").alias("u"), "sign", "n", "sketch"), points
    lists = shared_buckets(points)
    # The joins below need the points that share a bucket, a small part as a rule: the others stay where they lie.
    signs = materialise(IdBits(lists.select("u").distinct(), "u").rows(signs, "u"), "bucket-signs")
    tested = materialise(nearest_centres(lists, signs.select("u", "sign"), size), "centre-pairs")
    links, best = verified(docs, tested), True
    while True:
        labels = materialise(components(links).select(F.col("node").alias("u"), "root"), "labels")
        lists = mixed_buckets(lists, labels)
        if lists is None:
            break
        # Best candidates as long as they bring links, so that components grow together; then all.
        more = materialise(across(lists, labels, signs, bands, size, best)
                           .join(tested, ["u", "v"], "left_anti"), "cross-pairs")
        found = verified(docs, more)
        links, tested = links.unionByName(found), tested.unionByName(more)
        if not best:
            break
        best = bool(found.head(1))
    # Rows of one id are one node: its sets are linked, and all carry the smallest of its component.
    names = groups.select("set_id", "rep", "copies")
    found = materialise(components(links.unionByName(id_links(usable, names))), "components")
    facts = materialise(names.join(found.select(F.col("node").alias("rep"), "root"), "rep", "left")
                        .select("set_id", "copies", F.coalesce("root", "rep").alias("component_id")), "set-components")
    named = attach_by_key(usable.select("id", "n", "set_id"), facts, "set_id", "copies").select("id", "n", "component_id")
    alone = rows.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    return named.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
