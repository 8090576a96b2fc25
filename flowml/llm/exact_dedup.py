"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the normalised text.
A batch is reduced to one row per digest (partial aggregation, so a digest held by a third
of all rows is summed before the shuffle), sort-merge anti-joined to the index, and the
unseen digests are appended. The index side of that join is read bucket by bucket without
a shuffle, so the cost of a batch follows the batch and one scan of the 40-byte index rows.
The number of buckets is stored beside the index. One writer at a time: two that append the
same digest at once would both find it unseen.

Defined results: null text counts as empty; an empty table gives no rows and leaves the
index as it was; rows that repeat one id are one document and get the same decision; a null
id never wins against another id; other columns of the input are ignored. Presenting a
document again gives the same decision (the row it matches in the index is its own), so a
batch can be retried. As a stage: of rows with equal texts exactly one stays, the first of
the smallest id, also where rows repeat an id with the same or with another text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowml.llm.common import SPACE_RUN, attach_by_key, table
from flowml.session import materialise, scratch_path


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with each run of ASCII white space made one space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " "), 256))


class DigestIndex:
    """Persistent index (digest, keep_id), bucketed and sorted by digest, at ``path``.

    Opening an existing path registers it again under a session-local name. Its number of
    buckets is read from the note beside it; another number given in ``buckets`` is refused.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        note = f"{path.rstrip('/')}.buckets"
        there, old = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (note, path))
        files = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(there):
            stored = int(spark.read.text(note).first()[0])
            if buckets not in (None, stored):
                raise ValueError(f"the index at {path} has {stored} buckets, not {buckets}")
            buckets = stored
        elif files.exists(old) and buckets is None:
            raise ValueError(f"the index at {path} has no note of its buckets; name their number")
        else:
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1, numPartitions=1).select(F.lit(str(buckets))).write.text(note)
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def compact(self) -> DigestIndex:
        """The same index with one sorted file a bucket, at a new path: each batch adds a file to
        every bucket, and a bucket of several files is sorted again when it is read."""
        new = DigestIndex(self.spark, f"{self.path.rstrip('/')}-{uuid.uuid4().hex[:8]}", self.buckets)
        new._append(self.read())
        return new

    def close(self) -> None:
        """Forget the session's name of the index; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _append(self, rows: DataFrame) -> None:
        rows.select("digest", "keep_id").repartition(self.buckets, "digest").sortWithinPartitions("digest") \
            .write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def ingest(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Add a batch; return (id, keep_id, group_size, kept, digest) for each of its rows.

        ``keep_id``: the indexed id of that text; for a text new to the index the smallest
        id of the batch. ``group_size``: rows of the batch with that text.
        """
        digests = materialise(docs.select(F.col(id_col).cast("long").alias("id"),
                                          text_digest(F.col(text_col)).alias("digest")), "digests")
        groups = materialise(digests.groupBy("digest").agg(
            F.min("id").alias("first_id"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
        fresh = groups.join(self.read().hint("merge"), "digest", "left_anti")
        self._append(fresh.withColumnRenamed("first_id", "keep_id"))
        facts = materialise(groups.drop("first_id").join(self.read().hint("merge"), "digest"),
                            "digest-facts")
        return attach_by_key(digests, facts, "digest", "group_size").select(
            F.col("id").alias(id_col), "keep_id", "group_size",
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                index_path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Decisions for one batch against the index at ``index_path`` (a new one by default)."""
    spark = docs.sparkSession
    index = DigestIndex(spark, index_path or scratch_path(spark, "digest-index"), buckets)
    decided = index.ingest(docs, id_col, text_col)
    index.close()
    return decided


def deduplicate_in_batches(docs: DataFrame, batches: int, id_col: str = "doc_id", text_col: str = "text",
                           index_path: str | None = None) -> DataFrame:
    """The decisions of :func:`deduplicate` for a table that arrives in ``batches`` ranges of ids, in
    order, each deduplicated against the index of those before it.

    Ids grow from batch to batch, so the first id of a text is its smallest; null ids come
    last. ``group_size`` counts the text in all batches.
    """
    spark = docs.sparkSession
    index = DigestIndex(spark, index_path or scratch_path(spark, "digest-index"))
    ids = F.col(id_col).cast("long")
    low, high = docs.agg(F.min(ids), F.max(ids)).first()
    cuts = [] if low is None else [low + (high - low + 1) * i // batches for i in range(1, batches)]
    decided = None
    for start, end in zip([None, *cuts], [*cuts, None]):
        part = docs if start is None else docs.where((ids >= start) | ids.isNull()) if end is None else docs.where(ids >= start)
        part = part if end is None else part.where(ids < end)
        part = materialise(index.ingest(part, id_col, text_col), "decided")
        decided = part if decided is None else decided.unionByName(part)
    index.close()
    sizes = materialise(decided.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size")), "digest-sizes")
    return attach_by_key(decided.drop("group_size"), sizes, "digest", "group_size")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of equal texts stays.

    It is the row whose id the index keeps for that text; of several rows with that id and
    that text the first by its values.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keep = materialise(deduplicate(docs).where("kept").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("__n"))
                       .withColumnRenamed("doc_id", "__id").withColumnRenamed("digest", "__kept"), "kept-ids")
    named = docs.withColumn("__digest", text_digest(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept"))
    once = named.join(keep.where("__n = 1"), same, "left_semi").select(*columns)
    repeated = keep.where("__n > 1")
    if not repeated.head(1):
        return once
    # Rows that repeat an id and a text: one of them, picked by partial aggregation.
    one = named.join(repeated, same, "left_semi").groupBy("__digest").agg(F.min(F.struct(*columns)).alias("__row"))
    return once.unionByName(one.select("__row.*"))


#: Batches in which the query's table reaches the index.
BATCHES = 2


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_in_batches(table(spark, sf_dir, "documents"), BATCHES).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""
