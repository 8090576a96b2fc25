"""Splitting and sampling.

All draws come from :mod:`flowml.functions.hashing`, i.e. they are a pure function
of (seed, row key). Results therefore do not depend on partitioning, retries or
executor loss, unlike ``randomSplit``/``sample`` which depend on partition layout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowml.functions.hashing import hash_u32, hash_uniform

# Width of the first-level hash histogram used for exact per-group top-n.
HIST_BITS = 16


def split_index(key: str | Column, weights: Sequence[float], seed) -> Column:
    """Index of the split a row falls into, from normalised cumulative weights."""
    total = float(sum(weights))
    u = hash_uniform(seed, F.col(key) if isinstance(key, str) else key)
    expr, acc = None, 0.0
    for i, w in enumerate(weights[:-1]):
        acc += w / total
        cond = u < F.lit(acc)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    last = F.lit(len(weights) - 1)
    return last if expr is None else expr.otherwise(last)


def hash_split(df: DataFrame, key: str, weights: Sequence[float] = (0.7, 0.3),
               seed=1234) -> list[DataFrame]:
    """G1: disjoint, complete, reproducible split by a hash of ``key``.

    Each part is a filter on the same scan (no shuffle). Persist the input first
    if several parts are consumed by expensive jobs.
    """
    idx = split_index(key, weights, seed)
    return [df.filter(idx == F.lit(i)) for i in range(len(weights))]


def with_split(df: DataFrame, key: str, weights: Sequence[float] = (0.7, 0.3), seed=1234,
               out: str = "split") -> DataFrame:
    """G1 as a column (0 = first part, ...)."""
    return df.withColumn(out, split_index(key, weights, seed))


def sample_class(df: DataFrame, label: str, value, fraction: float, key: str,
                 seed=1234) -> DataFrame:
    """Keep a hash-chosen ``fraction`` of one class (other classes dropped)."""
    keep = hash_uniform(seed, F.col(key)) < F.lit(float(fraction))
    return df.filter((F.col(label) == F.lit(value)) & keep)


def literal_table(spark, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A small table of literals, planned inside the JVM (no Python-backed scan)."""
    fields = T.StructType.fromDDL(schema).fields
    empty = F.array().cast(T.ArrayType(T.StructType(fields)))
    made = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)])
                     for r in rows]) if rows else empty
    return spark.range(1, numPartitions=1).select(F.explode(made).alias("r")).select("r.*")


def rank_flag(df: DataFrame, group: str, quotas: DataFrame, key: str, seed,
              out: str = "below", quota_col: str = "quota") -> DataFrame:
    """Adds ``out``: is the row's rank by (hash(key), key) in its group below the group's quota?

    Exact, and safe when one group holds a large share of all rows: instead of a
    window over the whole group (one task per group), a histogram of the top
    ``HIST_BITS`` hash bits per group (partial aggregation, bounded output) locates
    the single boundary bucket; the other rows are decided by a comparison, and only the
    boundary bucket (expected size group/65536) is ranked with a window. No row is joined
    to another: the cut table (one row per group) is broadcast.
    Groups absent from ``quotas`` are below. ``quotas`` is bounded by the number of groups.
    """
    h = (df.withColumn("_u", hash_u32(seed, F.col(key)))
         .withColumn("_b", F.shiftright(F.col("_u"), 32 - HIST_BITS)))
    hist = h.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    q = quotas.select(F.col(group), F.col(quota_col).cast("long").alias("_quota"))
    w = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = (hist.join(F.broadcast(q), group)
           .withColumn("_cum", F.sum("_cnt").over(w)))
    cut = (cum.filter(F.col("_cum") >= F.col("_quota"))
           .groupBy(group)
           .agg(F.min(F.struct("_b", "_cum", "_cnt", "_quota")).alias("s"))
           .select(group, F.col("s._b").alias("_bstar"),
                   (F.col("s._quota") - (F.col("s._cum") - F.col("s._cnt"))).alias("_need")))
    # The cut table has at most one row per group: compute it once and ship it to
    # both branches below as a broadcast instead of re-running the histogram.
    group_type = df.schema[group].dataType.simpleString()
    cut = literal_table(df.sparkSession, f"`{group}` {group_type}, _bstar long, _need long",
                        [tuple(r) for r in cut.collect()])
    joined = h.join(F.broadcast(cut), group, "left")
    at_edge = F.coalesce(F.col("_b") == F.col("_bstar"), F.lit(False))
    sure = joined.filter(~at_edge).withColumn(out, F.col("_bstar").isNull() | (F.col("_b") < F.col("_bstar")))
    edge_w = Window.partitionBy(group).orderBy("_u", key)
    edge = joined.filter(at_edge).withColumn(out, F.row_number().over(edge_w) <= F.col("_need"))
    return sure.unionByName(edge).drop("_u", "_b", "_bstar", "_need")


def rank_below(df: DataFrame, group: str, quotas: DataFrame, key: str, seed,
               quota_col: str = "quota") -> DataFrame:
    """Rows whose rank by (hash(key), key) inside their group is below the group's quota."""
    return rank_flag(df, group, quotas, key, seed, "_below", quota_col).filter("_below").drop("_below")


def undersample(df: DataFrame, label: str, targets: Mapping, key: str, seed=1234) -> DataFrame:
    """Reduce listed classes to a target count (hash-chosen, exact); others untouched."""
    spark = df.sparkSession
    label_type = df.schema[label].dataType.simpleString()
    quotas = literal_table(spark, f"`{label}` {label_type}, quota long",
                           [(k, int(v)) for k, v in targets.items()])
    return rank_below(df, label, quotas, key, seed)


def union_flows(a: DataFrame, b: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name (column order may differ)."""
    return a.unionByName(b, allowMissingColumns=allow_missing)
