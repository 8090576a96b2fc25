"""Categorical encoding for vocabularies of any size (F1, F2): a table, not a list.

``features.fit_encoders`` brings all labels to the driver and keeps them in the model; this form
keeps them in a table. Ranks by (frequency descending, value ascending) come without a sort in
one task: values are range-partitioned by that order, ranked inside their range, and shifted by
the number of values in the ranges before (one row a range on the driver). Values are unique
in that order, so ranges are even however many values share a frequency.

Results equal the fitted encoder's: the most frequent value is 0, null and unseen values get
the number of values. Ties are in the order of the UTF-8 bytes.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowml.operators.features import index_col
from flowml.operators.sampling import literal_table
from flowml.operators.skew import attach
from flowml.session import drop_scratch, materialise

# Values of one range: the rows a task ranks.
RANGE_VALUES = 1_000_000


def fit_vocabulary(df: DataFrame, col: str, range_values: int = RANGE_VALUES) -> DataFrame:
    """(value string, n long, index long), one row per non-null value of ``col``."""
    spark = df.sparkSession
    counts = materialise(df.where(F.col(col).isNotNull())
                         .groupBy(F.col(col).cast("string").alias("value"))
                         .agg(F.count(F.lit(1)).alias("n")), "vocabulary-counts")
    ranges = max(1, -(-counts.count() // range_values))
    ranged = materialise(counts.repartitionByRange(ranges, F.desc("n"), F.asc("value"))
                         .withColumn("_range", F.spark_partition_id()), "vocabulary-ranges")
    sizes = sorted(tuple(r) for r in ranged.groupBy("_range").count().collect())
    starts = accumulate([0, *[n for _, n in sizes[:-1]]])
    offsets = literal_table(spark, "_range int, _start long", [(r, s) for (r, _), s in zip(sizes, starts)])
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(F.desc("n"), "value"))
    # One row a range: V / range_values rows.
    out = materialise(ranged.withColumn("_rank", rank).join(F.broadcast(offsets), "_range")
                      .select("value", "n", (F.col("_start") + F.col("_rank") - 1).alias("index")), "vocabulary")
    drop_scratch(spark, counts, ranged)
    return out


def encode_by_table(df: DataFrame, col: str, vocabulary: DataFrame, out: str | None = None) -> DataFrame:
    """``df`` with the index of ``col`` (double). Hot values are attached where their rows
    are, the rest by a shuffled join. ``df`` is read twice: pass a stored table."""
    out = out or index_col(col)
    size = vocabulary.count()
    facts = vocabulary.select(F.col("value").alias("_value"), "n", "index") \
        .withColumnsRenamed({"n": "_n", "index": "_index"})
    rows = df.withColumn("_value", F.col(col).cast("string"))
    joined = attach(rows, facts, ["_value"], "_n", how="left")
    index = F.coalesce(F.col("_index"), F.lit(size)).cast("double")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], index.alias(out))
