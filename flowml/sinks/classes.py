"""Class-partitioned flow tables (A2, B1, C11): one folder a class, read by pruning.

Balancing touches few rows of a table whose majority class is most of it. With a folder per class,
``read_classes`` opens the folders asked for only, and ``class_sizes`` reads the label alone.
The folder is named by a column of its own; the label stays in the rows with its type, null and
empty labels included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLASS_PART = "class_part"


def _part(label: Column) -> Column:
    """Folder name of a label: ``v`` and its text, ``n`` for null."""
    return F.when(label.isNull(), "n").otherwise(F.concat(F.lit("v"), label.cast("string")))


def write_classes(df: DataFrame, path: str, label: str, mode: str = "overwrite") -> str:
    """B1 by class. A task writes one file a class it meets; nothing is shuffled."""
    df.withColumn(CLASS_PART, _part(F.col(label))).write.mode(mode).partitionBy(CLASS_PART).parquet(path)
    return path


def read_classes(spark: SparkSession, path: str, only: Sequence | None = None,
                 without: Sequence | None = None) -> DataFrame:
    """The rows of the classes ``only``, or of all but ``without``; a null label is ``None``.
    Labels are given with the type they have in the table."""
    # Folder names start with a letter, so they are read as text whatever the label's type.
    df = spark.read.parquet(path)
    for classes, keep in ((only, True), (without, False)):
        if classes is not None:
            hit = F.col(CLASS_PART).isin(*[_part(F.lit(c)) for c in classes]) if classes else F.lit(False)
            df = df.where(hit if keep else ~hit)
    return df.drop(CLASS_PART)


def class_sizes(spark: SparkSession, path: str, label: str) -> DataFrame:
    """E4 over the folders: (label, n); only the label column is read."""
    return spark.read.parquet(path).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
