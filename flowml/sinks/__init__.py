"""Sinks and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowml.session import shuffles_dropped


def write_encoded(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """B1: write an encoded table (CSV with header by default, or Parquet).

    Each task writes its own part file; nothing goes through the driver.
    """
    writer = df.write.mode(mode)
    with shuffles_dropped(df.sparkSession):
        if fmt == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.format(fmt).save(path)
    return path


def preview(df: DataFrame, key: str | list[str], n: int = 25) -> DataFrame:
    """The first ``n`` rows in key order (a top-n; Spark plans TakeOrderedAndProject)."""
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*[F.col(k) for k in keys]).limit(n)


def schema_string(df: DataFrame) -> str:
    """The tree form of ``printSchema`` as a string."""
    return df.schema.treeString() if hasattr(df.schema, "treeString") else df._jdf.schema().treeString()  # noqa: SLF001
