"""Corpus pipeline: the stages from raw documents to packed training sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. All but the last return the
columns of ``documents``; the last returns the pieces of the packed sequences. ``run`` writes
each stage's result as Parquet in the shared scratch folder and reads it again for the next
one, so a lost executor costs part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowml.llm import exact_dedup, jaccard, mixing, packing, quality
from flowml.session import materialise

STAGES = [
    ("quality", quality.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", jaccard.stage),
    ("mix", mixing.stage),
    ("pack", packing.stage),
]

#: Shingle components, trained scores and subword ids cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
