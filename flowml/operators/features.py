"""Feature engineering (F1-F4): categorical encoding and vector assembly.

Encoding uses one multi-column ``StringIndexer``: a single distributed
count-by-value pass for all columns (map-side combined; only the vocabularies,
bounded by the number of distinct categories, reach the driver), and a JVM-side
lookup at transform time. Order is frequency-descending with alphabetical ties;
nulls are not counted and, like unseen values, map to ``len(labels)``
(``handleInvalid="keep"``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowml.schema import PROFILES, Profile


def index_col(col: str) -> str:
    return f"{col}_index"


def encoder(cols: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """F1 estimator (unfitted), for use inside a Pipeline."""
    return StringIndexer(inputCols=list(cols), outputCols=[index_col(c) for c in cols],
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def fit_encoders(df: DataFrame, cols: Sequence[str], handle_invalid: str = "keep") -> StringIndexerModel:
    """fit all categorical columns in one pass."""
    return encoder(cols, handle_invalid).fit(df)


def encode(df: DataFrame, model: StringIndexerModel, skip_missing: bool = True) -> DataFrame:
    """F2 + F3: apply fitted encoders; null and unseen values -> ``len(labels)``.

    An input column absent from ``df`` is skipped when ``skip_missing`` (the
    streaming job encodes a label column that live messages do not carry);
    otherwise it is an error.
    """
    missing = [c for c in model.getInputCols() if c not in df.columns]
    if missing and not skip_missing:
        raise ValueError(f"encoder input columns missing: {missing}")
    if not missing:
        return model.transform(df)
    present = [(c, o, labels) for c, o, labels in
               zip(model.getInputCols(), model.getOutputCols(), model.labelsArray)
               if c in df.columns]
    if not present:
        return df
    sub = StringIndexerModel.from_arrays_of_labels(
        [p[2] for p in present], inputCols=[p[0] for p in present],
        outputCols=[p[1] for p in present], handleInvalid=model.getHandleInvalid())
    return sub.transform(df)


def assembler(cols: Sequence[str], out: str = "features", on_null: str = "error") -> VectorAssembler:
    """F4 transformer. ``on_null``: "error" (fail), "skip" (drop row), "keep" (NaN)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=on_null)


def assemble(df: DataFrame, profile: str | Profile | Sequence[str] = "zeek", out: str = "features",
             on_null: str = "error", categorical: bool = True) -> DataFrame:
    """numeric and encoded columns -> one ML vector column.

    ``categorical``: encoded columns keep their nominal attributes, so tree learners split
    them by sets of categories; ``False`` makes them plain numbers, as they are in a table
    read back from CSV.
    """
    if isinstance(profile, str):
        cols = list(PROFILES[profile].vector)
    elif isinstance(profile, Profile):
        cols = list(profile.vector)
    else:
        cols = list(profile)
    if not categorical:
        df = df.withColumns({c: F.col(c).alias(c, metadata={}) for c in cols})
    return assembler(cols, out, on_null).transform(df)


def vector_as_array(df: DataFrame, col: str = "features", out: str | None = None) -> DataFrame:
    """Vector -> array<double> (comparable, Parquet/CSV friendly)."""
    return df.withColumn(out or col, vector_to_array(F.col(col)))
