"""Fixtures shared by the tests of the training-data operators."""

import pytest
from pyspark.sql import types as T

#: Columns of documents plus names that operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(n, T.StringType()) for n in ("id", "row", "digest", "keep_id", "n", "region", "skey", "size",
                                                 "h", "block", "score", "spans", "hash")]])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, lang[, source]]) as a table with extra columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
                 len(r[1] or ""), *["x"] * 13) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and blank texts, repeated rows, one very long text."""
    return make_docs([
        (1, "a b c d e f g"), (2, None), (3, ""), (4, "  \n "), (5, "a b c d e f g"), (5, "a b c d e f g"),
        (None, "x y z"), (6, "long " * 60_000 + "end"), (7, "A  b\tc d e f g", None, None), (8, "one"),
        (9, "one", "fr", None)])
