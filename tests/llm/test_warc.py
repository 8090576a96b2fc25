import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowml.llm import warc

SCHEMA = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("kind", T.StringType()),
                       T.StructField("url", T.StringType()), T.StructField("ts", T.LongType()),
                       T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
                       T.StructField("payload", T.StringType()), T.StructField("slice", T.StringType()),
                       T.StructField("full", T.StringType())])


def caps(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("url,want", [
    ("HTTPS://www.Example.COM:443/a/?utm_source=x&b=2&a=1#top", "example.com/a?a=1&b=2"),
    ("http://m.example.com/a?ref=x", "example.com/a"), ("http://example.com", "example.com"),
    ("example.com/?q=", "example.com?q="), ("", ""), (None, None)])
def test_canonical_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0] == want


def test_outcomes_and_merged_headers(spark):
    page = {"etag": "1", "content-length": "9", "cache-control": "a"}
    got = {r.record_id: r for r in warc.resolve_revisits(caps(spark, [
        (1, "response", "http://e.com/p", 10, page, "one"), (2, "response", "https://www.e.com/p/", 20, {**page, "etag": "2"}, "two"),
        (3, "revisit", "http://e.com/p", 15, {"etag": "1", "content-length": "0", "cache-control": "b", "date": "d"}, None),
        (4, "revisit", "http://e.com/p", 20, {"etag": "1"}, None),      # the response at 20 is not earlier
        (5, "revisit", "http://e.com/p", 99, {"etag": "1"}, None),      # the latest has another tag
        (6, "revisit", "http://e.com/p", 5, {"etag": "1"}, None), (7, "revisit", "http://e.com/p", 99, None, None),
        (8, "revisit", None, 99, None, None), (9, "revisit", "http://e.com/p", None, None, None),
        (3, "revisit", "http://e.com/p", 15, {"etag": "1"}, None)])).collect() if r.record_id != 3 or "date" in r.headers}
    assert {k: (r.outcome, r.response_id) for k, r in got.items()} == {
        3: ("resolved", 1), 4: ("resolved", 1), 5: ("mismatch", 2), 6: ("no_response", None),
        7: ("unverified", 2), 8: ("no_response", None), 9: ("no_response", None)}
    assert got[3].headers == {"etag": "1", "content-length": "9", "cache-control": "b", "date": "d"} and got[3].payload == "one"


def test_hot_url_matches_brute_force(spark):
    rows = []
    for i in range(600):
        url = "http://hot.com/" if i % 3 else f"http://e.com/{i % 7}"
        kind = "response" if i * 7 % 5 < 2 else "revisit"
        rows.append((i, kind, url, i * 13 % 311, {"etag": "t"}, str(i) if kind == "response" else None))
    got = {r.record_id: r.response_id for r in warc.resolve_revisits(caps(spark, rows), slices=16).collect()}
    for i, kind, url, ts, _, _ in rows:
        if kind == "revisit":
            early = [(t, j) for j, k, u, t, _, _ in rows if k == "response" and u == url and t < ts]
            assert got[i] == (max(early)[1] if early else None)


def test_empty_table(spark):
    assert warc.resolve_revisits(caps(spark, [])).collect() == []
