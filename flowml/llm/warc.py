"""Resolution of not-modified revisits in web archive captures.

A revisit record stores no body: it stands for the latest earlier full response of the same
canonical URL, if its validators agree. The lookup is an as-of join: within a (URL, time
slice) a window carries the last response forward, and across slices a second window over
one row per (URL, slice) brings the response that was last before the slice. A URL that
holds a third of all captures is therefore spread over its slices.

A resolved revisit has the stored response's headers, updated by those headers of the
not-modified reply that may update them (RFC 9111 section 3.2: not the ones that describe a
body or one connection).

Defined results (``outcome``): ``resolved``; ``no_response`` when no earlier response exists
or the URL or time is null; ``mismatch`` when a validator that both sides have differs;
``unverified`` when there is none that both have (the response is still named, headers are
not merged). Equal times do not count as earlier; among responses at one time the largest id
is the latest. Null header maps count as empty. Repeated rows are resolved each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from flowml.llm.common import table
from flowml.session import materialise

# Headers that a not-modified reply does not update.
NOT_UPDATED = ("connection", "content-encoding", "content-length", "content-md5", "content-range",
               "content-type", "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer",
               "transfer-encoding", "upgrade")
# Query parameters that track a visit and do not name a page.
TRACKING = ("fbclid", "gclid", "ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.`` / ``m.`` host prefix, default port, fragment, tracking parameters and
    the last slash go; the host is lower case; the other parameters are sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^(www\.|m\.)|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(
        F.substring_index(p, "=", 1)).isin(*TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                    .otherwise(""))


def merge_headers(stored: Column, reply: Column) -> Column:
    """``stored`` updated by the permitted headers of ``reply``; names in lower case."""
    update = F.map_filter(reply, lambda k, v: ~k.isin(*NOT_UPDATED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(update), k)), update)


def resolve_revisits(captures: DataFrame, slices: int = 256) -> DataFrame:
    """``captures``: (record_id, kind 'response' | 'revisit', url, ts long, headers
    map<string,string> with lower-case names, payload string). One row per revisit:
    record_id, canonical_url, ts, response_id, response_ts, outcome, headers, payload.
    """
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = materialise(captures.select(
        "record_id", (F.col("kind") == "response").alias("full"), canonical_url(F.col("url")).alias("url"),
        "ts", F.coalesce("headers", empty).alias("headers"), "payload"), "captures")
    bounds = rows.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    first, last = bounds["a"] or 0, bounds["b"] or 0
    width = max(1, -(-(last - first + 1) // slices))
    usable = F.col("url").isNotNull() & F.col("ts").isNotNull()
    cut = rows.where(usable).withColumn("slice", F.floor((F.col("ts") - first) / width))
    response = F.when(F.col("full"), F.struct("ts", "record_id", "headers", "payload"))
    # At one time revisits come before responses: only an earlier response counts.
    here = Window.partitionBy("url", "slice").orderBy("ts", "full", "record_id") \
        .rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.withColumn("seen", F.last(response, ignorenulls=True).over(here)).where(~F.col("full"))
    ends = cut.where("full").groupBy("url", "slice").agg(
        F.max_by(F.struct("ts", "record_id", "headers", "payload"), F.struct("ts", "record_id")).alias("end"))
    # One row per (url, slice) that has a revisit or a response: what stood before the slice.
    places = cut.select("url", "slice").distinct().join(ends, ["url", "slice"], "left")
    until = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.select("url", "slice", F.last("end", ignorenulls=True).over(until).alias("carried"))
    found = inside.join(carried, ["url", "slice"]).withColumn("hit", F.coalesce("seen", "carried")) \
        .select("record_id", "url", "ts", "headers", "hit")
    lost = rows.where(~F.col("full") & ~usable).select(
        "record_id", "url", "ts", "headers", F.lit(None).cast(found.schema["hit"].dataType).alias("hit"))
    both = found.unionByName(lost)
    stored = F.col("hit.headers")
    pairs = [(F.element_at(stored, n), F.element_at("headers", n)) for n in ("etag", "last-modified")]
    differ = F.lit(False)
    agree = F.lit(False)
    for a, b in pairs:
        differ = differ | F.coalesce(a != b, F.lit(False))
        agree = agree | F.coalesce(a == b, F.lit(False))
    outcome = (F.when(F.col("hit").isNull(), "no_response").when(differ, "mismatch")
               .when(agree, "resolved").otherwise("unverified"))
    return both.withColumn("outcome", outcome).select(
        "record_id", F.col("url").alias("canonical_url"), "ts",
        F.col("hit.record_id").alias("response_id"), F.col("hit.ts").alias("response_ts"), "outcome",
        F.when(F.col("outcome") == "resolved", merge_headers(stored, F.col("headers")))
         .otherwise(F.col("headers")).alias("headers"),
        F.when(F.col("outcome") == "resolved", F.col("hit.payload")).alias("payload"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures derived from the whole pages table: each page is a full response, fetched at
    a time that follows from its id, and is asked for again later. The reply repeats the
    page's validators, except that every 11th has another entity tag (the page changed), each
    13th only a date, and each 17th no validator."""
    base = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("md5"),
                        F.length(F.coalesce("html", F.lit(""))).alias("n"))
    text = lambda c: F.col(c).cast("string")
    etag, when = F.concat(F.lit('"'), "md5", F.lit('"')), F.concat(F.lit("day "), text("page_id"))
    full = base.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url",
        (F.col("page_id") * 60).alias("ts"), F.create_map(
            F.lit("etag"), etag, F.lit("last-modified"), when, F.lit("content-length"), text("n"),
            F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-type"), F.lit("text/html")).alias("headers"),
        F.col("md5").alias("payload"))
    own = F.create_map(F.lit("cache-control"), F.lit("max-age=600"), F.lit("content-length"), F.lit("0"),
                       F.lit("date"), F.concat(F.lit("day "), (F.col("page_id") + 1).cast("string")))
    tag = F.when(F.col("page_id") % 11 == 0, F.lit('"changed"')).otherwise(etag)
    validators = (F.when(F.col("page_id") % 17 == 0, F.create_map(F.lit("vary"), F.lit("accept")))
                  .when(F.col("page_id") % 13 == 0, F.create_map(F.lit("last-modified"), when))
                  .otherwise(F.create_map(F.lit("etag"), tag)))
    again = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url",
        (F.col("page_id") * 60 + 3600 * (1 + F.col("page_id") % 50)).alias("ts"),
        F.map_concat(own, validators).alias("headers"), F.lit(None).cast("string").alias("payload"))
    return full.unionByName(again)


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(page_captures(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return resolved.withColumn("headers", F.array_join(lines, ";"))


_CANON = (r"(SELECT regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^(www\.|m\.)|:(80|443)$', '', 'g')"
          r" || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')"
          r" || CASE WHEN len(k) > 0 THEN '?' || array_to_string(k, '&') ELSE '' END FROM (SELECT b, list_sort(list_filter("
          r"string_split(regexp_extract(b, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT list_contains(["
          + ", ".join(f"'{t}'" for t in TRACKING)
          + r"], lower(split_part(p, '=', 1))))) AS k FROM (SELECT regexp_replace(regexp_replace(trim(url), '#.*$', ''),"
          r" '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b)))")

SQL = f"""
WITH p AS (SELECT page_id, {_CANON} AS canonical_url, md5(coalesce(html, '')) AS m,
                  length(coalesce(html, '')) AS n FROM pages),
f AS (SELECT page_id * 2 AS response_id, page_id, canonical_url AS u, page_id * 60 AS response_ts, m, n FROM p),
r AS (SELECT page_id, page_id * 2 + 1 AS record_id, canonical_url, m AS own,
             page_id * 60 + 3600 * (1 + page_id % 50) AS ts FROM p),
j AS (SELECT r.*, f.response_id, f.response_ts, f.m, f.n, f.page_id AS fid,
        row_number() OVER (PARTITION BY r.record_id ORDER BY f.response_ts DESC, f.response_id DESC) AS k
      FROM r LEFT JOIN f ON f.u = r.canonical_url AND f.response_ts < r.ts),
o AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
        WHEN page_id % 17 = 0 THEN 'unverified'
        WHEN page_id % 13 = 0 THEN CASE WHEN fid = page_id THEN 'resolved' ELSE 'mismatch' END
        WHEN page_id % 11 = 0 THEN 'mismatch'
        WHEN m = own THEN 'resolved' ELSE 'mismatch' END AS outcome FROM j WHERE k = 1)
SELECT record_id, canonical_url, ts, response_id, response_ts, outcome,
  CASE WHEN outcome = 'resolved' THEN
    'cache-control=max-age=600;content-length=' || n || ';content-type=text/html;date=day ' || (page_id + 1)
    || ';etag="' || m || '";last-modified=day ' || fid
  ELSE 'cache-control=max-age=600;content-length=0;date=day ' || (page_id + 1)
    || CASE WHEN page_id % 17 = 0 THEN ';vary=accept'
            WHEN page_id % 13 = 0 THEN ';last-modified=day ' || page_id
            WHEN page_id % 11 = 0 THEN ';etag="changed"' ELSE ';etag="' || own || '"' END END AS headers,
  CASE WHEN outcome = 'resolved' THEN m END AS payload
FROM o
"""
