"""Secret scan with corpus-wide ownership frequency.

Fixed base patterns (assignments, access keys, long hex runs) give spans; every candidate
value, and every long mixed-alphabet token besides, is hashed (of ``name=value`` the value), and
the hashes are counted over the whole corpus by distinct repositories and owners. A value that many owners hold is
a widely copied example; a token held by few owners that looks random is reported as an
extra span of kind ``live``.

Positions come from built-in functions only: ``split`` gives the gaps between the matches
of a pattern, ``regexp_extract_all`` the matches, and a running sum of their lengths (code
points) the offsets. No Python runs on the executors.

Defined results: null text counts as empty; a document without spans has counts 0, an empty
span list and the SHA-256 of the empty string; a null repository or owner counts as one
unnamed owner; rows that repeat an id are scanned and returned separately; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from flowml.llm.common import attach_by_key, table
from flowml.session import materialise


@dataclass(frozen=True)
class Kind:
    """A pattern, the capture group that holds the secret, and the least length of it."""
    name: str
    pattern: str
    group: int
    least: int


# The base kinds, in the order in which equal starts are listed.
BASE_KINDS = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
#: Long tokens, whatever stands around them; the corpus decides which are reported.
TOKEN_KIND = Kind("live", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", 0, 20)
KINDS = (*BASE_KINDS, TOKEN_KIND)


def _matches(text: Column, index: int, kind: Kind) -> Column:
    """array<struct<kind, gap, len, vlen, value>> of the leftmost non-overlapping matches."""
    pattern = F.lit(kind.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else whole
    gaps = F.slice(F.split(text, kind.pattern, -1), 1, F.size(whole))
    found = F.transform(F.arrays_zip(gaps.alias("g"), whole.alias("w"), values.alias("v")),
                        lambda m: F.struct(
                            F.lit(index).alias("kind"), F.length(m["g"]).alias("gap"),
                            F.length(m["w"]).alias("len"), F.length(m["v"]).alias("vlen"),
                            m["v"].alias("value")))
    none = F.array().cast("array<struct<kind:int,gap:int,len:int,vlen:int,value:string>>")
    # One pass decides for the many documents that hold no match at all.
    return F.when(text.rlike(kind.pattern), found).otherwise(none)


def _looks_random(value: Column) -> Column:
    """Lower case or upper case letters and digits, at least ten different characters, and
    not a plain word: what a generated credential looks like."""
    chars = F.array_distinct(F.split(value, ""))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(chars) >= 10)


def _held(token: Column) -> Column:
    """The value of a token ``name=value`` (padding stays), and any other token whole. A ``/``
    before the last ``=`` makes it a path."""
    stem = F.rtrim(token, F.lit("="))
    value = F.concat(F.substring_index(stem, "=", -1), F.substring(token, F.length(stem) + 1, F.length(token)))
    name = F.substring(token, F.lit(1), F.length(token) - F.length(value))
    return F.when((F.length(stem) == 0) | name.contains("/"), token).otherwise(value)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         repository: Column | None = None, owner: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(row, id) of every row of ``docs``, and one row per candidate match: row, id, repository,
    owner, kind, start, end, value hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(repository if repository is not None else F.lit(""), F.lit("")).alias("repository"),
                       F.coalesce(owner if owner is not None else F.lit(""), F.lit("")).alias("owner"),
                       text.alias("text"))
    found = rows.select("id", "repository", "owner", F.concat(
        *[_matches(F.col("text"), i, k) for i, k in enumerate(KINDS)]).alias("m"))
    # Written once: the row numbers are then fixed, whatever is computed again later.
    found = materialise(found.withColumn("row", F.monotonically_increasing_id()), "secret-matches")
    each = found.select("row", "id", "repository", "owner", F.posexplode("m").alias("n", "x"))
    order = Window.partitionBy("row", "x.kind").orderBy("n")
    end = F.sum(F.col("x.gap") + F.col("x.len")).over(order)
    placed = each.select("row", "id", "repository", "owner", F.col("x.kind").alias("kind"),
                         (end - F.col("x.len")).alias("start"), end.alias("end"),
                         F.col("x.vlen").alias("vlen"), F.col("x.value").alias("value"))
    least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), F.col("kind") + 1)
    passed = placed.where(F.col("vlen") >= least)
    held = F.when(F.col("kind") == len(BASE_KINDS), _held(F.col("value"))).otherwise(F.col("value"))
    return found.select("row", "id"), passed.select(
        "row", "id", "repository", "owner", "kind", "start", "end",
        F.sha2(held, 256).alias("hash"), _looks_random(F.col("value")).alias("random"))


def ownership(candidates: DataFrame) -> DataFrame:
    """Per candidate hash: matches, distinct repositories and distinct owners.

    Counted in steps (hash, repository, owner), then by hash, so a value that a third of
    all documents share is reduced before each shuffle.
    """
    held = candidates.groupBy("hash", "repository", "owner").agg(F.count(F.lit(1)).alias("n"))
    return held.groupBy("hash").agg(
        F.sum("n").alias("n_matches"), F.countDistinct("repository", "owner").alias("n_repositories"),
        F.countDistinct("owner").alias("n_owners"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 repository: Column | None = None, owner: Column | None = None,
                 copied_owners: int = 3) -> DataFrame:
    """Spans per row of ``docs``: array<struct<start, kind, end, name, hash, n_owners, copied>>.

    ``copied_owners``: a value that so many distinct owners hold is a copied example; base
    spans stay whatever their frequency, with ``copied`` beside them.
    """
    rows, candidates = scan(docs, id_col, text_col, repository, owner)
    candidates = materialise(candidates, "secret-candidates")
    facts = materialise(ownership(candidates), "secret-owners")
    known = attach_by_key(candidates, facts, "hash", "n_matches")
    copied = F.col("n_owners") >= copied_owners
    token = len(BASE_KINDS)
    chosen = known.where((F.col("kind") < token) | (F.col("random") & ~copied))
    name = F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), F.col("kind") + 1)
    spans = chosen.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", name.alias("name"), "hash", "n_repositories", "n_owners",
        copied.alias("copied")))).alias("spans"))
    return rows.join(spans, "row", "left").select(F.col("id").alias(id_col), F.coalesce(
        "spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its owner; a repository is the part of a source in one language."""
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k.name}") for i, k in enumerate(BASE_KINDS)],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"))
