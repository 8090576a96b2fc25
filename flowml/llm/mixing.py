"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are shuffled by a hash and laid end to end on a line of words, twice
over (a source is used at most twice); the line is cut into blocks of equal token count.
Slot ``i`` of the schedule maps the golden-ratio point ``frac(i * phi)`` through the
cumulative target weights to a source; slots are ranked within their source, and the slot of
rank ``r`` takes block ``r``. Consecutive slots follow the weights closely everywhere, and
the count of a source's slots is off its share by a few slots whatever the length.

Nothing is ordered in one task: ranks and offsets are running sums in two levels (totals per
chunk, then inside a chunk), so a source that holds a third of all words is split.

Defined results: null text has size 0; documents of size 0 and sources without words take
part with target and taken 0; a null source is a source of its own, last in order; rows that
repeat an id are separate documents; an empty table gives no rows; the shuffle depends on id
and seed only, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from flowml.functions.hashing import hash_u32
from flowml.llm.common import WORD_RUN, table
from flowml.session import materialise

PASSES = 2
SHARE = 1.5
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 64
SLOT_CHUNK = 1 << 16
#: Fractional part of the golden ratio.
GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RUN)), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(row, id, skey, size, h): one row per document, written once so row numbers are fixed."""
    skey = F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))
    rows = docs.select(F.col(id_col).alias("id"), skey.alias("skey"),
                       word_count(F.col(text_col)).alias("size"), hash_u32(seed, F.coalesce(
                           F.col(id_col).cast("string"), F.lit("null"))).alias("h"))
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = PASSES) -> DataFrame:
    """(skey, source_size, weight, target): weights repeat over the sources in code point
    order (null last), targets share ``share`` times all words by weight and stop at ``cap``
    times a source's size; the excess is shared again by weight until none is above.

    One row per source. Each round of sharing is one aggregate that returns two numbers.
    """
    per = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy((F.col("skey") == "n").asc(), "skey")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (nth % len(weights) + 1).cast("int"))
    per = materialise(per.select("skey", "source_size", weight.alias("weight"),
                                 (F.col("source_size") * cap).alias("limit")), "mix-sources")
    total = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.col("limit") <= F.col("weight") * level
        n, fixed, free = per.agg(F.count_if(over), F.sum(F.when(over, F.col("limit")).otherwise(0.0)),
                                 F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if n == capped or not free:
            break
        level, capped = (total - fixed) / free, n
    return per.select("skey", "source_size", "weight",
                      F.least("limit", F.col("weight") * level).alias("target"))


def schedule(goal: DataFrame, n_slots: int, chunk: int = SLOT_CHUNK) -> DataFrame:
    """(slot, skey, rank): the source of each slot and the slot's rank within its source.

    ``goal``: (skey, target). Points find their source by an equi-join on cells of the unit
    interval (about four per source), not by a range join.
    """
    spark = goal.sparkSession
    order = Window.orderBy((F.col("skey") == "n").asc(), "skey")
    total = F.sum("target").over(Window.partitionBy())
    hi = F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, 0))
    cells = 1 << max(6, math.ceil(math.log2(4 * max(goal.count(), 1))))
    spans = (goal.where("target > 0").select("skey", ((hi - F.col("target")) / total).alias("lo"), (hi / total).alias("hi"))
             .withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells),
                                                      F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1))))))
    # frac(i * phi), split so that precision holds for many slots.
    low, high = F.col("slot") % (1 << 20), F.floor(F.col("slot") / (1 << 20))
    step = math.fmod((1 << 20) * GOLDEN, 1.0)
    point = F.pmod(low * F.lit(GOLDEN) + F.pmod(high * F.lit(step), F.lit(1.0)), F.lit(1.0))
    slots = (spark.range(n_slots).select(F.col("id").alias("slot"))
             .withColumn("u", point).withColumn("cell", F.floor(F.col("u") * cells)))
    drawn = materialise(
        slots.join(spans, "cell").where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
        .select("slot", "skey", F.floor(F.col("slot") / chunk).alias("chunk")), "mix-slots")
    counts = drawn.groupBy("skey", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("skey").orderBy("chunk")) - F.col("n")
    offsets = counts.select("skey", "chunk", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("skey", "chunk").orderBy("slot")) - 1
    return (drawn.withColumn("in_chunk", rank).join(offsets, ["skey", "chunk"])
            .select("slot", "skey", (F.col("before") + F.col("in_chunk")).alias("rank")))


def line_up(sizes: DataFrame, bucket_bits: int = 12) -> DataFrame:
    """Adds ``start``: the words before a document on its source's shuffled line."""
    bucketed = sizes.where("size > 0").withColumn("bucket", F.shiftright("h", 32 - bucket_bits))
    sums = bucketed.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("skey").orderBy("bucket")) - F.col("words")
    inner = F.sum("size").over(Window.partitionBy("skey", "bucket").orderBy("h", "id", "row")
                               .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return (bucketed.withColumn("inner", inner)
            .join(sums.select("skey", "bucket", before.alias("before")), ["skey", "bucket"])
            .select("row", "skey", "size", (F.col("before") + F.col("inner")).alias("start")))


def mix(sizes: DataFrame, goal: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix itself: (slot, skey, row, pass, from_word, to_word), the words of each
    document that each slot takes. ``sizes`` as of ``sized``, ``goal`` as of ``targets``."""
    total = goal.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    drawn = schedule(goal, math.ceil(total / block))
    line = line_up(sizes).join(goal.select("skey", "source_size"), "skey")
    unrolled = line.withColumn("pass", F.explode(F.array(*[F.lit(p) for p in range(PASSES)]))) \
        .withColumn("lo", F.col("start") + F.col("pass") * F.col("source_size"))
    last = F.floor((F.col("lo") + F.col("size") - 1) / block)
    pieces = unrolled.withColumn("rank", F.explode(F.sequence(F.floor(F.col("lo") / block), last)))
    first = F.greatest(F.col("rank") * block - F.col("lo"), F.lit(0))
    until = F.least((F.col("rank") + 1) * block - F.col("lo"), F.col("size"))
    return drawn.join(pieces, ["skey", "rank"]).select(
        "slot", "skey", "row", "pass", first.alias("from_word"), until.alias("to_word"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", seed: int = 17, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: (row, id, size, source_size, target, taken)."""
    sizes = sized(docs, id_col, text_col, source_col, seed)
    goal = materialise(targets(sizes), "mix-targets")
    taken = mix(sizes, goal, block).groupBy("row").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return (sizes.join(goal, "skey").join(taken, "row", "left")
            .select("row", "id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: a document appears as often as the mix takes it, in whole documents
    (the words taken, divided by its size, rounded half up: 0, 1 or 2 times)."""
    plan = mix_documents(docs).where("taken > 0")
    copies = plan.select(F.col("id").alias("__mix_id"),
                         F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("__copies")) \
        .where("__copies > 0").groupBy("__mix_id").agg(F.max("__copies").alias("__copies"))
    columns = docs.columns
    joined = docs.join(copies, docs["doc_id"].eqNullSafe(copies["__mix_id"]))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*columns)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8)) AS UBIGINT) AS h
  FROM documents),
per AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey),
w AS (SELECT skey, source_size, 2.0 * source_size AS cap,
             CAST([5, 2, 1][(row_number() OVER (ORDER BY skey = 'n', skey) - 1) % 3 + 1] AS DOUBLE) AS weight FROM per),
ranked AS (SELECT *, cap / weight AS ratio, row_number() OVER (ORDER BY cap / weight, skey) AS k, 1.5 * sum(source_size) OVER () AS total,
             coalesce(sum(cap) OVER (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
             sum(weight) OVER (ORDER BY cap / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
           FROM w),
lvl AS (SELECT arg_min((total - fixed) / free, k) AS level FROM ranked WHERE (total - fixed) / free <= ratio),
goal AS (SELECT skey, source_size, least(cap, weight * level) AS target FROM w, lvl),
cum AS (SELECT skey, (sum(target) OVER o - target) / sum(target) OVER () AS lo,
               sum(target) OVER o / sum(target) OVER () AS hi FROM goal
        WINDOW o AS (ORDER BY skey = 'n', skey ROWS UNBOUNDED PRECEDING)),
slots AS (SELECT i, ((i % 1048576) * 0.6180339887498949::DOUBLE
              + ((i // 1048576) * (1048576 * 0.6180339887498949::DOUBLE % 1.0)) % 1.0) % 1.0 AS u
          FROM range((SELECT CAST(ceil(sum(target) / 64) AS BIGINT) FROM goal)) r(i)),
n_slots AS (SELECT skey, count(*) AS m FROM slots JOIN cum ON u >= lo AND u < hi GROUP BY skey),
line AS (SELECT doc_id, skey, size,
           CAST(coalesce(sum(size) OVER (PARTITION BY skey ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
         FROM d)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(coalesce(m, 0) * 64, start + size) - start)
     + greatest(0, least(coalesce(m, 0) * 64, source_size + start + size) - source_size - start) AS BIGINT) AS taken
FROM line JOIN goal USING (skey) LEFT JOIN n_slots USING (skey)
"""
