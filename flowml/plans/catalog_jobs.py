"""Registered queries of the writing jobs: quarantine, restart-safe scoring, large vocabularies,
observed metrics and class-partitioned tables. Same rules as :mod:`flowml.plans.catalog`."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowml.operators import metrics, sampling
from flowml.plans import inputs as I
from flowml.plans.catalog import (_BAD, _CLASSES, _CSV_CHECK, _SMOTE_SQL, _UNDER_TARGETS, ORACLE, SEED, query, r6)
from flowml.session import materialise, scratch_path


# ----------------------------------------------------------------------------- A3, D1
_INT, _NUMBER = "'-?[0-9]+'", "'-?[0-9]+(\\.[0-9]+)?([eE]-?[0-9]+)?'"
_WRONG = "CASE " + " ".join(f"WHEN tok[{i}] <> '' AND NOT regexp_full_match(tok[{i}], {p}) THEN {i}"
                            for i, p in ((1, _INT), (2, _INT), (4, _NUMBER))) + " END"


@query("quarantine_lines", f"""
WITH t AS (SELECT line, string_split(line, ',') AS tok FROM ({I.CSV_LINES_SQL})),
c AS (SELECT *, len(tok) <> 4 AS uneven, {_WRONG} AS wrong FROM t),
d AS (SELECT *, NOT uneven AND wrong IS NULL AS accepted FROM c)
SELECT accepted,
  CASE WHEN accepted THEN CAST(NULLIF(tok[1], '') AS BIGINT) END AS event_id,
  CASE WHEN accepted THEN CAST(NULLIF(tok[2], '') AS INTEGER) END AS user_id,
  CASE WHEN accepted THEN CAST(NULLIF(tok[4], '') AS DOUBLE) END AS value,
  CASE WHEN NOT accepted THEN line END AS raw,
  CASE WHEN uneven THEN 'columns' WHEN wrong IS NOT NULL THEN 'type' END AS reason,
  CASE WHEN NOT uneven THEN ['event_id', 'user_id', 'event_type', 'value'][wrong] END AS field,
  CASE WHEN uneven THEN CAST(len(tok) AS VARCHAR) WHEN wrong IS NOT NULL THEN tok[wrong] END AS token
FROM d""")
def q_quarantine_lines(spark, sf):
    """Good and bad lines written in one job, then each side read from its partition."""
    from flowml.operators import quarantine as Q
    checked = Q.check_lines(I.csv_lines(I.table(spark, sf, "events")), I.CSV_DDL)
    path = Q.write_split(checked, scratch_path(spark, "split-lines"))
    good = Q.read_accepted(spark, path, checked.schema).select(
        F.lit(True).alias("accepted"), "event_id", "user_id", "value")
    bad = Q.read_quarantine(spark, path, checked.schema).withColumn("accepted", F.lit(False))
    return good.unionByName(bad, allowMissingColumns=True)


@query("quarantine_messages", f"""
SELECT event_id AS msg_id, reason IS NULL AS accepted, reason,
  CASE reason WHEN 'missing' THEN 'conn' WHEN 'type' THEN 'conn.id.orig_p' END AS field,
  CASE WHEN reason = 'type' THEN 'x5' END AS token,
  CASE WHEN reason IS NULL THEN CAST(user_id AS INTEGER) END AS sport,
  CASE WHEN reason IS NULL THEN value END AS dur
FROM (SELECT *, CASE WHEN event_id % 13 = 0 THEN 'not_json' WHEN event_id % 29 = 0 THEN 'missing'
                     WHEN event_id % 17 = 0 THEN 'type' END AS reason FROM events)""")
def q_quarantine_messages(spark, sf):
    from flowml.operators import quarantine as Q
    messages = I.conn_messages(I.table(spark, sf, "events"))
    checked = Q.check_messages(messages, passthrough=["msg_id"])
    path = Q.write_split(checked, scratch_path(spark, "split-messages"))
    good = Q.read_accepted(spark, path, checked.schema).select(
        "msg_id", F.lit(True).alias("accepted"), "sport", "dur")
    bad = Q.read_quarantine(spark, path, checked.schema, ["msg_id"]).drop("raw").withColumn("accepted", F.lit(False))
    return good.unionByName(bad, allowMissingColumns=True)


# ----------------------------------------------------------------------------- F1, F2
_PART = "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END"


@query("encode_by_table", f"""
WITH base AS (SELECT l_orderkey, l_linenumber, {_PART} AS part FROM lineitem),
v AS (SELECT part, row_number() OVER (ORDER BY count(*) DESC, part) - 1 AS i
      FROM base WHERE part IS NOT NULL GROUP BY part)
SELECT l_orderkey, l_linenumber, part, CAST(coalesce(i, (SELECT count(*) FROM v)) AS DOUBLE) AS part_index
FROM base LEFT JOIN v USING (part)""")
def q_encode_by_table(spark, sf):
    """Part numbers as a large vocabulary: many values, many ties, ranked over ranges."""
    from flowml.operators.vocabulary import encode_by_table, fit_vocabulary
    li = I.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 13 == 0, None).otherwise(F.col("l_partkey").cast("string")).alias("part"))
    return encode_by_table(li, "part", fit_vocabulary(li, "part"))


# ----------------------------------------------------------------------------- E
@query("observed_metrics", ORACLE["overall_metrics"])
def q_observed_metrics(spark, sf):
    """The overall metrics from counts taken while the predictions are written."""
    from flowml.operators.observed import write_observed
    preds = I.predictions(I.table(spark, sf, "events"))
    pairs = write_observed(preds, scratch_path(spark, "predictions"), _CLASSES)
    m = metrics.overall_from_pairs(pairs)
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns])


# ----------------------------------------------------------------------------- A2, B1, C11, G3, G4
@query("smote_by_class", _SMOTE_SQL + """
SELECT label, base_key, draw, neighbour_key, round(gap, 6) AS gap,
       list_transform(x, lambda v: round(v, 6)) AS x
FROM syn""")
def q_smote_by_class(spark, sf):
    """Oversampling from a table with a folder per class: the majority is never read."""
    from flowml.operators.smote import synthesize
    from flowml.sinks.classes import class_sizes, read_classes, write_classes
    path = write_classes(I.table(spark, sf, "embeddings"), scratch_path(spark, "by-class"), "label")
    # One row a class.
    sizes = {r["label"]: r["n"] for r in class_sizes(spark, path, "label").collect()}
    top = max(sizes.values())
    small = [c for c, n in sizes.items() if n < top]
    syn = synthesize(read_classes(spark, path, only=small), "label", "embedding", "vec_id", k=5, seed=SEED,
                     strategy={c: top for c in small})
    return syn.select("label", "base_key", "draw", "neighbour_key", r6(F.col("gap")).alias("gap"),
                      F.transform("_x", lambda v: F.round(v, 6)).alias("x"))


@query("undersample_by_class", ORACLE["undersample"])
def q_undersample_by_class(spark, sf):
    """Listed classes are read by folder and reduced; the others pass, read by folder too."""
    from flowml.sinks.classes import read_classes, write_classes
    ev = I.table(spark, sf, "events").select("event_id", "event_type")
    path = write_classes(ev, scratch_path(spark, "events-by-class"), "event_type")
    listed = list(_UNDER_TARGETS)
    less = sampling.undersample(read_classes(spark, path, only=listed), "event_type", _UNDER_TARGETS, "event_id", SEED)
    return less.unionByName(read_classes(spark, path, without=listed))


# ----------------------------------------------------------------------------- I1, I2, B2
@query("score_restart", f"""
SELECT event_id AS msg_id, NOT bad AS parse_ok,
  CASE WHEN bad OR event_id % 17 = 0 THEN 0 ELSE CAST(user_id AS INTEGER) END AS sport,
  1 AS copies, true AS same
FROM (SELECT *, {_BAD} AS bad FROM events)""")
def q_score_restart(spark, sf):
    """A scoring job stopped between a batch's alerts and its ledger entry, then started again
    from its checkpoint. ``copies``: how often a message's alert stands; ``same``: it equals the
    batch form of the job in every column."""
    from pyspark.errors import StreamingQueryException

    from flowml.operators.models import fit_flow_pipeline
    from flowml.sources.stream import message_stream
    from flowml.streaming.ledger import read_alerts, start_ledgered
    from flowml.streaming.scoring import score_messages
    events = I.table(spark, sf, "events")
    messages = materialise(I.conn_messages(events).repartition(6, "msg_id"), "messages")
    model = fit_flow_pipeline(I.flows_from_events(events), "zeek", "tree")
    folder = messages.inputFiles()[0].rsplit("/", 1)[0]
    stream = message_stream(spark, "parquet", path=folder, schema=messages.schema, maxFilesPerTrigger="1")
    alerts = score_messages(stream, model, passthrough=["msg_id"])
    path = scratch_path(spark, "ledgered")

    def stop_in_third(batch):
        if batch == 2:
            raise RuntimeError("stopped before the ledger entry")

    args = {"checkpoint": f"{path}-ckpt", "trigger": {"availableNow": True}}
    try:
        start_ledgered(alerts, path, after_write=stop_in_third, **args).awaitTermination()
    except StreamingQueryException as e:
        if "stopped before the ledger entry" not in str(e):
            raise
    start_ledgered(alerts, path, **args).awaitTermination()
    got = read_alerts(spark, path).drop("batch")
    want = score_messages(messages, model, passthrough=["msg_id"])
    cols = [c for c in want.columns if c != "msg_id"]
    one = got.groupBy("msg_id").agg(F.count(F.lit(1)).cast("int").alias("copies"),
                                    F.first(F.struct(*cols)).alias("got"))
    return want.join(one, "msg_id", "left").select(
        "msg_id", "parse_ok", "sport", "copies", F.struct(*cols).eqNullSafe(F.col("got")).alias("same"))
