"""Registered queries: one per operator of the inventory, each with its SQL oracle.

Every query reads the driver's tables (whole tables, no subsets) and returns a
lazy DataFrame. Queries that must materialise an intermediate (a CSV round trip,
a saved model, a stream sink) write it under the session's shared checkpoint
folder. Doubles that are computed (not copied) are rounded to 6 digits on both
sides of the oracle comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowml.functions.hashing import sql_hash_u32, sql_hash_uniform
from flowml.functions.messages import conn_to_flow, wrap_message
from flowml.operators import clean, features, metrics, sampling
from flowml.plans import inputs as I
from flowml.session import drop_scratch, materialise, scratch_dropped, scratch_path
from flowml.sinks import preview, write_encoded
from flowml.sources.flows import parse_csv_strict, read_encoded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SEED = 1234


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ----------------------------------------------------------------------------- A, B
_CSV_CHECK = r"""
WITH t AS (SELECT line, string_split(line, ',') AS tok FROM ({lines}))
SELECT {select} FROM t
WHERE {cond}
"""
_CSV_GOOD = ("len(tok) = 4 AND (tok[1] = '' OR regexp_full_match(tok[1], '-?[0-9]+')) "
             "AND (tok[2] = '' OR regexp_full_match(tok[2], '-?[0-9]+')) "
             "AND (tok[4] = '' OR regexp_full_match(tok[4], '-?[0-9]+(\\.[0-9]+)?([eE]-?[0-9]+)?'))")


@query("csv_strict", _CSV_CHECK.format(
    lines=I.CSV_LINES_SQL,
    select=("CAST(NULLIF(tok[1], '') AS BIGINT) AS event_id, "
            "CAST(NULLIF(tok[2], '') AS INTEGER) AS user_id, NULLIF(tok[3], '') AS event_type, "
            "CAST(NULLIF(tok[4], '') AS DOUBLE) AS value"),
    cond=_CSV_GOOD))
def q_csv_strict(spark, sf):
    good, _ = parse_csv_strict(I.csv_lines(I.table(spark, sf, "events")), I.CSV_DDL)
    return good


@query("csv_strict_rejects", _CSV_CHECK.format(lines=I.CSV_LINES_SQL, select="line",
                                               cond=f"NOT ({_CSV_GOOD})"))
def q_csv_rejects(spark, sf):
    _, bad = parse_csv_strict(I.csv_lines(I.table(spark, sf, "events")), I.CSV_DDL)
    return bad


_ENC_COLS = "l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax"


@query("encoded_roundtrip", f"SELECT {_ENC_COLS} FROM lineitem")
def q_encoded_roundtrip(spark, sf):
    li = I.table(spark, sf, "lineitem").select(*[c.strip() for c in _ENC_COLS.split(",")])
    path = write_encoded(li, scratch_path(spark, "encoded"), fmt="csv")
    ddl = ("l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
           "l_discount double, l_tax double")
    return read_encoded(spark, path, ddl, header=True)


@query("preview_25", "SELECT * FROM events ORDER BY event_id LIMIT 25")
def q_preview(spark, sf):
    return preview(I.table(spark, sf, "events"), "event_id", 25)


# ----------------------------------------------------------------------------- C
@query("drop_columns",
       "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem")
def q_drop_columns(spark, sf):
    drop = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
            "no_such_column"]
    return clean.drop_columns(I.table(spark, sf, "lineitem"), drop)


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_RAW_OK = "event_id % 101 <> 0"      # the others have a hex port: malformed
_RAW_SERVICE = "CASE event_id % 3 WHEN 0 THEN 'http' WHEN 1 THEN 'dns' ELSE '-' END"
_RAW_STATE = "CASE WHEN event_id % 4 = 0 THEN 'CON' ELSE 'FIN' END"
_RAW_ATTACK = ("CASE WHEN value < 5 THEN 'Generic' WHEN value < 20 THEN ' Fuzzers' "
               "WHEN value < 40 THEN 'Backdoors' WHEN value < 60 THEN 'Reconnaissance' END")


@query("apply_profile", f"""
SELECT CAST(user_id AS INTEGER) AS sport, {_K} AS dsport, event_type AS proto,
       {_RAW_STATE} AS state, value AS dur, CAST(event_id AS INTEGER) AS sbytes,
       CAST(event_id % 1000 AS INTEGER) AS dbytes, CAST(event_id % 64 AS INTEGER) AS sttl,
       0 AS dttl, CAST(event_id % 5 AS INTEGER) AS sloss, 0 AS dloss, {_RAW_SERVICE} AS service,
       value * 2 AS "Sload", 0.0::DOUBLE AS "Dload", CAST(user_id % 7 + 1 AS INTEGER) AS "Spkts",
       CAST({_K} % 5 AS INTEGER) AS "Dpkts", {_RAW_ATTACK} AS attack_cat,
       CASE WHEN value < 60 THEN 1 ELSE 0 END AS label
FROM events WHERE {_RAW_OK}""")
def q_apply_profile(spark, sf):
    return clean.apply_profile(_raw_flows(spark, sf), "argus")


def _raw_flows(spark, sf):
    from flowml.schema import RAW_FLOW_DDL
    raw, _ = parse_csv_strict(I.raw_flow_lines(I.table(spark, sf, "events")), RAW_FLOW_DDL)
    return clean.canonicalise(raw, "attack_cat")


def _index_sql(name: str, expr: str, where: str) -> str:
    """Code table of an encoder: (v, i) by falling count, equal counts by value."""
    return (f"{name} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS i FROM "
            f"(SELECT {expr} AS v, count(*) AS n FROM events WHERE {where} GROUP BY 1) WHERE v IS NOT NULL)")


@query("argus_features", f"""
WITH {_index_sql("pr", "event_type", _RAW_OK)}, {_index_sql("st", _RAW_STATE, _RAW_OK)},
{_index_sql("se", _RAW_SERVICE, _RAW_OK)}
SELECT CAST(event_id AS INTEGER) AS sbytes,
  [CAST(user_id AS DOUBLE), {_K}, coalesce(pr.i, (SELECT count(*) FROM pr)), st.i, value, event_id,
   event_id % 1000, se.i, event_id % 64, 0, event_id % 5, 0, value * 2, 0, user_id % 7 + 1, {_K} % 5] AS features
FROM events LEFT JOIN pr ON pr.v = event_type LEFT JOIN st ON st.v = {_RAW_STATE}
LEFT JOIN se ON se.v = {_RAW_SERVICE} WHERE {_RAW_OK}""")
def q_argus_features(spark, sf):
    from flowml.schema import PROFILES
    flows = clean.apply_profile(_raw_flows(spark, sf), "argus")
    enc = features.encode(flows, features.fit_encoders(flows, list(PROFILES["argus"].strings)))
    wide = features.assemble(enc, "argus", categorical=False)
    return features.vector_as_array(wide.select("sbytes", "features"))


@query("parse_messages", I.PARSED_MESSAGES_SQL)
def q_parse_messages(spark, sf):
    msgs = I.conn_messages(I.table(spark, sf, "events"))
    cols = ["srcip", "sport", "dstip", "dsport", "proto", "dur", "sbytes", "dbytes", "service",
            "Spkts", "Dpkts", "tunnel_parents"]
    return conn_to_flow(msgs, cols, passthrough=["msg_id"], keep_parse_flag=True)


@query("fill_numeric", f"""
SELECT event_id, coalesce(user_id, 0) AS user_id, event_type, coalesce(value, 0.0) AS value, props
FROM ({I.EVENTS_WITH_NULLS_SQL})""")
def q_fill_numeric(spark, sf):
    return clean.fill_numeric(I.events_with_nulls(I.table(spark, sf, "events")), 0)


@query("fill_strings", f"""
SELECT event_id, user_id, coalesce(event_type, 'No ataque') AS event_type, value, props
FROM ({I.EVENTS_WITH_NULLS_SQL})""")
def q_fill_strings(spark, sf):
    return clean.fill_strings(I.events_with_nulls(I.table(spark, sf, "events")), "No ataque")


def _sql_map(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {col} END"


@query("canonicalise", f"""
SELECT event_id, {_sql_map('attack_cat', I.EVENT_CANONICAL)} AS attack_cat
FROM ({I.DIRTY_LABELS_SQL})""")
def q_canonicalise(spark, sf):
    return clean.canonicalise(I.dirty_labels(I.table(spark, sf, "events")), "attack_cat",
                              I.EVENT_CANONICAL)


@query("distinct_labels", f"""
SELECT DISTINCT {_sql_map('attack_cat', I.EVENT_CANONICAL)} AS attack_cat
FROM ({I.DIRTY_LABELS_SQL})""")
def q_distinct_labels(spark, sf):
    canon = clean.canonicalise(I.dirty_labels(I.table(spark, sf, "events")), "attack_cat",
                               I.EVENT_CANONICAL)
    return metrics.distinct_values(canon, "attack_cat")


def _decode_sql() -> str:
    from flowml.schema import class_map
    whens = " ".join(f"WHEN idx = {k} THEN '{v}'" for k, v in class_map().items())
    return f"CASE {whens} ELSE CAST(idx AS VARCHAR) END"


@query("decode_label", f"""
SELECT event_id, {_decode_sql()} AS prediction
FROM (SELECT event_id, CAST(event_id % 11 AS DOUBLE) AS idx FROM events)""")
def q_decode_label(spark, sf):
    ev = I.table(spark, sf, "events")
    idx = ev.select("event_id", (F.col("event_id") % 11).cast("double").alias("prediction"))
    return clean.decode_label(idx, "prediction")


@query("split_by_class", f"""
SELECT event_id, event_type, 'match' AS side FROM ({I.EVENTS_WITH_NULLS_SQL}) WHERE event_type = 'view'
UNION ALL
SELECT event_id, event_type, 'rest' AS side FROM ({I.EVENTS_WITH_NULLS_SQL}) WHERE event_type <> 'view'
""")
def q_split_by_class(spark, sf):
    ev = I.events_with_nulls(I.table(spark, sf, "events")).select("event_id", "event_type")
    match, rest = clean.split_by_class(ev, "event_type", "view")
    return (match.withColumn("side", F.lit("match"))
            .unionByName(rest.withColumn("side", F.lit("rest"))))


# ----------------------------------------------------------------------------- D
@query("wrap_message", """
SELECT 1 AS version, TIMESTAMP '2024-01-01 00:00:00' AS time, 'IDS' AS type, 'Data' AS event,
       event_id, user_id, event_type, value
FROM events""")
def q_wrap_message(spark, sf):
    ev = I.table(spark, sf, "events")
    clock = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    env = wrap_message(ev, ["event_id", "user_id", "event_type", "value"], clock=clock)
    return env.select("version", "time", "type", "event", "data.*")


@query("envelope_messages", """
SELECT 1 AS version, 'IDS' AS type, 'Data' AS event, '2024-01-01 00:00:00' AS time,
       CASE WHEN NOT bad THEN 'C' || event_id END AS uid,
       CASE WHEN NOT bad THEN CASE WHEN event_id % 19 = 0 THEN 3000000000 ELSE event_id END END AS orig_bytes,
       CASE WHEN NOT bad AND event_id % 17 <> 0 THEN CAST(user_id AS INTEGER) END AS orig_p
FROM (SELECT *, event_id % 13 = 0 OR event_id % 29 = 0 AS bad FROM events)""")
def q_envelope_messages(spark, sf):
    """Stream: decode each message, wrap it, serialise it; read back from the written texts."""
    from flowml.sources.stream import message_stream
    from flowml.streaming.scoring import relay_messages, start_scoring
    events = message_stream(spark, "parquet", path=sf, schema=I.table(spark, sf, "events").schema,
                            pathGlobFilter="events.parquet", maxFilesPerTrigger="1")
    clock = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    out = scratch_path(spark, "envelopes")
    start_scoring(relay_messages(I.conn_messages(events), clock=clock), "text", checkpoint=out + "-ckpt",
                  path=out, trigger={"availableNow": True}).awaitTermination()
    body = ("version int, time timestamp_ntz, type string, event string, data struct<conn: struct<"
            "uid: string, orig_bytes: bigint, `id.orig_p`: int>>")
    got = spark.read.text(out).select(F.from_json("value", body).alias("m"))
    return got.select("m.version", "m.type", "m.event", F.date_format("m.time", "yyyy-MM-dd HH:mm:ss").alias("time"),
                      F.col("m.data.conn.uid").alias("uid"), F.col("m.data.conn.orig_bytes").alias("orig_bytes"),
                      F.col("m.data.conn.`id.orig_p`").alias("orig_p"))


# ----------------------------------------------------------------------------- E
@query("row_count", "SELECT count(*) AS n FROM lineitem")
def q_row_count(spark, sf):
    return metrics.row_count(I.table(spark, sf, "lineitem"))


_ENCODE_SQL = f"""
WITH base AS ({I.ORDERS_WITH_NULLS_SQL}),
s AS (SELECT status AS v, row_number() OVER (ORDER BY count(*) DESC, status) - 1 AS i
      FROM base WHERE status IS NOT NULL GROUP BY status),
p AS (SELECT priority AS v, row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS i
      FROM base WHERE priority IS NOT NULL GROUP BY priority),
enc AS (
  SELECT o_orderkey, status, priority,
         CAST(coalesce(s.i, (SELECT count(*) FROM s)) AS DOUBLE) AS status_index,
         CAST(coalesce(p.i, (SELECT count(*) FROM p)) AS DOUBLE) AS priority_index
  FROM base LEFT JOIN s ON base.status = s.v LEFT JOIN p ON base.priority = p.v)
"""


def _encoded_orders(spark, sf):
    base = I.orders_with_nulls(I.table(spark, sf, "orders"))
    model = features.fit_encoders(base, ["status", "priority"])
    return features.encode(base, model)


@query("encode", _ENCODE_SQL + "SELECT * FROM enc")
def q_encode(spark, sf):
    return _encoded_orders(spark, sf)


@query("code_book", _ENCODE_SQL + "SELECT DISTINCT priority, priority_index FROM enc")
def q_code_book(spark, sf):
    return metrics.code_book(_encoded_orders(spark, sf), "priority")


@query("class_histogram", _ENCODE_SQL +
       "SELECT priority_index, count(*) AS n FROM enc GROUP BY priority_index")
def q_class_histogram(spark, sf):
    return metrics.class_histogram(_encoded_orders(spark, sf), "priority_index")


@query("encode_skip_missing", "SELECT o_orderkey, o_orderstatus FROM orders")
def q_encode_skip_missing(spark, sf):
    base = I.orders_with_nulls(I.table(spark, sf, "orders"))
    model = features.fit_encoders(base, ["priority"])
    live = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return features.encode(live, model, skip_missing=True)


@query("confusion_long", f"""
SELECT label, prediction, count(*) AS n FROM ({I.PREDICTIONS_SQL}) GROUP BY label, prediction""")
def q_confusion_long(spark, sf):
    return metrics.confusion_long(I.predictions(I.table(spark, sf, "events")))


_CLASSES = [float(i) for i in range(len(I.EVENT_CLASSES))]


@query("confusion_wide", f"""
SELECT label, {", ".join(f"CAST(sum(CASE WHEN prediction = {c} THEN 1 ELSE 0 END) AS BIGINT) AS pred_{int(c)}" for c in _CLASSES)}
FROM ({I.PREDICTIONS_SQL}) GROUP BY label""")
def q_confusion_wide(spark, sf):
    return metrics.confusion_wide(I.predictions(I.table(spark, sf, "events")), _CLASSES)


_EVENT_NAMES = ", ".join(f"CAST(sum(CASE WHEN prediction = {float(i)} THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
                         for i, n in enumerate(I.EVENT_CLASSES[:4]))


@query("confusion_named", f"""
SELECT CASE label {" ".join(f"WHEN {float(i)} THEN '{n}'" for i, n in enumerate(I.EVENT_CLASSES[:4]))}
       ELSE '4.0' END AS label, {_EVENT_NAMES},
       CAST(sum(CASE WHEN prediction = 4.0 THEN 1 ELSE 0 END) AS BIGINT) AS others
FROM ({I.PREDICTIONS_SQL}) GROUP BY 1""")
def q_confusion_named(spark, sf):
    return metrics.confusion_wide(I.predictions(I.table(spark, sf, "events")), _CLASSES[:4],
                                  names=I.EVENT_CLASSES[:4], other="others")


_STATS_SQL = f"""
WITH p AS ({I.PREDICTIONS_SQL}),
tot AS (SELECT count(*) AS total FROM p),
cls AS (SELECT * FROM (VALUES {", ".join(f"({c})" for c in _CLASSES + [9.0])}) v(cls)),
st AS (
  SELECT cls.cls,
    (SELECT count(*) FROM p WHERE p.label = cls.cls) AS actual,
    (SELECT count(*) FROM p WHERE p.prediction = cls.cls) AS predicted,
    (SELECT count(*) FROM p WHERE p.label = cls.cls AND p.prediction = cls.cls) AS tp,
    (SELECT total FROM tot) AS total
  FROM cls),
r AS (
  SELECT cls, actual, predicted, tp, total,
    CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS prec,
    CASE WHEN actual > 0 THEN tp / actual END AS rec
  FROM st)
"""


@query("per_class_rates", _STATS_SQL + """
SELECT cls AS label, CAST(actual AS BIGINT) AS support, round(rec, 6) AS tpr,
  round(CASE WHEN total - actual > 0 THEN (predicted - tp) / (total - actual) END, 6) AS fpr,
  round(CASE WHEN actual > 0 THEN prec END, 6) AS precision,
  round(CASE WHEN actual > 0 THEN CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END END, 6) AS f1
FROM r""")
def q_per_class_rates(spark, sf):
    rates = metrics.per_class_rates(I.predictions(I.table(spark, sf, "events")),
                                    _CLASSES + [9.0])
    return rates.select("label", "support", *[r6(F.col(c)).alias(c)
                                              for c in ["tpr", "fpr", "precision", "f1"]])


@query("overall_metrics", _STATS_SQL + """
SELECT round(sum(tp) / max(total), 6) AS accuracy,
       round(sum(prec * actual / total), 6) AS weighted_precision,
       round(sum(rec * actual / total), 6) AS weighted_recall,
       round(sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END * actual / total), 6) AS f1
FROM r WHERE actual > 0""")
def q_overall_metrics(spark, sf):
    m = metrics.overall_metrics(I.predictions(I.table(spark, sf, "events")))
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns])


# ----------------------------------------------------------------------------- F
@query("assemble", """
SELECT l_orderkey, l_linenumber,
       [l_quantity, l_extendedprice, l_discount, l_tax] AS features
FROM lineitem""")
def q_assemble(spark, sf):
    li = I.table(spark, sf, "lineitem")
    v = features.assemble(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return features.vector_as_array(v.select("l_orderkey", "l_linenumber", "features"))


# ----------------------------------------------------------------------------- G
@query("hash_split", f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN {sql_hash_uniform(SEED, "l_orderkey", "l_linenumber")} < 0.7 THEN 0 ELSE 1 END AS split
FROM lineitem""")
def q_hash_split(spark, sf):
    li = I.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("_key"))
    return sampling.with_split(li, "_key", (0.7, 0.3), SEED).drop("_key")


@query("split_one_class", f"""
SELECT event_id, event_type FROM events
WHERE event_type = 'view' AND {sql_hash_uniform(SEED, "event_id")} < 0.1""")
def q_split_one_class(spark, sf):
    ev = I.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.sample_class(ev, "event_type", "view", 0.1, "event_id", SEED)


_UNDER_TARGETS = {"click": 500, "view": 1000, "error": 0}


@query("undersample", f"""
WITH t AS (SELECT event_id, event_type,
                  row_number() OVER (PARTITION BY event_type
                                     ORDER BY {sql_hash_u32(SEED, "event_id")}, event_id) AS rn
           FROM events)
SELECT event_id, event_type FROM t
WHERE CASE event_type {" ".join(f"WHEN '{k}' THEN rn <= {v}" for k, v in _UNDER_TARGETS.items())}
      ELSE TRUE END""")
def q_undersample(spark, sf):
    ev = I.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.undersample(ev, "event_type", _UNDER_TARGETS, "event_id", SEED)


@query("union_flows", """
SELECT event_id, user_id, event_type, value FROM events""")
def q_union_flows(spark, sf):
    ev = I.table(spark, sf, "events")
    a = ev.filter(F.col("event_type").isin("click", "view")).select(
        "event_id", "user_id", "event_type", "value")
    b = ev.filter(F.coalesce(~F.col("event_type").isin("click", "view"), F.lit(True))).select(
        "value", "event_type", "user_id", "event_id")
    return sampling.union_flows(a, b)


# ----------------------------------------------------------------------------- G4
def _smote_sql(points: str) -> str:
    """Brute-force oracle of the oversampling rule; ``points`` yields (label, vec_id, x)."""
    return f"""
WITH pts AS ({points}),
sz AS (SELECT label, count(*) AS n FROM pts GROUP BY label),
mx AS (SELECT max(n) AS m FROM sz),
need AS (SELECT label, n, (m - n) // n AS per_row, (m - n) % n AS extra, least(5, n - 1) AS k
         FROM sz, mx WHERE m - n > 0),
rk AS (SELECT label, vec_id, x,
              row_number() OVER (PARTITION BY label
                                 ORDER BY {sql_hash_u32(f"{SEED}:extra", "vec_id")}, vec_id) AS rn
       FROM pts),
bases AS (SELECT rk.label, rk.vec_id, rk.x, need.k,
                 need.per_row + CASE WHEN rk.rn <= need.extra THEN 1 ELSE 0 END AS reps
          FROM rk JOIN need USING (label)),
nn AS (SELECT b.vec_id, o.vec_id AS nb,
              row_number() OVER (PARTITION BY b.vec_id ORDER BY
                  list_sum(list_transform(b.x, lambda v, i: (v - o.x[i]) * (v - o.x[i]))), o.vec_id) AS rank
       FROM bases b JOIN pts o ON o.label = b.label AND o.vec_id <> b.vec_id
       WHERE b.reps > 0),
draws AS (SELECT label, vec_id, x, k, unnest(range(0, reps)) AS draw FROM bases WHERE reps > 0),
dr AS (SELECT *, CAST(floor({sql_hash_uniform(SEED, "'nb'", "vec_id", "draw")} * k) AS INTEGER) + 1 AS rank,
              {sql_hash_uniform(SEED, "'gap'", "vec_id", "draw")} AS gap
       FROM draws),
syn AS (SELECT dr.label, dr.vec_id AS base_key, dr.draw, nn.nb AS neighbour_key, dr.gap,
               list_transform(dr.x, lambda v, i: v + dr.gap * (o.x[i] - v)) AS x
        FROM dr JOIN nn ON nn.vec_id = dr.vec_id AND nn.rank = dr.rank
        JOIN pts o ON o.vec_id = nn.nb)
"""


_SMOTE_SQL = _smote_sql("SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings")


def _smote_embeddings(spark, sf):
    from flowml.operators.smote import synthesize
    emb = I.table(spark, sf, "embeddings")
    return synthesize(emb, "label", "embedding", "vec_id", k=5, seed=SEED)


@query("smote", _SMOTE_SQL + """
SELECT label, base_key, draw, neighbour_key, round(gap, 6) AS gap,
       list_transform(x, lambda v: round(v, 6)) AS x
FROM syn""")
def q_smote(spark, sf):
    syn = _smote_embeddings(spark, sf)
    return syn.select("label", "base_key", "draw", "neighbour_key", r6(F.col("gap")).alias("gap"),
                      F.transform("_x", lambda v: F.round(v, 6)).alias("x"))


def _knn_sql(points: str) -> str:
    return f"""
WITH pts AS ({points}),
d AS (SELECT a.label, a.vec_id, b.vec_id AS nb_key,
        list_sum(list_transform(a.x, lambda v, i: (v - b.x[i]) * (v - b.x[i]))) AS d2
      FROM pts a JOIN pts b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY d2, nb_key) AS INTEGER) AS rank FROM d)
SELECT label, vec_id, rank, nb_key, round(d2, 6) AS d2 FROM r WHERE rank <= 5"""


def _knn(spark, points, label_values, method="cells", max_pivots=None):
    """Neighbours with cells far smaller than the classes, so that all passes run."""
    from flowml.operators.knn import exact_knn
    got = exact_knn(points, "label", "vec_id", "x", {c: 5 for c in label_values}, SEED, cell_size=64,
                    max_pivots=max_pivots, method=method)
    return got.select("label", "vec_id", F.col("rank").cast("int").alias("rank"), "nb_key", r6(F.col("d2")).alias("d2"))


_VECTORS_SQL = _knn_sql("SELECT CAST(0 AS INTEGER) AS label, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings")


def _vectors(spark, sf):
    return I.table(spark, sf, "embeddings").select(
        F.lit(0).alias("label"), "vec_id", F.col("embedding").cast("array<double>").alias("x"))


@query("knn_cells", _VECTORS_SQL)
def q_knn_cells(spark, sf):
    return _knn(spark, _vectors(spark, sf), [0])


@query("knn_tree", _VECTORS_SQL)
def q_knn_tree(spark, sf):
    """A first level of two pivots, so that cells are cut again by pivots of their own."""
    return _knn(spark, _vectors(spark, sf), [0], max_pivots=2)


@query("knn_blocks", _VECTORS_SQL)
def q_knn_blocks(spark, sf):
    """At 64 dimensions comparing blocks shuffles fewer rows than visiting cells."""
    return _knn(spark, _vectors(spark, sf), [0], method="auto")


# Few different points, each held by very many events: answers are ties broken by key.
_COPIES_SQL = f"""SELECT {I._sql_event_class()} AS label, event_id AS vec_id,
  [CAST(user_id % 5 AS DOUBLE), CAST(user_id % 3 - {_K} % 2 AS DOUBLE)] AS x FROM events"""


@query("knn_copies", _knn_sql(_COPIES_SQL))
def q_knn_copies(spark, sf):
    flows = I.flows_from_events(I.table(spark, sf, "events"))
    pts = flows.select(I.event_class("proto").alias("label"), F.col("event_id").alias("vec_id"), F.array(
        (F.col("sport") % 5).cast("double"), (F.col("sport") % 3 - F.col("dsport") % 2).cast("double")).alias("x"))
    return _knn(spark, pts, range(len(I.EVENT_CLASSES)))


@query("smote_histogram", _SMOTE_SQL + """
SELECT label, count(*) AS n FROM (SELECT label FROM pts UNION ALL SELECT label FROM syn)
GROUP BY label""")
def q_smote_histogram(spark, sf):
    syn = _smote_embeddings(spark, sf)
    emb = I.table(spark, sf, "embeddings")
    both = emb.select("label").unionByName(syn.select("label"))
    return metrics.class_histogram(both, "label")


# ----------------------------------------------------------------------------- H
def _bayes_model(spark, sf):
    from flowml.operators.models import train
    frame = I.bayes_frame(I.table(spark, sf, "lineitem"))
    feats = [f"f{i}" for i in range(len(I.BAYES_FEATURES))]
    data = features.assemble(frame, feats)
    return data, train("bayes", data, label="label")


_D = len(I.BAYES_FEATURES)


@query("bayes_params", I.BAYES_SQL + "SELECT label, round(pi, 6) AS pi, "
       + ", ".join(f"round(t{i}, 6) AS theta_{i}" for i in range(_D)) + " FROM par")
def q_bayes_params(spark, sf):
    from flowml.operators.models import bayes_parameters
    _, model = _bayes_model(spark, sf)
    pi, theta = bayes_parameters(model)
    # Bounded: classes x features values produced by the fitted model.
    rows = [(float(c), round(pi[c], 6), *[round(v, 6) for v in theta[c]]) for c in range(len(pi))]
    schema = "label double, pi double, " + ", ".join(f"theta_{i} double" for i in range(_D))
    return sampling.literal_table(spark, schema, rows)


def _bayes_predict_sql(keys: str = "l_orderkey, l_linenumber") -> str:
    n = len(I.RETURNFLAG_CLASSES)
    score = []
    for c in range(n):
        p = f"(SELECT {{col}} FROM par WHERE label = {float(c)})"
        terms = [p.format(col="pi")] + [f"t.f{i} * " + p.format(col=f"t{i}") for i in range(_D)]
        score.append(f"{' + '.join(terms)} AS s{c}")
    # First maximum wins, like an argmax over the class index.
    whens = []
    for c in range(n - 1):
        conds = " AND ".join(f"s{c} >= s{o}" for o in range(n) if o != c and o > c)
        conds2 = " AND ".join(f"s{c} > s{o}" for o in range(c))
        cond = " AND ".join(x for x in [conds, conds2] if x)
        whens.append(f"WHEN {cond} THEN {float(c)}")
    return (I.BAYES_SQL + f", sc AS (SELECT {keys}, " + ", ".join(score)
            + f" FROM t) SELECT {keys}, CASE " + " ".join(whens)
            + f" ELSE {float(n - 1)} END AS prediction FROM sc")


@query("bayes_predict", _bayes_predict_sql())
def q_bayes_predict(spark, sf):
    data, model = _bayes_model(spark, sf)
    return model.transform(data).select("l_orderkey", "l_linenumber", "prediction")


def _embedding_frame(spark, sf):
    from pyspark.ml.functions import array_to_vector
    emb = I.table(spark, sf, "embeddings")
    return emb.select(F.col("vec_id").cast("string").alias("key"),
                      F.col("label").cast("double").alias("label"),
                      array_to_vector(F.col("embedding")).alias("features"))


_EMB_CLASSES = [float(i) for i in range(10)]


def _report(spark, frame, kind, **params):
    from flowml.operators.models import train
    # Both parts are filters over one materialised input (no recomputation of it).
    frame = materialise(frame, "report-input")
    train_df, test_df = sampling.hash_split(frame, "key", (0.7, 0.3), SEED)
    model = train(kind, train_df, label="label", n_classes=len(_EMB_CLASSES), **params)
    pred = model.transform(test_df)
    return _rounded(metrics.evaluation_report(pred, _EMB_CLASSES, "label", "prediction"))


def _report_sql(pred_sql: str, classes) -> str:
    """The evaluation report of (label, prediction) rows, as SQL."""
    values = ", ".join(f"({float(c)})" for c in classes)
    return f"""
p AS ({pred_sql}),
cls AS (SELECT * FROM (VALUES {values}) v(cls) UNION SELECT label FROM p),
st AS (SELECT cls, (SELECT count(*) FROM p WHERE label = cls) AS actual,
         (SELECT count(*) FROM p WHERE prediction = cls) AS predicted,
         (SELECT count(*) FROM p WHERE label = cls AND prediction = cls) AS tp,
         (SELECT count(*) FROM p) AS total FROM cls),
r AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS prec,
        CASE WHEN actual > 0 THEN tp / actual END AS rec FROM st),
f AS (SELECT *, CASE WHEN actual > 0 THEN CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END END AS f1 FROM r),
o AS (SELECT sum(tp) / max(total) AS accuracy, sum(prec * actual / total) AS weighted_precision,
        sum(rec * actual / total) AS weighted_recall, sum(f1 * actual / total) AS weighted_f1 FROM f WHERE actual > 0)
SELECT cls AS label, CAST(actual AS BIGINT) AS support, round(rec, 6) AS tpr,
  round(CASE WHEN total - actual > 0 THEN (predicted - tp) / (total - actual) END, 6) AS fpr,
  round(CASE WHEN actual > 0 THEN prec END, 6) AS precision, round(f1, 6) AS f1,
  round(accuracy, 6) AS accuracy, round(weighted_precision, 6) AS weighted_precision,
  round(weighted_recall, 6) AS weighted_recall, round(weighted_f1, 6) AS weighted_f1
FROM f, o WHERE cls IN ({", ".join(str(float(c)) for c in classes)})"""


def _rounded(report):
    return report.select(*[r6(F.col(c)).alias(c) if c not in ("label", "support", "name") else F.col(c)
                           for c in report.columns])


# A label that is a rule of discrete features: a fully grown tree learns it exactly, so the
# report of the hold-out part follows from the rule and the split.
_RULE_CLASSES = [float(i) for i in range(6)]
_RULE_SQL = ("WITH " + _report_sql(f"""
SELECT label, label AS prediction FROM (
  SELECT CAST(l_linenumber % 3 + CASE WHEN l_quantity > 25 THEN 3 ELSE 0 END AS DOUBLE) AS label,
         {sql_hash_uniform(SEED, "l_orderkey", "l_linenumber")} AS u FROM lineitem) WHERE u >= 0.7""",
    _RULE_CLASSES).lstrip())


def _rule_frame(spark, sf):
    li = I.table(spark, sf, "lineitem").select(
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("key"), "l_linenumber", "l_quantity",
        (F.col("l_linenumber") % 3 + F.when(F.col("l_quantity") > 25, 3).otherwise(0)).cast("double").alias("label"))
    return features.assemble(li, ["l_linenumber", "l_quantity"]).select("key", "label", "features")


def _rule_report(spark, sf, kind, **params):
    from flowml.operators.models import score, train
    train_df, test_df = sampling.hash_split(_rule_frame(spark, sf), "key", (0.7, 0.3), SEED)
    model = train(kind, train_df, label="label", n_classes=len(_RULE_CLASSES), **params)
    return _rounded(metrics.evaluation_report(score(test_df, model), _RULE_CLASSES, "label", "prediction"))


@query("tree_rule_report", _RULE_SQL)
def q_tree_rule_report(spark, sf):
    return _rule_report(spark, sf, "tree")


@query("forest_rule_report", _RULE_SQL)
def q_forest_rule_report(spark, sf):
    return _rule_report(spark, sf, "forest")


@query("tree_report")
def q_tree_report(spark, sf):
    return _report(spark, _embedding_frame(spark, sf), "tree")


@query("mlp_report")
def q_mlp_report(spark, sf):
    return _report(spark, _embedding_frame(spark, sf), "mlp")


# Predictions of the learners against the same models read back as tables and scored in SQL
# expressions, row by row; ``better``: more rows are right than by always naming the largest class.
def _model_path(spark, model):
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    return path


def _compared(spark, frame, kind, columns, array="x", **params):
    from flowml.operators import model_tables as M
    from flowml.operators.models import train
    # A small file is one task; scoring in array functions is worth more of them.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame = materialise(frame.repartition(parts, columns[0]), "report-input")
    classes = int(frame.agg(F.max("label")).first()[0]) + 1
    model = train(kind, frame, label="label", n_classes=classes, **params)
    path = _model_path(spark, model)
    scored = model.transform(features.vector_as_array(frame.withColumn(array, F.col("features")), array))
    if kind == "mlp":
        got = M.with_dense_prediction(scored, M.dense_layers(spark, path), array, "table")
    else:
        got = M.with_tree_prediction(scored, M.tree_nodes(spark, path), array, "table")
    right = frame.groupBy("label").count().agg(F.max("count")).first()[0]
    # Scored once: the count and the result read the same rows.
    got = materialise(got.select(*dict.fromkeys([*columns, "label", "prediction", "table"])), "compared")
    better = got.where("label = prediction").count() > right
    return got.select(*columns, (F.col("prediction") == F.col("table")).alias("same"), F.lit(better).alias("better"))


_TABLE_SQL = "SELECT CAST(vec_id AS VARCHAR) AS key, CAST(label AS DOUBLE) AS label, true AS same, true AS better FROM embeddings"


@query("tree_table", _TABLE_SQL)
def q_tree_table(spark, sf):
    return _compared(spark, _embedding_frame(spark, sf), "tree", ["key", "label"])


@query("forest_table", _TABLE_SQL)
def q_forest_table(spark, sf):
    return _compared(spark, _embedding_frame(spark, sf), "forest", ["key", "label"])


@query("mlp_table", _TABLE_SQL)
def q_mlp_table(spark, sf):
    return _compared(spark, _embedding_frame(spark, sf), "mlp", ["key", "label"])


@query("argus_tree", f"""
WITH {_index_sql("a", _RAW_ATTACK, _RAW_OK)}
SELECT CAST(event_id AS INTEGER) AS sbytes, coalesce(a.i, (SELECT count(*) FROM a)) AS label,
       true AS same, true AS better
FROM events LEFT JOIN a ON a.v = {_RAW_ATTACK} WHERE {_RAW_OK}""")
def q_argus_tree(spark, sf):
    """A model of the wide profile: 16 features, categorical ones split by sets of categories."""
    return _compared(spark, _argus_frame(spark, sf), "tree", ["sbytes", "label"])


@query("argus_mlp", f"""
WITH {_index_sql("a", _RAW_ATTACK, _RAW_OK)}
SELECT CAST(event_id AS INTEGER) AS sbytes, coalesce(a.i, (SELECT count(*) FROM a)) AS label, true AS same
FROM events LEFT JOIN a ON a.v = {_RAW_ATTACK} WHERE {_RAW_OK}""")
def q_argus_mlp(spark, sf):
    return _compared(spark, _argus_frame(spark, sf), "mlp", ["sbytes", "label"]).drop("better")


def _argus_frame(spark, sf):
    from flowml.schema import PROFILES
    flows = clean.apply_profile(_raw_flows(spark, sf), "argus")
    flows = materialise(flows, "argus-flows")
    enc = features.encode(flows, features.fit_encoders(flows, list(PROFILES["argus"].strings)))
    return features.assemble(enc, "argus").select("sbytes", F.col("attack_cat_index").alias("label"), "features")


@query("report_named", f"WITH bp AS ({_bayes_predict_sql('label')}), rep AS (SELECT * FROM (WITH "
       + _report_sql("SELECT * FROM bp", [0, 1, 2]).lstrip() + ")) "
       "SELECT *, CASE label WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS name FROM rep")
def q_report_named(spark, sf):
    """The report with the names of its classes."""
    data, model = _bayes_model(spark, sf)
    report = metrics.evaluation_report(model.transform(data), [0.0, 1.0, 2.0], "label", "prediction",
                                       names=["A", "N", "R"])
    return _rounded(report)


@query("bayes_report", f"WITH bp AS ({_bayes_predict_sql('label')}), "
       + _report_sql("SELECT * FROM bp", [0, 1, 2]).lstrip())
def q_bayes_report(spark, sf):
    from flowml.operators.models import train
    data, model = _bayes_model(spark, sf)
    pred = model.transform(data)
    return _rounded(metrics.evaluation_report(pred, [0.0, 1.0, 2.0], "label", "prediction"))


def balanced_embeddings(spark, sf):
    """Original embeddings plus synthetic rows (every class at the majority size)."""
    from pyspark.ml.functions import array_to_vector
    from flowml.operators.smote import synthesize
    emb = I.table(spark, sf, "embeddings")
    syn = synthesize(emb, "label", "embedding", "vec_id", k=5, seed=SEED)
    orig = emb.select(F.col("vec_id").cast("string").alias("key"),
                      F.col("label").cast("double").alias("label"),
                      F.col("embedding").cast("array<double>").alias("x"))
    new = syn.select(F.concat_ws(":", F.col("base_key").cast("string"), F.col("draw").cast("string"))
                     .alias("key"), F.col("label").cast("double").alias("label"), F.col("_x").alias("x"))
    both = orig.unionByName(new)
    return both.select("key", "label", array_to_vector("x").alias("features"))


@query("forest_report")
def q_forest_report(spark, sf):
    return _report(spark, balanced_embeddings(spark, sf), "forest")


def flagship(spark, sf):
    """Balance -> split -> forest -> per-class rates (the workflow's intended order)."""
    return q_forest_report(spark, sf)


_FLOW_ATTACK = "CASE WHEN value < 5 THEN 'Generic' WHEN value < 20 THEN 'Exploits' WHEN value < 60 THEN 'Fuzzers' END"


@query("save_load_score", f"""
WITH {_index_sql("a", _FLOW_ATTACK, "true")}
SELECT event_id, coalesce(a.i, (SELECT count(*) FROM a)) AS attack_cat_index, true AS same
FROM events LEFT JOIN a ON a.v = {_FLOW_ATTACK}""")
def q_save_load_score(spark, sf):
    """Predictions of a pipeline before saving and after loading, compared row by row."""
    from flowml.operators.models import fit_flow_pipeline, load_pipeline, save_pipeline, score
    flows = I.flows_from_events(I.table(spark, sf, "events"))
    model = fit_flow_pipeline(flows, "zeek", "forest")
    loaded = load_pipeline(save_pipeline(model, scratch_path(spark, "flow-model")))
    before = score(flows, model).select("event_id", F.col("prediction").alias("before"))
    after = score(flows, loaded).select("event_id", "attack_cat_index", "prediction")
    return after.join(before, "event_id").select(
        "event_id", "attack_cat_index", (F.col("prediction") == F.col("before")).alias("same"))


# ----------------------------------------------------------------------------- I
_BAD = "(event_id % 13 = 0 OR event_id % 29 = 0)"


@query("score_stream", f"""
WITH {_index_sql("pr", "event_type", _RAW_OK)}, {_index_sql("se", _RAW_SERVICE, _RAW_OK)}
SELECT event_id AS msg_id, true AS named, true AS same,
  CASE WHEN bad THEN 'No ataque' ELSE '10.0.' || (user_id % 256) || '.1' END AS srcip,
  CASE WHEN bad OR event_id % 17 = 0 THEN 0 ELSE CAST(user_id AS INTEGER) END AS sport,
  CASE WHEN bad THEN 'No ataque' ELSE '192.0.2.3' END AS dstip,
  CASE WHEN bad THEN 0 ELSE {_K} END AS dsport,
  CASE WHEN bad THEN 'No ataque' ELSE event_type END AS proto,
  CASE WHEN bad THEN (SELECT count(*) FROM pr) ELSE pr.i END AS proto_index,
  CASE WHEN bad THEN 0.0 ELSE value END AS dur,
  CASE WHEN bad THEN 0 WHEN event_id % 19 = 0 THEN 3000000000 ELSE event_id END AS sbytes,
  CASE WHEN bad THEN 0 ELSE event_id % 1000 END AS dbytes,
  CASE WHEN bad OR event_id % 3 = 2 THEN (SELECT count(*) FROM se) ELSE se.i END AS service_index,
  CASE WHEN bad THEN 0 ELSE CAST(user_id % 7 + 1 AS INTEGER) END AS "Spkts",
  CASE WHEN bad THEN 0 ELSE CAST({_K} % 5 AS INTEGER) END AS "Dpkts", NOT bad AS parse_ok
FROM (SELECT *, {_BAD} AS bad FROM events) e LEFT JOIN pr ON pr.v = event_type
LEFT JOIN se ON se.v = {_RAW_SERVICE}""")
def q_score_stream(spark, sf):
    """The connected workflow: balance raw flows, train a forest on the balanced table, save
    encoders and model, load both, score the message stream. ``named``: the prediction is one
    of the known class names; ``same``: it is what the saved nodes, read as a table, say of the
    alert's own columns."""
    from flowml.operators import model_tables as M
    from flowml.plans.workflow import load_scoring_model, run_balance_job, run_train_job
    from flowml.schema import PROFILES, class_map
    from flowml.sources.stream import message_stream
    from flowml.streaming.scoring import score_messages, start_scoring
    raw_dir = scratch_path(spark, "raw-flows")
    I.raw_flow_lines(I.table(spark, sf, "events")).write.mode("overwrite").text(raw_dir, compression="gzip")
    encoders, clf = scratch_path(spark, "encoders"), scratch_path(spark, "classifier")
    table = run_balance_job(spark, raw_dir, scratch_path(spark, "balanced"), encoders_path=encoders, fmt="parquet")
    drop_scratch(spark, raw_dir)
    with scratch_dropped(spark):
        run_train_job(spark, table, "forest", model_path=clf, fmt="parquet")
    drop_scratch(spark, table)
    model = load_scoring_model(encoders, clf)
    events = message_stream(spark, "parquet", path=sf, schema=I.table(spark, sf, "events").schema,
                            pathGlobFilter="events.parquet", maxFilesPerTrigger="1")
    alerts = score_messages(I.conn_messages(events), model, passthrough=["msg_id"])
    out = scratch_path(spark, "alerts")
    q = start_scoring(alerts, "parquet", checkpoint=out + "-ckpt", path=out,
                      trigger={"availableNow": True})
    q.awaitTermination()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = spark.read.parquet(out).repartition(parts, "msg_id").withColumn("_x", F.array(*[F.col(c).cast("double") for c in PROFILES["zeek"].vector]))
    table = clean.decode_label(M.with_tree_prediction(got, M.tree_nodes(spark, clf), "_x", "_table"), "_table")
    return table.withColumn("named", F.col("prediction").isin(*class_map().values())) \
        .withColumn("same", F.col("prediction") == F.col("_table")).drop("prediction", "_x", "_table")


# ----------------------------------------------------------------------------- workflow jobs
def _balanced_flows_path(spark, sf):
    from flowml.plans.workflow import run_balance_job
    raw_dir = scratch_path(spark, "raw-flows")
    I.raw_flow_lines(I.table(spark, sf, "events")).write.mode("overwrite").text(raw_dir, compression="gzip")
    return run_balance_job(spark, raw_dir, scratch_path(spark, "balanced"),
                           encoders_path=scratch_path(spark, "encoders"))


@query("balance_job", I.BALANCED_HISTOGRAM_SQL)
def q_balance_job(spark, sf):
    enc = read_encoded(spark, _balanced_flows_path(spark, sf))
    return metrics.class_histogram(enc, "attack_cat_index")


@query("train_job")
def q_train_job(spark, sf):
    from flowml.plans.workflow import run_train_job
    report, _ = run_train_job(spark, _balanced_flows_path(spark, sf), "tree",
                              classes=[float(i) for i in range(5)])
    return _rounded(report)


# Flow features of the oversampling step: ints come back truncated.
_FLOW_FEATS = ["sport", "dsport", "proto_index", "dur", "sbytes", "dbytes", "service_index",
               "Spkts", "Dpkts"]
_FLOW_INTS = ["sport", "dsport", "sbytes", "dbytes", "Spkts", "Dpkts"]
_FLOW_POINTS_SQL = f"""
SELECT {I._sql_event_class()} AS label, event_id AS vec_id,
       [CAST(user_id AS DOUBLE), CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE),
        {I._sql_event_class()}, value, CAST(event_id AS DOUBLE), CAST(event_id % 1000 AS DOUBLE),
        CAST(event_id % 3 AS DOUBLE), CAST(user_id % 7 + 1 AS DOUBLE),
        CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS DOUBLE)] AS x
FROM events"""


def _flow_out_sql(src: str, synthetic: str) -> str:
    cols = []
    for i, c in enumerate(_FLOW_FEATS, start=1):
        v = f"x[{i}]"
        cols.append(f"CAST(trunc({v}) AS INTEGER) AS {c}" if c in _FLOW_INTS else f"round({v}, 6) AS {c}")
    return f"SELECT {', '.join(cols)}, label, {synthetic} AS synthetic FROM {src}"


@query("smote_flows", _smote_sql(_FLOW_POINTS_SQL) + _flow_out_sql("pts", "false")
       + " UNION ALL " + _flow_out_sql("syn", "true"))
def q_smote_flows(spark, sf):
    from flowml.operators.smote import smote
    fl = I.flows_from_events(I.table(spark, sf, "events"))
    fl = fl.select("event_id", I.event_class("proto").alias("label"), "sport", "dsport",
                   I.event_class("proto").alias("proto_index"), "dur", "sbytes", "dbytes",
                   (F.col("event_id") % 3).cast("double").alias("service_index"), "Spkts", "Dpkts")
    out = smote(fl, "label", _FLOW_FEATS, "event_id", k=5, seed=SEED, int_cols=_FLOW_INTS)
    return out.select(*[r6(F.col(c)).alias(c) if c not in _FLOW_INTS else F.col(c)
                        for c in _FLOW_FEATS], "label", "synthetic")


# Queries of the jobs that write: quarantine, ledger, observed metrics, tables by class.
from flowml.plans import catalog_jobs  # noqa: E402, F401
