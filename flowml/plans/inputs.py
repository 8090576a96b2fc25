"""Flow-shaped inputs derived from the driver's test tables.

The test tables are not flow logs, so every registered query derives its input
from them with a fixed rule that the SQL oracle repeats. Derivations are
row-wise expressions over whole tables (no subsets, no caps), so the work of
every query grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Alphabetical class index of the event types.
EVENT_CLASSES = ["click", "error", "purchase", "signup", "view"]
# Return-flag class index (naive Bayes input).
RETURNFLAG_CLASSES = ["A", "N", "R"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_class(col: str = "event_type"):
    """event_type -> class index as double (alphabetical), null stays null."""
    expr = None
    for i, name in enumerate(EVENT_CLASSES):
        cond = F.col(col) == F.lit(name)
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    return expr


def props_k():
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def csv_lines(events: DataFrame) -> DataFrame:
    """Text lines `event_id,user_id,event_type,value` with deliberate defects:
    hex int, float-in-int, short row, long row (rejected), empty tokens (valid nulls), and
    blank lines (neither rows nor rejects)."""
    eid = F.col("event_id")
    user = (F.when(eid % 97 == 0, F.concat(F.lit("0x"), F.col("user_id").cast("string")))
            .when(eid % 89 == 0, F.concat(F.col("user_id").cast("string"), F.lit(".0")))
            .otherwise(F.col("user_id").cast("string")))
    etype = F.when(eid % 71 == 0, F.lit("")).otherwise(F.col("event_type"))
    value = F.when(eid % 73 == 0, F.lit("")).otherwise(F.col("value").cast("string"))
    full = F.concat_ws(",", eid.cast("string"), user, etype, value)
    line = (F.when(eid % 61 == 0, F.lit("")).when(eid % 67 == 0, F.lit("   "))
            .when(eid % 83 == 0, F.concat_ws(",", eid.cast("string"), user, etype))
            .when(eid % 79 == 0, F.concat_ws(",", full, props_k().cast("string")))
            .otherwise(full))
    return events.select(line.alias("value"))


CSV_LINES_SQL = """
SELECT line FROM (SELECT CASE WHEN event_id % 61 = 0 OR event_id % 67 = 0 THEN ''
            WHEN event_id % 83 = 0 THEN concat_ws(',', CAST(event_id AS VARCHAR), u, et)
            WHEN event_id % 79 = 0 THEN concat_ws(',', CAST(event_id AS VARCHAR), u, et, v,
                 CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR))
            ELSE concat_ws(',', CAST(event_id AS VARCHAR), u, et, v) END AS line
FROM (SELECT event_id, props,
        CASE WHEN event_id % 97 = 0 THEN '0x' || CAST(user_id AS VARCHAR)
             WHEN event_id % 89 = 0 THEN CAST(user_id AS VARCHAR) || '.0'
             ELSE CAST(user_id AS VARCHAR) END AS u,
        CASE WHEN event_id % 71 = 0 THEN '' ELSE event_type END AS et,
        CASE WHEN event_id % 73 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS v
      FROM events)) WHERE line <> ''
"""

CSV_DDL = "event_id long, user_id int, event_type string, value double"


def conn_messages(events: DataFrame) -> DataFrame:
    """One JSON connection-log message per event, some deliberately defective:
    not JSON, no `conn`, a non-numeric port, an int overflow, an array in a string field."""
    eid = F.col("event_id")
    conn = F.struct(
        F.col("ts").cast("string").alias("ts"),
        F.concat(F.lit("C"), eid.cast("string")).alias("uid"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit(".1")).alias("id.orig_h"),
        F.col("user_id").alias("id.orig_p"),
        F.lit("192.0.2.3").alias("id.resp_h"),
        props_k().alias("id.resp_p"),
        F.col("event_type").alias("proto"),
        F.when(eid % 3 == 0, F.lit("http")).when(eid % 3 == 1, F.lit("dns")).alias("service"),
        F.col("value").alias("duration"),
        F.when(eid % 19 == 0, F.lit(3000000000)).otherwise(eid).alias("orig_bytes"),
        (eid % 1000).alias("resp_bytes"),
        F.lit("SF").alias("conn_state"),
        (eid % 2 == 0).alias("local_orig"),
        F.lit(False).alias("local_resp"),
        F.lit("0").alias("missed_bytes"),
        F.lit("ShADad").alias("history"),
        (F.col("user_id") % 7 + 1).alias("orig_pkts"),
        F.lit("0").alias("orig_ip_bytes"),
        (props_k() % 5).alias("resp_pkts"),
        F.lit("0").alias("resp_ip_bytes"),
        F.when(eid % 23 == 0, F.array(F.lit("a"))).alias("tunnel_parents"),
    )
    msg = F.to_json(F.struct(conn.alias("conn"), F.lit("1").alias("version"),
                             F.lit("IDS").alias("type"), F.lit("Data").alias("event")))
    no_conn = F.to_json(F.struct(F.lit("1").alias("version")))
    # A port sent as a non-numeric string.
    wrong_type = F.regexp_replace(msg, r'"id\.orig_p":[0-9]+', '"id.orig_p":"x5"')
    value = (F.when(eid % 13 == 0, F.lit("notjson"))
             .when(eid % 29 == 0, no_conn)
             .when(eid % 17 == 0, wrong_type)
             .otherwise(msg))
    return events.select(eid.alias("msg_id"), value.alias("value"))


def events_with_nulls(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    return events.select(
        eid,
        F.when(eid % 7 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
        F.when(eid % 3 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
        F.when(eid % 5 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.col("props"),
    )


EVENTS_WITH_NULLS_SQL = """
SELECT event_id,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
       props
FROM events
"""


def dirty_labels(events: DataFrame) -> DataFrame:
    """event_type with padding/case defects and some nulls (a dirty label column)."""
    eid, et = F.col("event_id"), F.col("event_type")
    dirty = (F.when(eid % 11 == 0, F.lit(None))
             .when(eid % 7 == 0, F.concat(F.lit(" "), et, F.lit(" ")))
             .when(eid % 7 == 1, F.upper(et))
             .otherwise(et))
    return events.select(eid, dirty.alias("attack_cat"))


DIRTY_LABELS_SQL = """
SELECT event_id,
       CASE WHEN event_id % 11 = 0 THEN NULL
            WHEN event_id % 7 = 0 THEN ' ' || event_type || ' '
            WHEN event_id % 7 = 1 THEN upper(event_type)
            ELSE event_type END AS attack_cat
FROM events
"""

# Canonicalisation map for the dirty event labels (only some defects are mapped;
# unmapped ones must pass through unchanged).
EVENT_CANONICAL = {" click ": "click", " view ": "view", "ERROR": "error", "SIGNUP": "signup"}


def predictions(events: DataFrame) -> DataFrame:
    """(label, prediction) pairs: label = event class; prediction deliberately wrong
    on some rows (shifted class, or collapsed to class 0)."""
    eid = F.col("event_id")
    label = event_class()
    pred = (F.when(eid % 5 == 0, (label + 1) % 5)
            .when(eid % 7 == 0, F.lit(0.0))
            .otherwise(label))
    return events.select(eid, label.alias("label"), pred.alias("prediction"))


def _sql_event_class(col: str = "event_type") -> str:
    whens = " ".join(f"WHEN {col} = '{n}' THEN {float(i)}" for i, n in enumerate(EVENT_CLASSES))
    return f"CASE {whens} END"


PREDICTIONS_SQL = f"""
SELECT event_id, label,
       CASE WHEN event_id % 5 = 0 THEN CAST((label + 1) % 5 AS DOUBLE)
            WHEN event_id % 7 = 0 THEN 0.0 ELSE label END AS prediction
FROM (SELECT event_id, {_sql_event_class()} AS label FROM events)
"""


def orders_with_nulls(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        k,
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"),
    )


ORDERS_WITH_NULLS_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS priority
FROM orders
"""


PARSED_MESSAGES_SQL = """
SELECT msg_id,
       CASE WHEN bad THEN NULL ELSE '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.1' END AS srcip,
       CASE WHEN bad OR event_id % 17 = 0 THEN NULL ELSE CAST(user_id AS INTEGER) END AS sport,
       CASE WHEN bad THEN NULL ELSE '192.0.2.3' END AS dstip,
       CASE WHEN bad THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS dsport,
       CASE WHEN bad THEN NULL ELSE event_type END AS proto,
       CASE WHEN bad THEN NULL ELSE value END AS dur,
       CASE WHEN bad THEN NULL WHEN event_id % 19 = 0 THEN 3000000000 ELSE CAST(event_id AS BIGINT) END AS sbytes,
       CASE WHEN bad THEN NULL ELSE CAST(event_id % 1000 AS BIGINT) END AS dbytes,
       CASE WHEN bad THEN NULL WHEN event_id % 3 = 0 THEN 'http' WHEN event_id % 3 = 1 THEN 'dns' END AS service,
       CASE WHEN bad THEN NULL ELSE CAST(user_id % 7 + 1 AS INTEGER) END AS Spkts,
       CASE WHEN bad THEN NULL ELSE CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS INTEGER) END AS Dpkts,
       CASE WHEN bad OR event_id % 23 <> 0 THEN NULL ELSE '["a"]' END AS tunnel_parents,
       NOT bad AS parse_ok
FROM (SELECT event_id AS msg_id, *, (event_id % 13 = 0 OR event_id % 29 = 0) AS bad FROM events)
"""


def flows_from_events(events: DataFrame) -> DataFrame:
    """A zeek-profile flow table from events (same field rule as :func:`conn_messages`),
    with an attack label that depends on the duration, null = normal traffic."""
    eid = F.col("event_id")
    dur = F.col("value")
    attack = (F.when(dur < 5, F.lit("Generic")).when(dur < 20, F.lit("Exploits"))
              .when(dur < 60, F.lit("Fuzzers")))
    return events.select(
        eid,
        F.col("user_id").cast("int").alias("sport"),
        props_k().alias("dsport"),
        F.col("event_type").alias("proto"),
        dur.alias("dur"),
        eid.cast("int").alias("sbytes"),
        (eid % 1000).cast("int").alias("dbytes"),
        F.when(eid % 3 == 0, F.lit("http")).when(eid % 3 == 1, F.lit("dns")).alias("service"),
        (F.col("user_id") % 7 + 1).cast("int").alias("Spkts"),
        (props_k() % 5).cast("int").alias("Dpkts"),
        attack.alias("attack_cat"),
    )


# Naive Bayes input: non-negative lineitem features, return flag as class.
BAYES_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def bayes_frame(lineitem: DataFrame) -> DataFrame:
    expr = None
    for i, name in enumerate(RETURNFLAG_CLASSES):
        cond = F.col("l_returnflag") == F.lit(name)
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    return lineitem.select("l_orderkey", "l_linenumber", expr.alias("label"),
                           *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(BAYES_FEATURES)])


def _bayes_sql() -> str:
    whens = " ".join(f"WHEN '{n}' THEN {float(i)}" for i, n in enumerate(RETURNFLAG_CLASSES))
    feats = ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(BAYES_FEATURES))
    d = len(BAYES_FEATURES)
    sums = ", ".join(f"sum(f{i}) AS s{i}" for i in range(d))
    total = " + ".join(f"s{i}" for i in range(d))
    thetas = ", ".join(f"ln(s{i} + 1) - ln({total} + {d}) AS t{i}" for i in range(d))
    return f"""
WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag {whens} END AS label, {feats}
           FROM lineitem),
agg AS (SELECT label, count(*) AS n, {sums} FROM t GROUP BY label),
tot AS (SELECT sum(n) AS big_n, count(*) AS c FROM agg),
par AS (SELECT label, ln(n + 1) - ln(big_n + c) AS pi, {thetas} FROM agg, tot)
"""


BAYES_SQL = _bayes_sql()


def _dirty_attack():
    v = F.col("value")
    return (F.when(v < 5, F.lit("Generic")).when(v < 20, F.lit(" Fuzzers "))
            .when(v < 40, F.lit("Backdoor")).when(v < 60, F.lit(" Reconnaissance "))
            .otherwise(F.lit("")))


def raw_flow_lines(events: DataFrame) -> DataFrame:
    """Headerless 49-column raw flow lines (the workflow's input layout) from events,
    with dirty attack labels, empty label = normal traffic, and some hex ports
    (malformed, to be rejected)."""
    from flowml.schema import RAW_FLOW_DDL, ddl_to_struct
    eid = F.col("event_id")
    sport = F.when(eid % 101 == 0, F.concat(F.lit("0x"), F.hex(F.col("user_id")))) \
        .otherwise(F.col("user_id").cast("string"))
    known = {
        "srcip": F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit(".1")),
        "sport": sport,
        "dstip": F.lit("192.0.2.3"),
        "dsport": props_k().cast("string"),
        "proto": F.col("event_type"),
        "state": F.when(eid % 4 == 0, F.lit("CON")).otherwise(F.lit("FIN")),
        "sttl": (eid % 64).cast("string"),
        "sloss": (eid % 5).cast("string"),
        "Sload": (F.col("value") * 2).cast("string"),
        "dur": F.col("value").cast("string"),
        "sbytes": eid.cast("string"),
        "dbytes": (eid % 1000).cast("string"),
        "service": F.when(eid % 3 == 0, F.lit("http")).when(eid % 3 == 1, F.lit("dns"))
                    .otherwise(F.lit("-")),
        "Spkts": (F.col("user_id") % 7 + 1).cast("string"),
        "Dpkts": (props_k() % 5).cast("string"),
        "attack_cat": _dirty_attack(),
        "label": F.when(F.col("value") < 60, F.lit("1")).otherwise(F.lit("0")),
    }
    toks = []
    for f in ddl_to_struct(RAW_FLOW_DDL).fields:
        default = "0" if f.dataType.simpleString() == "int" else "0.0"
        toks.append(known.get(f.name, F.lit(default)))
    return events.select(F.concat_ws(",", *toks).alias("value"))


BALANCED_HISTOGRAM_SQL = """
WITH f AS (SELECT CASE WHEN value < 5 THEN 'Generic' WHEN value < 20 THEN ' Fuzzers'
                       WHEN value < 40 THEN 'Backdoors' WHEN value < 60 THEN 'Reconnaissance' END AS v
           FROM events WHERE event_id % 101 <> 0),
c AS (SELECT v, count(*) AS n FROM f GROUP BY v),
idx AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS i FROM c WHERE v IS NOT NULL)
SELECT CAST(i AS DOUBLE) AS attack_cat_index, (SELECT max(n) FROM c) AS n FROM idx
UNION ALL
SELECT CAST((SELECT count(*) FROM idx) AS DOUBLE) AS attack_cat_index, (SELECT max(n) FROM c) AS n
FROM c WHERE v IS NULL
"""
