"""Writing jobs: quarantine, large vocabularies, observed metrics, tables by class, ledger."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from flowml.operators import features, metrics
from flowml.operators import quarantine as Q
from flowml.operators.observed import write_observed
from flowml.operators.smote import synthesize
from flowml.operators.vocabulary import encode_by_table, fit_vocabulary
from flowml.session import scratch_path
from flowml.sinks.classes import class_sizes, read_classes, write_classes
from flowml.streaming.ledger import read_alerts, read_ledger, start_ledgered


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


LINES = {
    "1,2,a,0.5": None,
    ",,,": None,
    '3,4,"x,y",1': None,
    "": "blank", " \t": "blank",
    "1,0x1f,a,0.5": ("type", "user_id", "0x1f"),
    "z,0x1f,a,q": ("type", "event_id", "z"),
    "1,2,a,q": ("type", "value", "q"),
    "1,80.0,a,1": ("type", "user_id", "80.0"),
    "1,2,a": ("columns", None, "3"),
    '1,x,"a,b"': ("columns", None, "3"),
    "1,2,a,1,": ("columns", None, "5"),
    "only": ("columns", None, "1"),
}


def test_lines_name_the_failing_field(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    checked = Q.check_lines(lines, "event_id long, user_id int, event_type string, value double")
    path = Q.write_split(checked, scratch_path(spark, "lines"))
    bad = {r["raw"]: (r["reason"], r["field"], r["token"]) for r in Q.read_quarantine(spark, path, checked.schema).collect()}
    assert bad == {k: v for k, v in LINES.items() if isinstance(v, tuple)}
    good = {tuple(r) for r in Q.read_accepted(spark, path, checked.schema).collect()}
    assert good == {(1, 2, "a", 0.5), (None, None, None, None), (3, 4, "x,y", 1.0)}


def test_split_is_one_pass_and_reads_by_partition(spark):
    lines = spark.createDataFrame([("1,2",), ("3,4",)], "value string")
    checked = Q.check_lines(lines, "a int, b int")
    path = Q.write_split(checked, scratch_path(spark, "lines"))
    bad = Q.read_quarantine(spark, path, checked.schema)
    assert bad.count() == 0
    assert "PartitionFilters: [isnotnull(accepted" in plan_of(bad)
    with pytest.raises(ValueError):
        Q.check_lines(lines, "fault int, b int")


MESSAGES = {
    '{"conn": {"id.orig_p": 5, "proto": "tcp"}}': None,
    '{"conn": {}}': None,
    '{"conn": {"id.orig_p": "x"}}': ("type", "conn.id.orig_p", "x"),
    '{"conn": {"id.orig_p": "x", "duration": "y"}}': ("type", "conn.id.orig_p", "x"),
    '{"conn": null}': ("missing", "conn", None),
    '{"version": "1"}': ("missing", "conn", None),
    '{"conn": {"id.orig_p": 5}': ("not_json", None, None),
    "[1]": ("not_json", None, None),
    "7": ("not_json", None, None),
    "": ("not_json", None, None),
    None: ("not_json", None, None),
}


def test_messages_name_the_failing_field(spark):
    rows = list(enumerate(MESSAGES.items()))
    frame = spark.createDataFrame([(i, m) for i, (m, _) in rows], "id int, value string")
    checked = Q.check_messages(frame, passthrough=["id"])
    path = Q.write_split(checked, scratch_path(spark, "messages"))
    bad = {r["id"]: (r["reason"], r["field"], r["token"])
           for r in Q.read_quarantine(spark, path, checked.schema, ["id"]).collect()}
    assert bad == {i: want for i, (_, want) in rows if want}
    good = {r["id"]: r["sport"] for r in Q.read_accepted(spark, path, checked.schema).collect()}
    assert good == {0: 5, 1: None}


def test_table_encoding_equals_the_fitted_encoder(spark):
    # One value holds a third of the rows, many share a frequency, some are null or empty.
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                  .when(F.col("id") % 11 == 0, "").otherwise((F.col("id") % 400).cast("string")).alias("v"))
    vocabulary = fit_vocabulary(df, "v", range_values=50)
    got = encode_by_table(df, "v", vocabulary)
    want = features.encode(df, features.fit_encoders(df, ["v"])).withColumnRenamed("v_index", "want")
    assert got.join(want.select("id", "want"), "id").where("v_index <> want").count() == 0
    assert got.count() == 3000
    # Unseen and null values get the number of values.
    new = encode_by_table(spark.createDataFrame([("never",), (None,)], "v string"), "v", vocabulary)
    assert {r[1] for r in new.collect()} == {float(vocabulary.count())}
    empty = fit_vocabulary(df.where("id < 0"), "v")
    assert empty.count() == 0 and encode_by_table(df.limit(2), "v", empty).select("v_index").distinct().collect()[0][0] == 0.0


def test_a_million_values(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("host-"), F.col("id")).alias("v"))
    vocabulary = fit_vocabulary(df, "v", range_values=200_000)
    n, low, high, distinct = vocabulary.agg(F.count("*"), F.min("index"), F.max("index"),
                                            F.count_distinct("index")).first()
    assert (n, low, high, distinct) == (1_000_000, 0, 999_999, 1_000_000)
    # All frequencies are equal, so the order is that of the values.
    assert vocabulary.where("value = 'host-0'").first()["index"] == 0
    assert vocabulary.where("value = 'host-999999'").first()["index"] == 999_999


def test_observed_counts_equal_a_pass(spark):
    df = spark.range(1000).select((F.col("id") % 4).cast("double").alias("label"),
                                  (F.col("id") % 3).cast("double").alias("prediction"))
    path = scratch_path(spark, "observed")
    pairs = write_observed(df, path, [0, 1, 2, 3])
    written = spark.read.parquet(path)
    assert {tuple(r) for r in pairs.collect()} == {tuple(r) for r in metrics.pair_counts(written).collect()}
    assert metrics.overall_from_pairs(pairs).first() == metrics.overall_metrics(written).first()
    with pytest.raises(ValueError, match="250 rows"):
        write_observed(df, scratch_path(spark, "observed"), [0, 1, 2])
    some = write_observed(df, scratch_path(spark, "observed"), [0, 1, 2], outside="ignore")
    assert some.agg(F.sum("n")).first()[0] == 750


def test_classes_are_read_by_folder(spark):
    rows = [(i, c) for i, c in enumerate(["a", "b", "", None, "v a/b=c", "a"])]
    df = spark.createDataFrame(rows, "id int, c string")
    path = write_classes(df, scratch_path(spark, "classes"), "c")
    picked = read_classes(spark, path, only=["a", "", None])
    assert {tuple(r) for r in picked.collect()} == {(0, "a"), (5, "a"), (2, ""), (3, None)}
    plan = plan_of(picked)
    assert re.search(r"PartitionFilters: \[.*class_part", plan) and "Filter (" not in plan
    rest = read_classes(spark, path, without=["a", None])
    assert {tuple(r) for r in rest.collect()} == {(1, "b"), (2, ""), (4, "v a/b=c")}
    assert read_classes(spark, path, only=[]).count() == 0 and read_classes(spark, path).count() == 6
    assert {tuple(r) for r in class_sizes(spark, path, "c").collect()} == {("a", 2), ("b", 1), ("", 1), (None, 1), ("v a/b=c", 1)}


def test_oversampling_without_the_majority(spark):
    df = spark.range(200).select(F.col("id"), F.when(F.col("id") < 20, 1.0).when(F.col("id") < 50, 2.0).otherwise(0.0).alias("c"),
                                 F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    path = write_classes(df, scratch_path(spark, "classes"), "c")
    part = read_classes(spark, path, only=[1.0, 2.0])
    assert part.count() == 50
    cols = ["c", "base_key", "draw", "neighbour_key", "gap"]
    whole = synthesize(df, "c", ["x", "y"], "id", k=3).select(*cols)
    less = synthesize(part, "c", ["x", "y"], "id", k=3, strategy={1.0: 150, 2.0: 150}).select(*cols)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, less.collect()))


def ledger_source(spark, n=40, files=4):
    folder = scratch_path(spark, "source")
    spark.range(n).select("id", (F.col("id") % 5 > 0).alias("parse_ok")).repartition(files).write.parquet(folder)
    return spark.readStream.schema("id long, parse_ok boolean").option("maxFilesPerTrigger", "1").parquet(folder)


@pytest.mark.parametrize("at", [0, 2])
def test_a_stopped_job_ends_with_each_alert_once(spark, at):
    stream, path = ledger_source(spark), scratch_path(spark, "ledgered")
    args = {"checkpoint": f"{path}-ckpt", "trigger": {"availableNow": True}}
    calls = []

    def stop(batch):
        calls.append(batch)
        if batch == at:
            raise RuntimeError("stopped")

    with pytest.raises(StreamingQueryException):
        start_ledgered(stream, path, after_write=stop, **args).awaitTermination()
    if at:
        # The alerts of the stopped batch are there, but they do not stand.
        assert read_alerts(spark, path).select("batch").distinct().count() == at
        assert spark.read.parquet(f"{path}/alerts").select("batch").distinct().count() == at + 1
    start_ledgered(stream, path, **args).awaitTermination()
    assert sorted(r["id"] for r in read_alerts(spark, path).collect()) == list(range(40))
    ledger = read_ledger(spark, path)
    assert ledger.agg(F.count("*"), F.sum("rows"), F.sum("unreadable"), F.count_distinct("stream")).first() == (4, 40, 8, 1)
    # Nothing new: nothing written.
    start_ledgered(stream, path, **args).awaitTermination()
    assert read_ledger(spark, path).count() == 4 and calls == list(range(at + 1))


def test_a_ledger_belongs_to_its_checkpoint(spark):
    stream, path = ledger_source(spark, 10, 1), scratch_path(spark, "ledgered")
    trigger = {"availableNow": True}
    start_ledgered(stream, path, f"{path}-ckpt", trigger).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        start_ledgered(stream, path, f"{path}-other", trigger)


def test_an_entered_batch_is_left_alone(spark):
    from flowml.streaming.ledger import write_batch
    stream, path = ledger_source(spark, 10, 1), scratch_path(spark, "ledgered")
    start_ledgered(stream, path, f"{path}-ckpt", {"availableNow": True}).awaitTermination()
    replay = spark.range(3).select("id", F.lit(True).alias("parse_ok"))
    assert not write_batch(replay, 0, path, f"{path}-ckpt", {"rows": F.count("*")})
    assert read_alerts(spark, path).count() == 10
