"""Rules that results must keep at any size and on any cluster layout."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowml.operators import features, metrics, models, sampling
from flowml.operators.smote import smote, synthesize
from flowml.plans.workflow import with_row_key
from flowml.schema import ENCODED_FLOW_DDL
from flowml.sources import read_flows


def points(spark, sizes, dims=2, bad=0.0):
    rng = np.random.default_rng(0)
    rows, n = [], 0
    for c, m in sizes.items():
        for _ in range(m):
            rows.append((n, c, *[float(v) for v in rng.normal(size=dims)]))
            n += 1
    if bad != 0.0:
        rows[-1] = (*rows[-1][:2], bad, *rows[-1][3:])
    return spark.createDataFrame(rows, "id long, label int, " + ", ".join(f"x{i} double" for i in range(dims)))


def test_draws_are_never_joined_shuffled_or_broadcast(spark):
    syn = synthesize(points(spark, {0: 3000, 1: 20}), "label", ["x0", "x1"], "id")
    lines = syn._jdf.queryExecution().executedPlan().toString().splitlines()
    first = next(i for i, line in enumerate(lines) if "Generate" in line)
    assert not any("Join" in x or "Exchange" in x for x in lines[:first])
    assert "draw" in lines[first] and syn.count() == 2980


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
def test_missing_values_raise_or_are_dropped(spark, bad):
    df = points(spark, {0: 40, 1: 10}, bad=bad)
    with pytest.raises(ValueError):
        smote(df, "label", ["x0", "x1"], "id")
    out = smote(df, "label", ["x0", "x1"], "id", on_null="drop")
    # Nine usable rows of class 1 are filled up to 40; the row left out stays in the table.
    assert {r.label: r.n for r in metrics.class_histogram(out, "label").collect()} == {0: 40, 1: 41}


def test_long_columns_stay_long(spark):
    df = points(spark, {0: 20, 1: 5}).withColumn("x0", (F.col("id") + 3_000_000_000).cast("long"))
    out = smote(df, "label", ["x0", "x1"], "id", int_cols=["x0"])
    assert dict(out.dtypes)["x0"] == "bigint" and out.where("x0 < 3000000000").count() == 0


def test_report_covers_labels_that_are_not_listed(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (7.0, 0.0), (7.0, 1.0), (None, 1.0)],
                               "label double, prediction double")
    total = metrics.overall_metrics(df).first()
    report = metrics.evaluation_report(df, [0.0, 1.0]).collect()
    assert [r.label for r in sorted(report)] == [0.0, 1.0]
    for r in report:
        assert math.isclose(r.accuracy, 0.4) and r.accuracy == total.accuracy
        assert r.weighted_precision == total.weighted_precision and r.weighted_f1 == total.f1
        assert r.weighted_recall == total.weighted_recall


def test_confusion_matrix_keeps_unlisted_predictions(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 5.0), (9.0, 1.0)], "label double, prediction double")
    got = {r.label: (r.no, r.yes, r.rest) for r in
           metrics.confusion_wide(df, [0.0, 1.0], names=["no", "yes"], other="rest").collect()}
    assert got == {"no": (1, 0, 1), "9.0": (0, 1, 0)}
    with pytest.raises(Exception, match="outside the listed classes"):
        metrics.confusion_wide(df, [0.0, 1.0]).collect()


def test_forest_does_not_depend_on_layout(spark):
    df = features.assemble(points(spark, {0: 300, 1: 200, 2: 100}, dims=4), [f"x{i}" for i in range(4)]) \
        .withColumn("label", F.col("label").cast("double"))
    a, b = (models.train("forest", d, label="label", numTrees=3, maxDepth=6, rows_per_partition=200)
            for d in (df.repartition(1), df.orderBy("x0").repartition(7)))
    assert a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1]


def test_mlp_has_one_output_for_each_label_and_the_keep_bucket(spark):
    names = [f"c{i}" for i in range(9)] + [None]
    rows = [(i, i % 50, ["tcp", "udp"][i % 2], i / 7, i, i, ["dns", None][i % 2], i % 5, i % 3, names[i % 10])
            for i in range(60)]
    df = spark.createDataFrame(rows, "sport int, dsport int, proto string, dur double, sbytes int, dbytes int, "
                                     "service string, Spkts int, Dpkts int, attack_cat string")
    model = models.fit_flow_pipeline(df, "zeek", "mlp", maxIter=1)
    assert model.stages[-1].getLayers() == [9, 9, 9, 10]


def test_blank_lines_are_not_rows(spark, tmp_path):
    path = tmp_path / "flows.csv"
    line = "1,2,0.0,1.5,3,4,0.0,5,6,1.0"
    path.write_text(f"{line}\n\n   \n\t\n{line}\nx\n")
    assert read_flows(spark, str(path), ENCODED_FLOW_DDL).count() == 2


def test_row_keys_do_not_depend_on_layout(spark):
    df = spark.createDataFrame([(i % 7, None if i % 3 else "a") for i in range(100)], "x int, y string")
    a = sorted(r._row for r in with_row_key(df.repartition(5)).collect())
    b = sorted(r._row for r in with_row_key(df.orderBy("x").coalesce(1)).collect())
    assert a == b and len(set(a)) == 100


def test_trimmed_labels_and_named_null_class(spark):
    from flowml.operators import clean
    from flowml.plans.workflow import balance
    df = spark.createDataFrame([(" Fuzzers ",), ("Backdoor",), (" x ",), (None,)], "attack_cat string")
    got = [r[0] for r in clean.canonicalise(df, trim=True).collect()]
    assert got == ["Fuzzers", "Backdoors", "x", None]
    rows = [(i, i % 50, ["tcp", "udp"][i % 2], i / 7, i, i, "dns", i % 5, i % 3, ["Worms", None, None][i % 3]) for i in range(60)]
    flows = spark.createDataFrame(rows, "sport int, dsport int, proto string, dur double, sbytes int, dbytes int, "
                                        "service string, Spkts int, Dpkts int, attack_cat string")
    out, encoders = balance(flows, null_label="normal")
    assert list(encoders.labelsArray[-1]) == ["normal", "Worms"]
    assert {r.attack_cat_index: r.n for r in metrics.class_histogram(out, "attack_cat_index").collect()} == {0.0: 40, 1.0: 40}


def test_training_part_alone_is_balanced(spark, tmp_path):
    from flowml.plans.workflow import run_train_job
    rows = [(i, i % 50, 0.0, i / 7, i, i, 0.0, i % 5, i % 3, float(i % 10 == 0)) for i in range(300)]
    path = str(tmp_path / "encoded")
    spark.createDataFrame(rows, ENCODED_FLOW_DDL).write.parquet(path)
    report, _ = run_train_job(spark, path, "tree", fmt="parquet", classes=(0.0, 1.0), balance_train=True)
    support = {r.label: r.support for r in report.collect()}
    assert 50 < support[0.0] < 110 and 2 <= support[1.0] < 20


def test_numeric_codes_lose_their_categories(spark):
    df = spark.createDataFrame([("a",), ("b",)], "proto string")
    enc = features.encode(df, features.fit_encoders(df, ["proto"]))
    attrs = lambda d: d.schema["features"].metadata["ml_attr"]["attrs"]
    assert "nominal" in attrs(features.assemble(enc, ["proto_index"]))
    assert "nominal" not in features.assemble(enc, ["proto_index"], categorical=False).schema["features"].metadata.get(
        "ml_attr", {}).get("attrs", {})


def test_rank_flag_matches_a_plain_rank(spark):
    df = spark.range(500).selectExpr("id", "cast(id % 3 as int) g")
    quotas = sampling.literal_table(spark, "g int, quota long", [(0, 10), (1, 0), (2, 1000)])
    got = sampling.rank_flag(df, "g", quotas, "id", 7).groupBy("g").agg(F.count_if("below").alias("n"), F.count("id").alias("m"))
    assert {r.g: (r.n, r.m) for r in got.collect()} == {0: (10, 167), 1: (0, 167), 2: (166, 166)}


def test_model_does_not_follow_session_settings(spark):
    rows = [(float(i % 3), float(i % 17), float((i * 7) % 23)) for i in range(600)]
    data = features.assemble(spark.createDataFrame(rows, "label double, a double, b double"), ["a", "b"])
    before, texts = spark.conf.get("spark.sql.shuffle.partitions"), set()
    try:
        for n in ("8", "16", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            model = models.train("forest", data.repartition(int(n) // 4), label="label", numTrees=3, maxDepth=8)
            texts.add(model.toDebugString.split("\n", 1)[1])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(texts) == 1


def test_every_line_is_parsed_once(spark):
    from flowml.sources.flows import parse_csv_strict
    lines = spark.createDataFrame([("1,a,2.5",), ("x,a,1",), ("",), ("3,b",)], "value string")
    good, bad = parse_csv_strict(lines, "n int, s string, d double")
    plan = good.where("n > 0").select("d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv") == 1
    assert [tuple(r) for r in good.collect()] == [(1, "a", 2.5)]
    assert sorted(r.line for r in bad.collect()) == ["3,b", "x,a,1"]
