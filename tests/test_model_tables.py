import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flowml.operators import features, model_tables, models
from flowml.session import scratch_path


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(float((i * i) % 4), float(i % 17), float((i * 7) % 23), ["a", "b", "c", None][i % 4]) for i in range(700)]
    df = spark.createDataFrame(rows, "label double, a double, b double, s string")
    enc = features.encode(df, features.fit_encoders(df, ["s"]))
    return features.assemble(enc, ["a", "b", "s_index"]).withColumn("x", vector_to_array("features")).persist()


def differing(got):
    return got.where(~F.col("prediction").eqNullSafe(F.col("table"))).count()


@pytest.mark.parametrize("kind,params", [("tree", {"maxDepth": 6}), ("forest", {"numTrees": 5, "maxDepth": 5}),
                                         ("tree", {"maxDepth": 0})])
def test_node_table_equals_transform(spark, frame, kind, params):
    model = models.train(kind, frame, label="label", **params)
    path = scratch_path(spark, "tree-model")
    model.write().overwrite().save(path)
    nodes = model_tables.tree_nodes(spark, path)
    got = model_tables.with_tree_prediction(model.transform(frame), nodes, "x", "table")
    assert differing(got) == 0
    assert kind == "forest" or nodes.where("categories >= 0").count() > 0 or params["maxDepth"] == 0


def test_dense_layers_equal_transform(spark, frame):
    model = models.train("mlp", frame, label="label", n_classes=4, maxIter=20)
    path = scratch_path(spark, "mlp-model")
    model.write().overwrite().save(path)
    layers = model_tables.dense_layers(spark, path)
    assert [(r.layer, r.n, r.w) for r in layers.groupBy("layer").agg(
        F.count("out").alias("n"), F.max(F.size("weights")).alias("w")).orderBy("layer").collect()] == [
        (0, 9, 3), (1, 9, 9), (2, 4, 9)]
    assert differing(model_tables.with_dense_prediction(model.transform(frame), layers, "x", "table")) == 0


@pytest.mark.parametrize("kind,params", [("forest", {"numTrees": 2}), ("mlp", {"maxIter": 2, "n_classes": 2})])
def test_models_of_two_classes_score_after_metrics_were_observed(spark, frame, kind, params):
    """Before, a forest's training summary took the session, with its observations, into the tasks."""
    seen = Observation("rows")
    frame.where("label is not null").observe(seen, F.count(F.lit(1)).alias("n")).count()
    model = models.train(kind, frame.withColumn("label", F.col("label") % 2), label="label", **params)
    assert seen.get["n"] == 700 and not getattr(model, "hasSummary", False)
    assert model.transform(frame).where("prediction >= 0").count() == 700
