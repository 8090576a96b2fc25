import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from flowml.operators import features, model_tables, models, tree_learner
from flowml.session import scratch_path


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(float((i * i) % 4 + (i % 3) // 2), float(i % 17), float((i * 7) % 23), ["a", "b", None, "e"][(i * i // 3) % 4],
             str((i * i // 7) % 11)) for i in range(600)]
    df = spark.createDataFrame(rows, "label double, a double, b double, s string, u string")
    enc = features.encode(df, features.fit_encoders(df, ["s", "u"]))
    return features.assemble(enc, ["a", "b", "s_index", "u_index"]).select("label", "features").coalesce(1).persist()


def saved_nodes(spark, model):
    path = scratch_path(spark, "compared-model")
    model.write().save(path)
    return model_tables.tree_nodes(spark, path).orderBy("tree", "id").collect()


@pytest.mark.parametrize("classes,local_rows", [(3, 50_000), (3, 100), (2, 100)])
def test_same_nodes_as_ml(spark, frame, monkeypatch, classes, local_rows):
    monkeypatch.setattr(tree_learner, "LOCAL_ROWS", local_rows)
    data = frame if classes > 2 else frame.withColumn("label", (F.col("label") > 1).cast("double"))
    est = models.classifier("tree", "label")
    assert saved_nodes(spark, tree_learner.fit_model(est, data)) == saved_nodes(spark, est.fit(data))


def test_large_training_sets_leave_ml_histograms(spark, frame, monkeypatch):
    asked = []
    monkeypatch.setattr(tree_learner, "fit_model", lambda est, data: asked.append(est) or est.fit(data))
    models.train("tree", frame, label="label", maxDepth=2)
    assert not asked
    monkeypatch.setattr(models, "MLLIB_HISTOGRAM_BYTES", 1 << 10)
    models.train("tree", frame, label="label", maxDepth=2)
    assert len(asked) == 1


def test_forest_is_saved_and_reproducible(spark, frame):
    est = models.classifier("forest", "label", numTrees=3, maxDepth=8)
    first, again = (tree_learner.fit_model(est, frame) for _ in range(2))
    assert first.getNumTrees == 3 and first.numClasses == 3 and first.getMaxDepth() == 8
    nodes = saved_nodes(spark, first)
    assert nodes == saved_nodes(spark, again)
    roots = [r.stats for r in nodes if r.id == 0]
    # Bootstrap counts: about as many as rows, another draw for each tree.
    assert len({tuple(r) for r in roots}) == 3 and all(500 < sum(r) < 700 for r in roots)
    path = scratch_path(spark, "forest-model")
    first.write().save(path)
    scored = first.transform(frame).withColumn("x", vector_to_array("features"))
    got = model_tables.with_tree_prediction(scored, model_tables.tree_nodes(spark, path), "x", "table")
    assert got.where("prediction <> table").count() == 0


def test_scoring_copies_no_model_into_rows(spark, frame):
    est = models.classifier("tree", "label")
    path = scratch_path(spark, "tree-model")
    est.fit(frame).write().save(path)
    rows = frame.select(vector_to_array("features").alias("x"))
    got = model_tables.with_tree_prediction(rows, model_tables.tree_nodes(spark, path), "x", "table")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan


def test_missing_values_go_right_and_null_rows_score(spark):
    rows = [(float(i % 2), [float(i % 2), float(i)]) for i in range(40)]
    data = spark.createDataFrame(rows, "label double, x array<double>").withColumn("features", array_to_vector("x"))
    path = scratch_path(spark, "tree-model")
    models.classifier("tree", "label").fit(data).write().save(path)
    odd = spark.createDataFrame([([None, 1.0],), ([float("nan"), 1.0],), (None,), ([0.0, 1.0],)], "x array<double>")
    got = model_tables.with_tree_prediction(odd, model_tables.tree_nodes(spark, path), "x", "p")
    assert [r.p for r in got.collect()] == [1.0, 1.0, 1.0, 0.0]


def test_thresholds_are_midpoints_or_equal_counts():
    assert tree_learner.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 10).tolist() == [1.5, 2.5]
    assert len(tree_learner.thresholds(np.arange(1000.0), 9)) == 9


def test_gains_are_computed_for_the_best_splits_only(monkeypatch):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 4, 3_000)
    bins = np.stack([np.clip(rng.normal(y * 3 + 20, 9), 0, 39) for _ in range(4)], 1).astype(np.uint8)
    spec = {"arity": [0] * 4, "splits": [np.arange(39.0)] * 4, "classes": 4, "impurity": "entropy", "depth": 12,
            "unordered": [False] * 4, "bins": 40}
    seen, plain = [], tree_learner._gains
    monkeypatch.setattr(tree_learner, "_gains", lambda left, *a: seen.append(left.shape[1]) or plain(left, *a))
    got, few = tree_learner.grow(bins, y, np.ones(3_000), 0, spec), sum(seen)
    seen.clear()
    monkeypatch.setattr(tree_learner, "_near_best", lambda left, whole, at, table: np.arange(len(at)))
    want = tree_learner.grow(bins, y, np.ones(3_000), 0, spec)
    assert 3 * few < sum(seen) and len(got["left"]) > 100
    assert all((got[k] == want[k]).all() for k in got if k != "set")
