"""Models (H1-H5) and artefact persistence.

The workflow's encoders, assembler and classifier are bundled in one
``PipelineModel`` so that one save/load moves everything the scorer needs.
Training is ``pyspark.ml`` (distributed; per-level statistics aggregated by
Spark). The training set is persisted around ``fit`` because tree learners scan
it once per level.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, MultilayerPerceptronClassifier,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowml.operators import tree_learner
from flowml.operators.features import assembler, encoder
from flowml.schema import MLP_HIDDEN, PROFILES, TREE_PARAMS, Profile
from flowml.session import materialise, scratch_dropped

KINDS = ("tree", "forest", "bayes", "mlp")
#: Training rows of a partition, on average.
ROWS_PER_PARTITION = 25_000
#: Histograms that MLlib's tree learner may move, at most: a node for every row of every tree.
MLLIB_HISTOGRAM_BYTES = 16 << 30


def _training_set(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Persist the training set once, in a layout that depends on the rows alone.

    Rows go to as many partitions as their number asks for, by a hash of their columns, and
    are sorted inside: neither the core count, nor a session setting, nor the order in which
    the input was read changes the fitted model. Learners make one pass of all partitions per
    level or iteration, so small partitions cost more than they save. The rows are read from
    scratch that the caller drops once the model is fitted.
    """
    kept = materialise(df, "training-rows")
    n = max(1, -(-kept.count() // rows_per_partition))
    place = F.xxhash64(*[c if not isinstance(df.schema[c].dataType, VectorUDT) else vector_to_array(c)
                         for c in df.columns])
    placed = (kept.withColumn("_place", place).repartition(n, "_place").sortWithinPartitions("_place")
              .drop("_place").persist(StorageLevel.MEMORY_AND_DISK))
    placed.count()
    return placed


def _memory_mb(text: str | None, default_mb: int = 1024) -> int:
    if not text:
        return default_mb
    t = text.strip().lower()
    units = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}
    if t[-1] == "b":
        t = t[:-1]
    if t and t[-1] in units:
        return int(float(t[:-1]) * units[t[-1]])
    return int(int(t) / (1024 * 1024))


def tree_memory_budget(spark) -> int:
    """Per-task histogram budget (``maxMemoryInMB``) for tree learners.

    A quarter of an executor's heap shared by its concurrent tasks, at least 16 MB. Local
    mode runs tasks in the driver. The budget sets how many nodes a pass handles, not the model.
    """
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local")
    heap = _memory_mb(conf.get("spark.driver.memory" if local else "spark.executor.memory", None))
    slots = spark.sparkContext.defaultParallelism if local else int(conf.get("spark.executor.cores", "1"))
    return int(max(16, heap * 0.25 / max(1, slots)))


def classifier(kind: str, label: str = "attack_cat_index", features: str = "features",
               n_features: int | None = None, n_classes: int | None = None, **params):
    """An unfitted classifier with the workflow's parameters as defaults."""
    common = {"labelCol": label, "featuresCol": features, "predictionCol": "prediction"}
    if kind == "tree":
        return DecisionTreeClassifier(**{**common, **TREE_PARAMS, **params})
    if kind == "forest":
        defaults = {**TREE_PARAMS, "featureSubsetStrategy": "all", "numTrees": 20}
        return RandomForestClassifier(**{**common, **defaults, **params})
    if kind == "bayes":
        return NaiveBayes(**{**common, "modelType": "multinomial", "smoothing": 1.0, **params})
    if kind == "mlp":
        layers = params.pop("layers", None)
        if layers is None:
            if n_features is None or n_classes is None:
                raise ValueError("mlp needs layers, or n_features and n_classes")
            layers = [n_features, *MLP_HIDDEN, n_classes]
        if n_features is not None and layers[0] != n_features:
            raise ValueError(f"mlp input layer {layers[0]} != feature width {n_features}")
        defaults = {"seed": 1234, "maxIter": 100, "blockSize": 128}
        return MultilayerPerceptronClassifier(**{**common, **defaults, **params, "layers": layers})
    raise ValueError(f"unknown model kind {kind!r}; expected one of {KINDS}")


def train(kind: str, df: DataFrame, label: str = "attack_cat_index", features: str = "features",
          n_classes: int | None = None, persist: bool = True, rows_per_partition: int = ROWS_PER_PARTITION,
          **params):
    """H1-H4: fit a classifier on an assembled frame. ``rows_per_partition``: see ``_training_set``."""
    n_features = None
    if kind == "mlp":
        n_features = len(df.select(features).first()[0])
    if kind in ("tree", "forest") and "maxMemoryInMB" not in params:
        params["maxMemoryInMB"] = tree_memory_budget(df.sparkSession)
    est = classifier(kind, label, features, n_features=n_features, n_classes=n_classes, **params)
    data = df.select(label, features)
    with scratch_dropped(df.sparkSession):
        if persist:
            data = _training_set(data, rows_per_partition)
        try:
            return _fit(est, data)
        finally:
            if persist:
                data.unpersist()


def _fit(est, data: DataFrame):
    """Fit a classifier. Trees whose histograms would outgrow ``MLLIB_HISTOGRAM_BYTES`` with
    MLlib's learner are grown by :mod:`flowml.operators.tree_learner`; the model is of the same class."""
    if est.hasParam("maxDepth") and tree_learner.can_fit(est):
        rows = data.agg(F.count(F.lit(1)), F.max(est.getLabelCol())).first()
        if rows[0]:
            width = len(data.select(vector_to_array(est.getFeaturesCol())).first()[0])
            trees = est.getNumTrees() if est.hasParam("numTrees") else 1
            nodes = min(2 * rows[0], 2 ** (est.getMaxDepth() + 1)) * trees
            if nodes * width * est.getMaxBins() * (int(rows[1] or 0) + 1) * 8 > MLLIB_HISTOGRAM_BYTES:
                return tree_learner.fit_model(est, data)
    # A copy has no training summary: that holds the session, which can't be sent to tasks once it observes metrics.
    return est.fit(data).copy()


def flow_pipeline(profile: str | Profile = "zeek", kind: str = "forest", label: str = "attack_cat",
                  encode: bool = True, n_classes: int | None = None, **params) -> Pipeline:
    """Encoders + assembler + classifier for a feature profile, as one Pipeline."""
    prof = PROFILES[profile] if isinstance(profile, str) else profile
    stages = []
    if encode:
        stages.append(encoder(list(prof.strings)))
    stages.append(assembler(list(prof.vector)))
    stages.append(classifier(kind, f"{label}_index" if encode else label,
                             n_features=prof.width, n_classes=n_classes, **params))
    return Pipeline(stages=stages)


def fit_flow_pipeline(df: DataFrame, profile: str | Profile = "zeek", kind: str = "forest",
                      label: str = "attack_cat", encode: bool = True, **params) -> PipelineModel:
    n_classes = None
    if kind == "mlp":
        if encode:
            # Null is not a class; the encoder adds one bucket for values it does not know.
            n_classes = df.select(label).where(F.col(label).isNotNull()).distinct().count() + 1
        else:
            n_classes = int(df.agg({label: "max"}).first()[0]) + 1
    if kind in ("tree", "forest") and "maxMemoryInMB" not in params:
        params["maxMemoryInMB"] = tree_memory_budget(df.sparkSession)
    pipe = flow_pipeline(profile, kind, label, encode, n_classes=n_classes, **params)
    prof = PROFILES[profile] if isinstance(profile, str) else profile
    needed = set(prof.strings) | set(prof.vector) | {label}
    *before, est = pipe.getStages()
    with scratch_dropped(df.sparkSession):
        data = _training_set(df.select(*[c for c in df.columns if c in needed]))
        try:
            first = Pipeline(stages=before).fit(data)
            prepared = first.transform(data).select(est.getLabelCol(), est.getFeaturesCol())
            return PipelineModel(stages=[*first.stages, _fit(est, prepared)])
        finally:
            data.unpersist()


def save_pipeline(model: PipelineModel, path: str) -> str:
    """Persist encoders, assembler and classifier together (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    """A6."""
    return PipelineModel.load(path)


def score(df: DataFrame, model) -> DataFrame:
    """H5: apply a fitted model or pipeline (batch or streaming frame)."""
    return model.transform(df)


def bayes_parameters(model) -> tuple[list[float], list[list[float]]]:
    """(pi, theta) of a fitted multinomial naive Bayes model (classes x features)."""
    pi = model.pi.toArray().tolist()
    theta = model.theta.toArray().tolist()
    return pi, theta
