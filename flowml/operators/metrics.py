"""Aggregations and multiclass evaluation.

Everything is derived from ONE distributed aggregation: the (label, prediction)
pair counts. That aggregation is partial (map-side combined) and its output is at
most classes x classes rows, so every later step - confusion matrix, accuracy,
weighted precision/recall/F1, per-class TPR/FPR - runs on a bounded table instead
of rescanning the predictions once per metric. Nothing is collected to the driver.

Semantics follow Spark's multiclass metrics: weights are true-class shares,
precision of a never-predicted class is 0. Where a rate is undefined (class absent
from the truth, or no negatives) the result is null instead of an exception.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowml.operators.sampling import literal_table


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """E1."""
    return df.select(col).distinct()


def code_book(df: DataFrame, col: str, index_col: str | None = None) -> DataFrame:
    """Distinct (value, index) pairs of an encoded column."""
    return df.select(col, index_col or f"{col}_index").distinct()


def row_count(df: DataFrame) -> DataFrame:
    """E3 as a one-row DataFrame (global aggregate; partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def class_histogram(df: DataFrame, label: str) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def pair_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """The single pass over predictions: counts per (label, prediction)."""
    return (df.groupBy(F.col(label).cast("double").alias("label"),
                       F.col(pred).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_long(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """E5 long form: (label, prediction, n) for every observed pair."""
    return pair_counts(df, label, pred)


def confusion_wide(df: DataFrame, classes: Sequence[float], label: str = "label",
                   pred: str = "prediction", names: Sequence[str] | None = None,
                   other: str | None = None) -> DataFrame:
    """E5 wide form: one row per actual class, one count column per predicted class.

    Classes are given, so no extra job is needed to discover pivot values; the
    pivot runs on the bounded pair table. ``names``: one per class, used on both axes
    (a label outside ``classes`` keeps its string form). Predictions outside ``classes``
    are counted in the column ``other``, where one is named; without it they raise.
    """
    cols = names or [f"pred_{int(c)}" for c in classes]
    pairs = pair_counts(df, label, pred)
    known = F.col("prediction").isin([float(c) for c in classes])
    aggs = [F.sum(F.when(F.col("prediction") == F.lit(float(c)), F.col("n")).otherwise(0))
            .cast("long").alias(n) for c, n in zip(classes, cols)]
    rest = F.sum(F.when(F.coalesce(known, F.lit(False)), 0).otherwise(F.col("n"))).cast("long")
    if other is not None:
        wide = pairs.groupBy("label").agg(*aggs, rest.alias(other))
    else:
        wide = pairs.groupBy("label").agg(*aggs, rest.alias("_rest"))
        first = F.coalesce(F.col("_rest") == 0, F.lit(True))
        checked = F.when(first, F.col(cols[0])).otherwise(
            F.raise_error(F.lit("prediction outside the listed classes")).cast("long"))
        wide = wide.withColumn(cols[0], checked).drop("_rest")
    if names is not None:
        named = F.col("label").cast("string")
        for c, n in zip(classes, names):
            named = F.when(F.col("label") == F.lit(float(c)), F.lit(n)).otherwise(named)
        wide = wide.withColumn("label", named)
    return wide


def _class_stats(pairs: DataFrame) -> DataFrame:
    """Per class: support (actual), predicted count, true positives, and total N.

    Each pair contributes to its label class and to its prediction class; one
    groupBy over the (bounded) pair table gives all three counters.
    """
    contrib = pairs.select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("actual"),
                 F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n"))
                 .otherwise(0).cast("long").alias("tp")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("actual"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
    )).alias("c")).select("c.*")
    stats = contrib.groupBy("cls").agg(F.sum("actual").alias("actual"),
                                       F.sum("predicted").alias("predicted"),
                                       F.sum("tp").alias("tp"))
    # Bounded (<= number of classes) rows: a global window is safe here.
    return stats.withColumn("total", F.sum("actual").over(Window.partitionBy()))


def per_class_rates(df: DataFrame, classes: Sequence[float] | None = None,
                    label: str = "label", pred: str = "prediction") -> DataFrame:
    """E10 + E11: TPR (= recall), FPR, precision, F1 and support per class.

    With ``classes`` given, every listed class gets a row (undefined rates null).
    """
    return _rates(_class_stats(pair_counts(df, label, pred)), classes)


def _rates(stats: DataFrame, classes: Sequence[float] | None) -> DataFrame:
    if classes is not None:
        wanted = literal_table(stats.sparkSession, "cls double", [(float(c),) for c in classes])
        # Both sides are bounded by the class count; ``total`` already covers all rows.
        stats = (wanted.join(F.broadcast(stats), "cls", "left")
                 .withColumn("total", F.max("total").over(Window.partitionBy())))
        stats = stats.na.fill(0, subset=["actual", "predicted", "tp"])
    tp, actual, predicted, total = (F.col("tp"), F.col("actual"), F.col("predicted"),
                                    F.col("total"))
    fp = predicted - tp
    negatives = total - actual
    precision = F.when(predicted > 0, tp / predicted).otherwise(F.lit(0.0))
    recall = F.when(actual > 0, tp / actual)
    f1 = F.when(actual > 0, F.when(precision + recall > 0,
                                   2 * precision * recall / (precision + recall))
                .otherwise(F.lit(0.0)))
    return stats.select(
        F.col("cls").alias("label"),
        actual.cast("long").alias("support"),
        recall.alias("tpr"),
        F.when(negatives > 0, fp / negatives).alias("fpr"),
        F.when(actual > 0, precision).alias("precision"),
        f1.alias("f1"),
    )


def overall_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, weighted precision, weighted recall, weighted F1 in one row."""
    return _overall(_class_stats(pair_counts(df, label, pred)))


def overall_from_pairs(pairs: DataFrame) -> DataFrame:
    """:func:`overall_metrics` from (label, prediction, n) counts taken elsewhere."""
    return _overall(_class_stats(pairs))


def _overall(stats: DataFrame) -> DataFrame:
    tp, actual, predicted, total = (F.col("tp"), F.col("actual"), F.col("predicted"),
                                    F.col("total"))
    precision = F.when(predicted > 0, tp / predicted).otherwise(F.lit(0.0))
    recall = tp / actual
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)) \
        .otherwise(F.lit(0.0))
    w = actual / total
    return stats.filter(actual > 0).agg(
        (F.sum(tp) / F.max(total)).alias("accuracy"),
        F.sum(precision * w).alias("weighted_precision"),
        F.sum(recall * w).alias("weighted_recall"),
        F.sum(f1 * w).alias("f1"),
    )


def evaluation_report(df: DataFrame, classes: Sequence[float], label: str = "label",
                      pred: str = "prediction", names: Sequence[str] | None = None) -> DataFrame:
    """Per-class rates of the listed classes with the overall metrics on every row.

    ``names``: the classes' names, in the order of ``classes``; they become the column ``name``.

    The overall metrics cover every row of ``df``, also those whose label is not listed:
    they are :func:`overall_metrics`, computed from the same (label, prediction) counts.
    """
    stats = _class_stats(pair_counts(df, label, pred))
    total = _overall(stats).withColumnRenamed("f1", "weighted_f1")
    rates = _rates(stats, classes)
    if names is not None:
        pairs = [F.lit(x) for c, n in zip(classes, names, strict=True) for x in (float(c), n)]
        rates = rates.withColumn("name", F.create_map(*pairs)[F.col("label")])
    # One row: attached by a broadcast join on a constant.
    return rates.withColumn("_one", F.lit(1)).join(
        F.broadcast(total.withColumn("_one", F.lit(1))), "_one", "left").drop("_one")
