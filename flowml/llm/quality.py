"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed words, their hashed character
n-grams (3 to 5), and a repeat mark for each word equal to the one before it; a softmax layer
gives the class. Vectors and layer are trained together by stochastic gradient descent in
numpy, on the driver, on a sample of labelled rows that is bounded by ``SAMPLE_ROWS`` (about)
and ``SAMPLE_CHARS`` (a longer text is not used for training). Scoring covers every document
and whole texts: with two classes the vectors collapse to one weight per feature, and each
task sums the weights of its words.

Defined results: null and empty text have no features and score the trained layer's bias;
rows without a label, or with a null one, are not learned from; with labels of one class only
the score is that class for all, with none 0.5; rows that repeat an id are scored each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowml.functions.hashing import hash_u32
from flowml.llm.common import fold, table
from flowml.llm.ngrams import WordTable, document_bag

BITS = 18
SIZES = (3, 4, 5)
DIM = 16
EPOCHS = 6
BATCH = 32
RATE = 0.4
#: Bounds of the training sample: labelled rows (about), and characters of a text.
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 50_000
THRESHOLD = 0.3
FOLDS = 5
_REPEAT = 1 << BITS  # the feature after the hashed ones


@dataclass(frozen=True)
class Model:
    """``weights[f]``: what feature f adds to the log-odds of class 1, before averaging."""
    weights: np.ndarray
    bias: float


def _repeats(words: list[str]) -> int:
    return sum(map(str.__eq__, words[1:], words))


def train(texts: list[str], labels: list[int], seed: int = 11) -> Model:
    """Vectors (features x DIM) and a two-class softmax layer, by Adagrad-scaled SGD."""
    kinds = set(labels)
    if len(kinds) < 2:
        sure = {frozenset(): 0.0, frozenset({0}): -30.0, frozenset({1}): 30.0}[frozenset(kinds)]
        return Model(np.zeros(_REPEAT + 1, np.float32), sure)
    bags = []
    for text in texts:
        words = text.split()
        ids, counts = document_bag(words, SIZES, BITS, True)
        again = _repeats(words)
        total = counts.sum() + again
        if again:
            ids, counts = np.append(ids, _REPEAT), np.append(counts, again)
        bags.append((ids.astype(np.int32), (counts / max(total, 1)).astype(np.float32)))
    y = np.asarray(labels)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (_REPEAT + 1, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    layer[:, 1] = rng.normal(0, 0.5, DIM)
    layer[:, 0] = -layer[:, 1]
    seen_v, seen_l, seen_b = np.full((_REPEAT + 1, 1), 1e-6, np.float32), np.full_like(layer, 1e-6), np.full(2, 1e-6, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            ids = np.concatenate([bags[i][0] for i in chosen])
            share = np.concatenate([bags[i][1] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(bags[i][0]) for i in chosen])
            found, inverse = np.unique(ids, return_inverse=True)
            part = vectors[found]
            hidden = np.stack([np.bincount(row, share * part[inverse, k], len(chosen)) for k in range(DIM)], 1)
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            p /= len(chosen)
            back = p @ layer.T
            grad = np.stack([np.bincount(inverse, share * back[row, k], len(found)) for k in range(DIM)], 1)
            seen_v[found] += (grad ** 2).mean(1, keepdims=True)
            vectors[found] -= (rate * grad / np.sqrt(seen_v[found])).astype(np.float32)
            for value, seen, g in ((layer, seen_l, hidden.T @ p), (bias, seen_b, p.sum(0))):
                seen += g ** 2
                value -= (0.25 * rate * g / np.sqrt(seen)).astype(np.float32)
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """Train on about ``rows`` labelled documents outside fold 0, chosen by the hash of the id."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col, FOLDS) != 0)) \
        .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    share = min(1.0, rows / max(known.count(), 1))
    chosen = known.where(hash_u32("quality", F.col("__id")) < F.lit(share * 2.0 ** 32))
    text = F.coalesce(F.col(text_col), F.lit(""))
    sample = (docs.where((hash_u32("quality", F.col(id_col)) < F.lit(share * 2.0 ** 32)) & (fold(id_col, FOLDS) != 0)
                         & (F.length(text) <= SAMPLE_CHARS))
              .select(F.col(id_col).alias("__id"), text.alias("__text"))
              .join(chosen, "__id").select("__id", "__text", "__label").toPandas()
              .sort_values(["__id", "__text", "__label"], kind="stable"))
    return train(sample["__text"].tolist(), sample["__label"].tolist())


def _scorer(shared):
    """A function from texts to scores, with the model and a word table of the task's own."""
    weights, bias = shared.value
    words_of = WordTable(weights[:_REPEAT, None], SIZES, BITS, True)

    def scores(texts: list) -> np.ndarray:
        odds = []
        for text in texts:
            words = (text or "").split()
            if not words:
                odds.append(bias)
                continue
            at = words_of.places(words)
            again = int((at[1:] == at[:-1]).sum())
            sums = words_of.rows[at].sum(0, dtype=np.float64)
            odds.append(bias + (sums[0] + again * weights[_REPEAT]) / (sums[1] + again))
        return 1 / (1 + np.exp(-np.clip(np.asarray(odds, float), -60, 60)))

    return scores


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; the model travels as a broadcast of about one megabyte."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(shared)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1).to_pylist()), pa.float64())],
                                             names=["id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(shared)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at).to_pylist()) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted to be of label 0 go."""
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
