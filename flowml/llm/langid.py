"""Language identification with error-correcting output codes.

Each language has a codeword of bits; for each bit a linear classifier over hashed character
n-grams (1 to 4, inside words) says how far a document lies on either side. All bit
classifiers are trained together in numpy, on the driver, on a bounded sample (about
``SAMPLE_ROWS_PER_LANG`` rows of each language, texts up to ``SAMPLE_CHARS``). Decoding is
weighted by loss: a language's cost is the sum over bits of the logistic loss of the margin
against its codeword, so unsure bits count little; the cheapest codeword wins, and a small
lead over the second marks the document as ambiguous.

Defined results: null text, and text without any letter, is ``und`` with score 0; the score is
the share of exp(-cost) that the chosen language has (1 when only one language is known); with
nothing to learn from every document is ``und``; equal costs go to the language that is first
in code point order; rows with null language are not learned from; rows that repeat an id are
predicted each; an empty table gives no rows; other columns are ignored.
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
from flowml.session import materialise

BITS = 16
SIZES = (1, 2, 3, 4)
EPOCHS = 8
BATCH = 64
RATE = 0.5
#: Bounds of the training sample, and of the languages (their table is broadcast).
MAX_LANGS = 10_000
SAMPLE_ROWS_PER_LANG = 800
SAMPLE_CHARS = 50_000
FOLDS, HELD_OUT = 4, 2
#: A lead below this share of the total is flagged as ambiguous.
AMBIGUOUS = 0.2


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """``n`` rows of +1 / -1, about 4 log2(n) + 7 columns, chosen so that the smallest distance
    between two rows is large and no column is constant."""
    length = 7 + 4 * max(1, int(np.ceil(np.log2(max(n, 2)))))
    rng = np.random.default_rng(seed)
    best, reach = None, -1
    for _ in range(200 if n <= 64 else 5):
        code = np.where(rng.random((n, length)) < 0.5, -1.0, 1.0)
        if n > 1:
            flat = np.abs(code.sum(0)) == n
            code[0, flat] *= -1
            apart = (length - code @ code.T) / 2
            np.fill_diagonal(apart, length)
            if apart.min() > reach:
                best, reach = code, apart.min()
        else:
            best = code
    return best


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    code: np.ndarray      # (languages, bits of the code)
    weights: np.ndarray   # (features, bits of the code)
    bias: np.ndarray


def train(texts: list[str], langs: list[str], seed: int = 3) -> Model:
    names = tuple(sorted(set(langs)))
    code = codewords(max(len(names), 1))
    bags = []
    for text in texts:
        ids, counts = document_bag(text.split(), SIZES, BITS, False)
        bags.append((ids.astype(np.int32), (counts / max(counts.sum(), 1)).astype(np.float32)))
    want = code[[names.index(x) for x in langs]] if langs else np.zeros((0, code.shape[1]))
    weights = np.zeros((1 << BITS, code.shape[1]), np.float32)
    seen = np.full((1 << BITS, 1), 1e-8, np.float32)
    bias, seen_b = np.zeros(code.shape[1], np.float32), np.full(code.shape[1], 1e-8, np.float32)
    rng = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        rate = RATE * 8 * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            ids = np.concatenate([bags[i][0] for i in chosen])
            share = np.concatenate([bags[i][1] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(bags[i][0]) for i in chosen])
            found, inverse = np.unique(ids, return_inverse=True)
            dense = np.zeros((len(chosen), len(found)), np.float32)
            dense[row, inverse] = share
            margin = (dense @ weights[found] + bias) * want[chosen]
            pull = -want[chosen] / (1 + np.exp(np.clip(margin, -50, 50))) / len(chosen)
            grad = dense.T @ pull.astype(np.float32)
            seen[found] += (grad ** 2).mean(1, keepdims=True)
            weights[found] -= rate * grad / np.sqrt(seen[found])
            step = pull.sum(0)
            seen_b += step ** 2
            bias -= (0.1 * step / np.sqrt(seen_b)).astype(np.float32)
    return Model(names, code, weights, bias)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_per_lang: int = SAMPLE_ROWS_PER_LANG) -> Model:
    """Train on a sample by hash of the id, the same expected number of rows per language."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT)) \
        .select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "langs")
    if counts.count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages in {lang_col!r}")
    share = counts.select("lang", F.least(F.lit(1.0), F.lit(float(rows_per_lang)) / F.col("n")).alias("share"))
    sample = (usable.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(share), "lang")
              .where(hash_u32("lang", F.coalesce(F.col("id").cast("string"), F.lit("null"))) < F.col("share") * F.lit(2.0 ** 32))
              .select("id", "text", "lang").toPandas().sort_values(["id", "lang", "text"], kind="stable"))
    return train(sample["text"].tolist(), sample["lang"].tolist())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words_of = WordTable(m.weights, SIZES, BITS, False, limit=200_000)
        for batch in batches:
            langs, scores, unsure = [], [], []
            for text in batch.column(1).to_pylist():
                if not m.langs or text is None or not any(map(str.isalpha, text)):
                    langs.append("und"), scores.append(0.0), unsure.append(False)
                    continue
                at = words_of.places(text.split())
                sums = words_of.rows[at].sum(0, dtype=np.float64)
                side = sums[:-1] / sums[-1] + m.bias
                cost = np.logaddexp(0, -m.code * side).sum(1)
                share = np.exp(cost.min() - cost)
                share /= share.sum()
                best = int(cost.argmin())
                second = np.partition(share, -2)[-2] if len(share) > 1 else 0.0
                langs.append(m.langs[best]), scores.append(float(share[best]))
                unsure.append(bool(share[best] - second < AMBIGUOUS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())],
                names=["id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "id long, lang_pred string, score double, ambiguous boolean").withColumnRenamed("id", id_col)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "ambiguous")
