"""Quality of a text by supervised subword embeddings.

Every word, pair of words and character n-gram is hashed to a bucket with a learned vector; a text is the
mean of the vectors of its n-grams and of ``NEUTRAL`` zero vectors, so that a text of a few words tells
little, and a softmax over a linear layer gives the probability of each label. Vectors and layer are trained
together by stochastic gradient descent in numpy. A step on the vectors of a text is divided by the square
of its weights, so that it moves the mean as far for a long text as for a short one.

The mean and the layer are both linear, so for scoring each bucket's vector is taken through the layer once;
a text then needs one number per label and n-gram. A text without n-grams has the mean vector 0 and gets the
probability that the layer's constants give.

The model is fitted on a bounded sample of the labelled rows: ``max_training`` of them, those with the
smallest hash of the id, each as the counts of its whole text's buckets. What reaches the driver is at most
``max_training`` times ``buckets`` numbers. The model has a fixed size and is sent to the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import features
from tallyhouse.llm.text import blocks, give_back

BUCKETS = 1 << 16
DIMENSIONS = 16
WORD_SIZES = (1, 2)
CHARACTER_SIZES = (3, 5)
NEUTRAL = 50
MAX_TRAINING = 2000
EPOCHS = 10
RATE = 0.5
THRESHOLD = 0.3


@dataclass
class Model:
    """``logits`` has a row per bucket and a column per label; ``bias`` one number per label."""

    logits: np.ndarray
    bias: np.ndarray
    labels: list[int]

    def probabilities(self, block) -> np.ndarray:
        """One row per document of the block, one column per label."""
        found, docs = _grams(block, len(self.logits))
        scores = features.mean_of(self.logits[found], docs, len(block), NEUTRAL) + self.bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)


def _grams(block, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    words, of_words = features.word_grams(block, WORD_SIZES, buckets)
    letters, of_letters = features.character_grams(block, CHARACTER_SIZES, buckets)
    return np.concatenate([words, letters]), np.concatenate([of_words, of_letters])


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, dimensions: int = DIMENSIONS,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Fit vectors and softmax layer on rows of (buckets, counts, label).

    Steps fall linearly to 0. Without rows, or with a single label, the model gives that label (or 0 and 1
    alike) the same probability for every text.
    """
    labels = sorted({label for *_, label in rows} | {0, 1})
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (buckets, dimensions)).astype(np.float32) / dimensions
    layer, bias = np.zeros((dimensions, len(labels)), np.float32), np.zeros(len(labels), np.float32)
    rows = [(f, (c / (c.sum() + NEUTRAL)).astype(np.float32), labels.index(y)) for f, c, y in rows if len(f)]
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            found, share, label = rows[i]
            pace = rate * (1 - step / steps)
            step += 1
            mean = share @ vectors[found]
            error = mean @ layer + bias
            error = np.exp(error - error.max())
            error /= error.sum()
            error[label] -= 1
            back = layer @ error
            layer -= pace * np.outer(mean, error)
            bias -= pace / 10 * error
            vectors[found] -= pace / (share @ share) * share[:, None] * back
    return Model((vectors @ layer).astype(np.float32), bias, labels)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "quality", max_training: int = MAX_TRAINING, buckets: int = BUCKETS) -> Model:
    """Train on the labelled rows for which ``learn`` holds (an expression over the id column).

    Rows without id, label or text are not learned from; of several labels of one id the largest holds.
    """
    chosen = (
        labels.select(F.col(f"`{id_column}`").alias(id_column), F.col(f"`{label_column}`").cast("int").alias("label"))
        .dropna().filter(learn).groupBy(id_column).agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64(id_column), id_column).limit(max_training)
    )
    texts = docs.select(F.col(f"`{id_column}`").alias(id_column), F.col(f"`{text_column}`").alias("text")).dropna()

    def count(batches):
        for rows, block in blocks(batches, "text"):
            found = features.counted(*_grams(block, buckets), len(block))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([f.astype("<i4").tobytes() for f, _ in found], pa.binary()),
                 pa.array([c.astype("<i4").tobytes() for _, c in found], pa.binary())], ["label", "found", "counts"])

    counted = texts.join(chosen, id_column).select("label", "text").mapInArrow(
        count, "label int, found binary, counts binary")
    rows = [(np.frombuffer(r.found, "<i4"), np.frombuffer(r.counts, "<i4"), r.label) for r in counted.collect()]
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))
    model = train(rows, buckets)
    del rows
    give_back()
    return model


def score(docs: DataFrame, model: Model, label: int = 1, threshold: float = THRESHOLD, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``score`` (probability of ``label``) and ``predicted``.

    A null text counts as an empty one; repeated rows stay, other columns are left out.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    column = model.labels.index(label)
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for rows, block in blocks(batches, "text"):
            values = held.value.probabilities(block)[:, column].astype(float)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(values), pa.array((values >= threshold).astype(np.int32))],
                ["id", "score", "predicted"])

    return docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")).mapInArrow(
        run, f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_column)


def keep_accepted(docs: DataFrame, model: Model, label: int = 1, threshold: float = THRESHOLD,
                  text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    column = model.labels.index(label)

    def run(batches):
        for rows, block in blocks(batches, text_column):
            yield rows.filter(pa.array(held.value.probabilities(block)[:, column] >= threshold))

    return docs.mapInArrow(run, docs.schema)
