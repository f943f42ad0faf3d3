"""Quality classifier: supervised subword embeddings.

Every hashed word and character n-gram has a learned vector; a text is the mean of its
vectors, and a softmax layer on that mean gives the class. Both layers are trained
together by stochastic gradient descent in numpy, on a bounded sample of labelled
texts. Because the output layer is linear in the mean, scoring needs only the product of
the two layers: one weight per feature and class.

Edge cases: null and empty texts have no features and get the score of the bias alone;
a null label is no training row; without training rows, or with one class only, every
text scores the smoothed share of that class (0.5 for no rows). Repeated rows are
scored each by itself. Columns of the input named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.batches import Texts, annotate, fields, sample_rows
from skyledger.llm.features import SIZE, mean_weight, sparse_rows

SAMPLE = 3000  # labelled texts the model is fitted on, at most
DIM, EPOCHS, RATE, SEED = 8, 6, 0.8, 17


@dataclass(frozen=True)
class EmbeddingModel:
    """Feature weights (features x classes), biases, and the class values in order."""

    weights: np.ndarray
    bias: np.ndarray
    classes: tuple

    def probabilities(self, texts: Texts) -> np.ndarray:
        z = mean_weight(texts, self.weights) + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train_rows(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: list, dim: int = DIM, epochs: int = EPOCHS,
    rate: float = RATE, seed: int = SEED,
) -> EmbeddingModel:
    classes = tuple(sorted(set(labels)))
    if len(classes) < 2:
        return EmbeddingModel(np.zeros((SIZE, max(1, len(classes)))), np.zeros(max(1, len(classes))), classes)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (SIZE, dim))
    out, bias = np.zeros((dim, len(classes))), np.zeros(len(classes))
    target = np.searchsorted(classes, labels)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            feature, share = rows[i]
            lr = rate * (1 - step / steps)
            step += 1
            hidden = share @ vectors[feature] if len(feature) else np.zeros(dim)
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1.0
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= 0.05 * lr * p
            # A vector's step follows its share of the text, scaled back up so that
            # long texts, whose shares are all tiny, still move their vectors.
            vectors[feature] -= (4.0 * lr) * np.outer(share * np.sqrt(len(feature)), back)
    return EmbeddingModel(vectors @ out, bias, classes)


def fit(
    labelled: DataFrame, text: str = "text", label: str = "label", sample: int = SAMPLE
) -> EmbeddingModel:
    """Fit on at most ``sample`` labelled rows, picked by row hash."""
    rows = sample_rows(
        labelled.select(F.col(text).alias("text"), F.col(label).alias("label")).dropna(), sample
    ).toArrow()
    made, labels = [], rows.column("label").to_pylist()
    values = rows.column("text").combine_chunks()
    for i in range(0, len(values), 64):
        made += sparse_rows(Texts(values.slice(i, 64)))
    return train_rows(made, labels)


def score(
    docs: DataFrame, model: EmbeddingModel, positive, text: str = "text", name: str = "score"
) -> DataFrame:
    """Add the probability of class ``positive``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held: EmbeddingModel = shared.value
        if len(held.classes) < 2:
            fixed = 0.5 if not held.classes else (0.99 if held.classes[0] == positive else 0.01)
            return lambda texts: [np.full(len(texts), fixed)]
        at = held.classes.index(positive)
        return lambda texts: [held.probabilities(texts)[:, at]]

    return annotate(docs, text, fields(**{name: "double"}), make)


def fold_labels(docs: DataFrame, labels: DataFrame, fold, sample: int = SAMPLE) -> DataFrame:
    """Texts with a quality label whose key is outside the held-out fold.

    The keys are picked first (a bounded table, so it may be broadcast), and the
    documents are then read once, without a shuffle of their texts.
    """
    keys = sample_rows(
        labels.select("doc_id", F.col("quality").alias("label")).dropna().filter(~fold(F.col("doc_id")))
        .dropDuplicates(["doc_id", "label"]),
        sample,
    )
    return docs.select("doc_id", "text").join(F.broadcast(keys), "doc_id")
