"""Hashed word and character n-gram features shared by the two text classifiers.

A text has one feature per word, per run of four bytes, and per run of three words. A
three-word run says little by its own identity in a small training sample, so it is
hashed by what generalises: whether the same run stood earlier in the text.
"""

from __future__ import annotations

import numpy as np

from skyledger.llm.batches import Texts
from skyledger.llm.textgrams import Words, bucket, byte_grams, seen_before

BITS = 16
WORD, GRAM, RUN, NEW = 0, 1 << BITS, 2 << BITS, (2 << BITS) + 1
SIZE = (2 << BITS) + 2


def text_features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature number) of every feature of the texts, unsorted."""
    words = Words(texts)
    at, grams = byte_grams(texts.buf, texts.offsets, 4)
    gram_doc = np.searchsorted(texts.offsets, at, side="right") - 1 if len(at) else at
    where, runs = words.windows(3)
    run_doc = words.doc[where]
    later, _ = seen_before(run_doc, runs)
    return (
        np.concatenate([words.doc, gram_doc, run_doc]),
        np.concatenate([
            bucket(words.hashes, BITS) + WORD,
            bucket(grams, BITS) + GRAM,
            np.where(later, RUN, NEW).astype(np.int32),
        ]),
    )


def sparse_rows(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, shares) of each text; the shares of a text sum to one."""
    doc, feature = text_features(texts)
    key, count = np.unique(doc.astype(np.int64) * SIZE + feature, return_counts=True)
    row, feature = key // SIZE, (key % SIZE).astype(np.int64)
    cut = np.searchsorted(row, np.arange(len(texts) + 1))
    rows = []
    for a, b in zip(cut[:-1], cut[1:]):
        share = count[a:b].astype(np.float64)
        rows.append((feature[a:b], share / max(1.0, share.sum())))
    return rows


def mean_weight(texts: Texts, weights: np.ndarray) -> np.ndarray:
    """Mean weight over the features of each text; one column per column of weights."""
    doc, feature = text_features(texts)
    n = len(texts)
    count = np.maximum(np.bincount(doc, minlength=n), 1)
    columns = weights if weights.ndim == 2 else weights[:, None]
    made = [
        np.bincount(doc, weights=columns[:, c][feature], minlength=n) / count
        for c in range(columns.shape[1])
    ]
    return np.stack(made, axis=1)
