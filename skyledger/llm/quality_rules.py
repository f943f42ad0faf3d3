"""Quality rules: a calibrated n-gram classifier beside fixed countable rules.

A logistic regression over hashed word and character n-gram shares is trained on
labelled rows, its scores are turned into probabilities by a second, two-parameter fit
on rows it has not seen, and every text is scored in Arrow batches against a fixed
threshold. The same pass counts the figures the fixed rules need:

* ``word_chars``: code points in words, a word being a run without ASCII white space;
* ``n_symbols``: characters of ``[#*$%&|<>]``;
* ``n_dup_lines``: lines holding a word that equal an earlier line of the text;
* ``n_repeat_words``: words inside eight-word windows found twice or more in the text.

Windows and lines are equal if their 64-bit hashes are; the words are not compared again, so
texts crafted for collisions of the polynomial hash can be counted wrongly. A null or empty
text has no words: all counts are 0 and it fails the rules. Without training rows of both
classes the classifier has no say and the rules alone decide. Repeated rows are judged
each by itself; input columns named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.batches import Texts, annotate, fields, sample_rows
from skyledger.llm.features import SIZE, mean_weight, sparse_rows
from skyledger.llm.textgrams import Words, runs_of, seen_before, span_hashes

SAMPLE = 3000  # labelled texts the model is fitted on, at most
EPOCHS, RATE, SEED = 8, 0.5, 23
LEAST_PROBABILITY = 0.5
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 20, 30, 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


@dataclass(frozen=True)
class CalibratedModel:
    """Weight per feature, and the line from raw score to log odds."""

    weights: np.ndarray
    slope: float
    shift: float

    def probabilities(self, texts: Texts) -> np.ndarray:
        z = self.slope * mean_weight(texts, self.weights)[:, 0] + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(rows, labels, rng) -> np.ndarray:
    """Feature weights by adaptive gradient steps, one text at a time."""
    weights, seen = np.zeros(SIZE), np.full(SIZE, 1e-8)
    bias = 0.0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            feature, share = rows[i]
            z = float(share @ weights[feature]) + bias
            slip = 1 / (1 + np.exp(-max(-40.0, min(40.0, z)))) - labels[i]
            g = slip * share
            seen[feature] += g * g
            weights[feature] -= RATE * g / np.sqrt(seen[feature])
            bias -= 0.05 * slip
    return weights


def calibrate(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds by Newton steps, with smoothed targets."""
    up, down = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    scale = max(float(np.std(raw)), 1e-9)
    x = np.stack([raw / scale, np.ones(len(raw))], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (at - [1.0, 0.0]))
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0] / scale), float(at[1])


def train_rows(rows, labels) -> CalibratedModel | None:
    """Train on three quarters of the rows, calibrate on the rest."""
    labels = np.asarray(labels, dtype=float)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(rows))
    kept, rest = order[len(rows) // 4 :], order[: len(rows) // 4]
    if len({*labels[kept]}) < 2 or len({*labels[rest]}) < 2:
        return None
    weights = _logistic([rows[i] for i in kept], labels[kept], rng)
    raw = np.array([float(rows[i][1] @ weights[rows[i][0]]) for i in rest])
    return CalibratedModel(weights, *calibrate(raw, labels[rest]))


def fit(labelled: DataFrame, text: str = "text", label: str = "label", sample: int = SAMPLE):
    """Fit on at most ``sample`` labelled rows (label 1: good), picked by row hash."""
    rows = sample_rows(
        labelled.select(F.col(text).alias("text"), F.col(label).alias("label")).dropna(), sample
    ).toArrow()
    values, made = rows.column("text").combine_chunks(), []
    for i in range(0, len(values), 64):
        made += sparse_rows(Texts(values.slice(i, 64)))
    return train_rows(made, [int(v == 1) for v in rows.column("label").to_pylist()])


def counts(texts: Texts) -> list[np.ndarray]:
    """Words, code points in words, symbols, repeated lines and repeated words of each text."""
    buf, n = texts.buf, len(texts)
    per_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[texts.offsets])
    words = Words(texts)
    inside = np.zeros(len(buf) + 1, np.int32)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    in_word = np.cumsum(inside[:-1]) > 0
    heads = (buf & 0xC0) != 0x80  # one per code point
    return [
        words.counts, per_text(in_word & heads), per_text(_SYMBOL[buf]),
        _repeated_lines(texts, words, n), _repeated_words(words, n),
    ]


def _repeated_lines(texts: Texts, words: Words, n: int) -> np.ndarray:
    starts, ends = runs_of(texts.buf != 0x0A, texts.offsets)
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    doc = np.searchsorted(texts.offsets, starts, side="right") - 1
    hashes = span_hashes(texts.buf, starts, ends) + (ends - starts).astype(np.uint64)
    later, _ = seen_before(doc, hashes)
    return np.bincount(doc[later], minlength=n)


def _repeated_words(words: Words, n: int) -> np.ndarray:
    at, hashes = words.windows(WINDOW)
    _, twice = seen_before(words.doc[at], hashes)
    cover = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    return np.bincount(words.doc[np.cumsum(cover[:-1]) > 0], minlength=n)


RESULT = fields(
    n_words="long", word_chars="long", n_symbols="long", n_dup_lines="long",
    n_repeat_words="long", base_failed="boolean", kept="boolean", probability="double",
)


def judge(
    docs: DataFrame, model: CalibratedModel | None, text: str = "text",
    threshold: float = LEAST_PROBABILITY,
) -> DataFrame:
    """Add the counts, the probability of good quality and the verdicts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value

        def run(texts: Texts):
            made = counts(texts)
            p = np.ones(len(texts)) if held is None else held.probabilities(texts)
            failed = (made[0] < LEAST_WORDS) | (100 * made[4] > MOST_REPEATED_PERCENT * made[0])
            return [*made, failed, ~failed & (p >= threshold), p]

        return run

    return annotate(docs, text, RESULT, make)
