"""Language identification: nearest of several centroids per language.

A text is the normalised TF-IDF vector of its hashed byte n-grams (letters in lower
case, everything else folded to a blank). Per language the vectors of a bounded sample
are clustered into a few centroids by spherical k-means; a text gets the language of the
centroid with the largest cosine. It is rejected below that language's limit, which is set
between two sets of cosines of training texts: those of the language's own texts with
centroids of the other half of them, and those that the texts of the other language nearest
to it would have with its centroids, were their own left out. A text of few
letters shares few n-grams with anything, so its limit is lower by the root of its length.
The n-grams have so many buckets that a long text does not fill them.

Edge cases: null texts and texts without a letter are ``und`` with score 0 and rejected;
rows with a null language are never learned from; with nothing to learn from, every text
is ``und``. Equal cosines go to the language first in alphabetical order. Input columns
named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.batches import Texts, annotate, fields, sample_rows
from skyledger.llm.textgrams import bucket, byte_grams

BITS = 15
SIZES = (1, 2, 3, 4)
SAMPLE = 300  # training texts per language, at most
CENTROIDS, ROUNDS, SEED = 4, 8, 5
OWN_QUANTILE, OTHER_QUANTILE, ALONE_SHARE, FULL_LETTERS = 0.005, 0.95, 0.5, 64
MARGIN = 0.15  # of the way from other languages to the own one
ROWS = 64  # texts whose buckets are held at once
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def gram_counts(texts: Texts) -> np.ndarray:
    """Texts x buckets: how often each hashed n-gram of one to four bytes occurs."""
    folded, n = _FOLD[texts.buf], len(texts)
    # Blanks in a row carry nothing: keep the first of each.
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20)
    offsets = np.concatenate([[0], np.cumsum(keep)])[texts.offsets]
    folded = folded[keep]
    total = np.zeros(n << BITS, np.int64)
    for size in SIZES:
        at, codes = byte_grams(folded, offsets, size)
        if size == 1:
            letters = codes != 0x20
            at, codes = at[letters], codes[letters]
        doc = np.repeat(np.arange(n), np.diff(np.searchsorted(at, offsets)))
        total += np.bincount(
            (doc << BITS) + bucket(codes, BITS, salt=size), minlength=n << BITS
        )
    return total.reshape(n, 1 << BITS)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm == 0, 1, norm)


def vectors(texts: Texts, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(gram_counts(texts).astype(np.float32)) * idf)


def length_share(texts: Texts) -> np.ndarray:
    """Root of the letters of each text over those of a full one, at most 1."""
    letters = np.diff(np.concatenate([[0], np.cumsum(_FOLD[texts.buf] != 0x20)])[texts.offsets])
    return np.sqrt(np.minimum(1.0, letters / FULL_LETTERS))


@dataclass(frozen=True)
class CentroidModel:
    """IDF per bucket, centroids with their language, and the least cosine per language."""

    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    languages: tuple
    least: np.ndarray

    def predict(self, texts: Texts):
        """(language number, cosine, rejected) by the nearest centroid of each text."""
        cosine = np.concatenate([np.zeros((0, len(self.owner)), np.float32)] + [
            vectors(Texts(texts.values.slice(i, ROWS)), self.idf) @ self.centroids.T
            for i in range(0, len(texts), ROWS)
        ])
        best = cosine.argmax(axis=1)
        language = self.owner[best]
        nearest = np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0)
        return language, nearest, nearest < self.least[language] * length_share(texts)


def clustered(rows: np.ndarray, k: int, rng) -> np.ndarray:
    """Unit centroids by spherical k-means; empty clusters are left out."""
    k = min(k, len(rows))
    at = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = (rows @ at.T).argmax(axis=1)
        at = unit(np.stack([
            rows[nearest == c].sum(axis=0) if (nearest == c).any() else at[c] for c in range(k)
        ]))
    return at


def limits(own: list, others: np.ndarray) -> np.ndarray:
    """Least cosine per language, from its own texts and from the other language nearest to it.

    ``own`` are the cosines of each language's texts; ``others`` holds, per language and other
    language, a high quantile of that one's cosines. Between the two where they are apart, and
    nearer to the others, as odd own texts must stay. Where they are not, nearly all own
    texts stay. One language alone has only its own side.
    """
    low = np.array([np.quantile(x, OWN_QUANTILE) for x in own])
    if len(own) == 1:
        return ALONE_SHARE * low
    high = others.max(axis=1)
    return np.minimum(low, high + MARGIN * (low - high))


def train(texts: list, languages: list, centroids: int = CENTROIDS) -> CentroidModel | None:
    """One language's vectors are held at a time, so many languages need little memory."""
    import pyarrow as pa

    if not texts:
        return None
    names = tuple(sorted(set(languages)))
    groups = [[] for _ in names]
    for text, number in zip(texts, np.searchsorted(names, languages).tolist()):
        groups[number].append(text)
    parts = [
        [Texts(pa.array(group[i : i + ROWS], pa.large_string())) for i in range(0, len(group), ROWS)]
        for group in groups
    ]
    held = sum((gram_counts(part) > 0).sum(axis=0) for group in parts for part in group)
    idf = np.log((1 + len(texts)) / (1 + held)).astype(np.float32) + 1
    rows_of = lambda group: np.concatenate([vectors(part, idf) for part in group])
    share_of = lambda group: np.concatenate([length_share(part) for part in group])
    rng = np.random.default_rng(SEED)
    made, owner, own = [], [], []
    for i, group in enumerate(parts):
        rows, share = rows_of(group), share_of(group)
        at = clustered(rows, centroids, rng)
        made.append(at)
        owner += [i] * len(at)
        # A text's cosine with a centroid made of it says little: halves judge each other.
        half = np.arange(len(rows)) % 2 == 0
        near = (rows @ at.T).max(axis=1)
        if len(rows) > 1:
            for side in (half, ~half):
                near[side] = (rows[side] @ clustered(rows[~side], centroids, rng).T).max(axis=1)
        own.append(near / share)
    made, owner = np.concatenate(made), np.array(owner)
    first = np.searchsorted(owner, np.arange(len(names)))
    others = np.zeros((len(names), len(names)))
    for i, group in enumerate(parts if len(names) > 1 else []):
        near = np.maximum.reduceat(rows_of(group) @ made.T, first, axis=1) / share_of(group)[:, None]
        others[:, i] = np.quantile(near, OTHER_QUANTILE, axis=0)
    np.fill_diagonal(others, -1)
    least = limits(own, others)
    return CentroidModel(idf, made, owner, names, least)


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE,
    languages: int | None = None,
) -> CentroidModel | None:
    """Fit on at most ``sample`` texts of each language, picked by row hash.

    Every language is learned, or with ``languages`` only so many, the most frequent ones.

    Texts without a letter teach nothing and are left out. The picked rows' hashes are a
    bounded table; the texts are fetched by them in a second read without a shuffle.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    rows = rows.filter(F.col("text").rlike(r"\p{L}")).withColumn("key", F.xxhash64("text", "lang"))
    if languages is not None:
        known = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
        rows = rows.join(F.broadcast(known.select("lang")), "lang")
    keys = sample_rows(rows.select("key", "lang").distinct(), sample, by="lang").select("key")
    found = rows.join(F.broadcast(keys), "key").dropDuplicates(["key"]).toArrow()
    found = found.sort_by("key")
    return train(found.column("text").to_pylist(), found.column("lang").to_pylist())


RESULT = fields(lang_pred="string", score="double", rejected="boolean")


def identify(docs: DataFrame, model: CentroidModel | None, text: str = "text") -> DataFrame:
    """Add the predicted language, the cosine, and whether the text is rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value

        def run(texts: Texts):
            if held is None:
                n = len(texts)
                return [[UNKNOWN] * n, np.zeros(n), np.ones(n, bool)]
            language, cosine, rejected = held.predict(texts)
            return [[held.languages[i] for i in language], cosine.astype(np.float64), rejected]

        return run

    scored = annotate(docs, text, RESULT, make)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return scored.withColumns({
        "lang_pred": F.when(letters, F.col("lang_pred")).otherwise(F.lit(UNKNOWN)),
        "score": F.when(letters, F.col("score")).otherwise(F.lit(0.0)),
        "rejected": F.col("rejected") | ~letters,
    })
