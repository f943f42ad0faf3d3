"""Samples and splits.

The seeded forms (``sample_fraction``, ``random_split``) follow Spark's generator and
so depend on how the table is partitioned. The keyed forms depend on the row key
alone: the same rows fall on the same side on any cluster, at any partitioning, also
after a lost executor is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.functions.numeric import key_bucket, key_hash
from skyledger.operators.ranks import order_statistics

_HASH, _TIE = "__key_hash", "__row_hash"
_HASH_DIGITS = 13  # 52 bits: exact as DOUBLE
_HASH_RANGE = 16**_HASH_DIGITS


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Each row with the same chance, independently."""
    return df.sample(False, fraction, seed)


def nested_samples(
    df: DataFrame, sizes: Sequence[int], keys: Sequence[str], seed: int = 42
) -> list[DataFrame]:
    """Samples of exactly ``min(n, rows)`` rows each: those with the least key hashes.

    A smaller sample lies within a larger one. The n-th least hash is found by rank
    (one search for all sizes), so a sample is a plain filter of the table however
    large n is. Where keys repeat, rows that tie on that one hash are ranked by a second
    hash, of the whole row, in the same way; rows that tie on both are equal rows.
    """
    hashed = df.withColumn(_HASH, key_hash(*keys, salt=str(seed), digits=_HASH_DIGITS))
    wanted = sorted({n for n in sizes if n > 0})
    found = order_statistics(hashed.select(_HASH), {_HASH: wanted}, {_HASH: _even_cuts()})[_HASH]
    return [_least_hashes(hashed, n, keys, found).drop(_HASH) for n in sizes]


def hash_cuts(
    df: DataFrame, sizes: Sequence[int], keys: Sequence[str], seed: int = 42
) -> tuple[Column, list[int]]:
    """A hash of the key, and per size the hash up to which rows are in the sample.

    The same rows as ``nested_samples`` where keys are unique; rows of one key stay together.
    """
    h = key_hash(*keys, salt=str(seed), digits=_HASH_DIGITS)
    wanted = sorted({n for n in sizes if n > 0})
    found = order_statistics(df.select(h.alias(_HASH)), {_HASH: wanted}, {_HASH: _even_cuts()})[_HASH]
    return h, [int(found[n].value) if n in found else (_HASH_RANGE if n > 0 else -1) for n in sizes]


def _least_hashes(hashed: DataFrame, n: int, keys: Sequence[str], found: dict) -> DataFrame:
    if n <= 0:
        return hashed.limit(0)
    if n not in found:  # more than there are rows
        return hashed
    last, h, missing = int(found[n].value), F.col(_HASH), n - found[n].below
    if missing == found[n].equal:
        return hashed.filter(h <= last)
    # Keys that repeat: the rows of one hash are more than are still missing.
    row = [c for c in hashed.columns if c != _HASH]
    ties = hashed.filter(h == last).withColumn(_TIE, key_hash(*row, salt="row", digits=_HASH_DIGITS))
    at = order_statistics(ties.select(_TIE), {_TIE: [missing]}, {_TIE: _even_cuts()})[_TIE][missing]
    t, equal = F.col(_TIE), missing - at.below
    some = ties.filter(t < int(at.value))
    # Equal rows: one of them, as often as rows are missing.
    copies = ties.filter(t == int(at.value)).limit(1).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.lit(equal)))
    )
    return hashed.filter(h < last).unionByName(some.drop(_TIE)).unionByName(copies.drop(_TIE, "__copy"))


def _even_cuts() -> list[float]:
    """Cut points of a uniform hash: no look at the data is needed."""
    return [_HASH_RANGE * i / 256 for i in range(1, 256)]


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, picked by key hash."""
    return nested_samples(df, [n], keys, seed)[0]


def random_split(
    df: DataFrame, train: float = 0.7, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Seeded random train and test tables."""
    left, right = df.randomSplit([train, 1.0 - train], seed=seed)
    return left, right


def keyed_split(
    df: DataFrame, keys: Sequence[str], train_percent: int = 70, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Train and test tables by hash bucket of the key; every row is in one of them."""
    in_train = key_bucket(*keys, salt=salt) < train_percent
    return df.filter(in_train), df.filter(~in_train)


def validation_flag(
    df: DataFrame, keys: Sequence[str], percent: int = 15, name: str = "is_validation",
    salt: str = "validation",
) -> DataFrame:
    """Add a boolean that marks the validation rows."""
    return df.withColumn(name, key_bucket(*keys, salt=salt) < percent)


def assign_folds(
    df: DataFrame, keys: Sequence[str], folds: int = 3, name: str = "fold", salt: str = "fold"
) -> DataFrame:
    """Add the fold number, in [0, folds)."""
    return df.withColumn(name, key_bucket(*keys, buckets=folds, salt=salt))


def subset_sizes(
    rows: int, steps: int = 6, least: float = 0.1, floor: int = 50
) -> list[int]:
    """Evenly spaced subset sizes from ``least`` of the rows to all of them."""
    gap = (1.0 - least) / max(1, steps - 1)
    shares = [least + gap * i for i in range(steps)] if steps > 1 else [1.0]
    return [min(rows, max(floor, int(rows * s + 1e-9))) for s in shares]
