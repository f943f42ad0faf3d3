"""Packing: optimal length buckets, and batches under a token budget inside each.

A global histogram of the lengths that occur is counted by Spark. Dynamic programming over
them chooses at most ``buckets`` upper bounds so that the padding, the sum of
(bound - length) over all rows, is the least possible. Different lengths are few: n of them
take at least n * n / 2 units of text, however long the longest text is. A caller may round
lengths up to a multiple of ``step``, and allow ``most_bins`` bins at most, for which the
step doubles until they fit. Each row goes to the bucket with
the least bound that holds it; a batch holds as many rows of one bucket as fit the
token budget at that bucket's bound, and one row if even that exceeds the budget. Lengths
are counts of byte-level BPE ids (``token_lengths``); other units are the caller's choice.

Rows are numbered inside a bucket in order of a hash of the key. Numbers come from counts
per hash range, a small table, plus a row number inside the range, so no bucket, however
large, is ever sorted or counted in one task.

Null and empty texts have length 0 and go to the first bucket; equal keys get consecutive
numbers in any order; an empty table gives no rows. Input columns named like a result
column are replaced.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, Window, functions as F

from skyledger.llm import bpe_tree
from skyledger.llm.batches import Texts, annotate, fields
from skyledger.llm.textgrams import SPACE, runs_of

BUCKETS, STEP, BUDGET = 12, 1, 16384
ROWS_PER_RANGE = 50_000


def word_lengths(docs: DataFrame, text: str = "text", name: str = "n_words") -> DataFrame:
    """Add the number of words of each whole text: runs without ASCII white space."""

    def count(texts: Texts):
        starts, _ = runs_of(~SPACE[texts.buf], texts.offsets)
        return [np.diff(np.searchsorted(starts, texts.offsets))]

    return annotate(docs, text, fields(**{name: "long"}), lambda: count)


def token_lengths(
    docs: DataFrame, text: str = "text", name: str = "n_tokens", vocabulary: str | None = None
) -> DataFrame:
    """Add the number of ids of each whole text under the vocabulary, per row, no shuffle."""
    path = vocabulary or public_tokenizers.path(bpe_tree.VOCABULARY)

    def make():
        tokens = bpe_tree.encoding(path)
        return lambda texts: [[len(bpe_tree.encode(t, tokens)) for t in texts.strings()]]

    return annotate(docs, text, fields(**{name: "long"}), make)


def optimal_bounds(values: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds, a subset of the sorted values, with the least total padding.

    Row i of the programme: the least padding of the first j values in i buckets. The
    place of the best last cut never moves left as j grows, so each row is filled by
    halving the range of j and of the cut.
    """
    n = len(values)
    if n == 0:
        return []
    many = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    mass = np.concatenate([[0], np.cumsum(counts * values.astype(np.float64))])
    cost = lambda a, b: values[b - 1] * (many[b] - many[a]) - (mass[b] - mass[a])
    best = np.array([0.0] + [cost(0, j) for j in range(1, n + 1)])
    cuts = [np.zeros(n + 1, np.int64)]
    for _ in range(1, min(buckets, n)):
        row, cut = best.copy(), np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            tried = np.arange(first, min(last, j - 1) + 1)
            total = best[tried] + cost(tried, j)
            at = int(np.argmin(total))
            row[j], cut[j] = total[at], tried[at]
            todo += [(low, j - 1, first, int(tried[at])), (j + 1, high, int(tried[at]), last)]
        cuts.append(cut)
        if row[n] >= best[n]:
            cuts.pop()
            break
        best = row
    bounds, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(values[j - 1]))
        j = int(cut[j])
    return bounds[::-1]


def length_histogram(
    df: DataFrame, length: str, step: int = STEP, most_bins: int | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """(rounded lengths, rows, step) over the whole table, in ``most_bins`` bins if bounded."""
    if most_bins is not None:
        longest = df.agg(F.max(length)).first()[0] or 0
        while longest // step + 1 > most_bins:
            step *= 2
    rows = (
        df.groupBy((F.ceil(F.col(length) / step) * step).cast("long").alias("value"))
        .count().toArrow().sort_by("value")
    )
    return rows.column("value").to_numpy(), rows.column("count").to_numpy(), step


RESULT = ("bucket", "bucket_length", "batch", "place")


def pack(
    df: DataFrame, key: str = "doc_id", length: str = "n_words", buckets: int = BUCKETS,
    budget: int = BUDGET, step: int = STEP, most_bins: int | None = None,
) -> DataFrame:
    """Add bucket, bucket length, batch within the bucket, and place within the batch.

    ``df`` is read several times: give a stored table, or one that is cheap to make.
    """
    df = df.drop(*RESULT)
    values, counts, step = length_histogram(df, length, step, most_bins)
    bounds = optimal_bounds(values, counts, buckets)
    if not bounds:
        return df.select("*", *[F.lit(None).cast("long").alias(n) for n in RESULT])
    rounded = (F.ceil(F.col(length) / step) * step).cast("long")
    number = F.lit(len(bounds) - 1)
    bound = F.lit(bounds[-1])
    for i in range(len(bounds) - 2, -1, -1):
        number = F.when(rounded <= bounds[i], F.lit(i)).otherwise(number)
        bound = F.when(rounded <= bounds[i], F.lit(bounds[i])).otherwise(bound)
    ranges = max(1, int(counts.sum()) // (ROWS_PER_RANGE * len(bounds)) + 1) * 4
    hashed = F.xxhash64(F.col(key))
    placed = df.withColumns({
        "bucket": number.cast("long"), "bucket_length": bound.cast("long"), "__h": hashed,
        # Leading part of the hash: ranges in the order of the hash itself.
        "__range": F.floor((hashed / F.lit(2.0**64) + 0.5) * ranges),
    })
    per_range = placed.groupBy("bucket", "__range").count()
    before = F.sum("count").over(
        Window.partitionBy("bucket").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_range.select("bucket", "__range", F.coalesce(before, F.lit(0)).alias("__before"))
    order = Window.partitionBy("bucket", "__range").orderBy("__h", key, length)
    ranked = (
        placed.withColumn("__n", F.row_number().over(order))
        .join(offsets, ["bucket", "__range"])
        .withColumn("__n", F.col("__n") + F.col("__before") - 1)
    )
    fits = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))))
    return ranked.withColumns({
        "batch": F.floor(F.col("__n") / fits).cast("long"), "place": (F.col("__n") % fits).cast("long"),
    }).select(*df.columns, *RESULT)
