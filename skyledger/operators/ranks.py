"""Exact order statistics without a global sort.

Passes over the column, none of which gathers it anywhere:

1. *Cut*: mergeable quantile sketches give cut points that split the value range
   into buckets of roughly equal size. Sketches are merged in two steps, so no task
   receives one sketch per input split.
2. *Count*: the rows of each bucket are counted, which tells exactly which bucket
   holds a wanted rank and how many rows lie before that bucket. A wanted bucket
   that is still large is cut and counted again.
3. *Refine*: only rows in the wanted buckets are reduced to distinct values with
   counts and summed up in order.

The result is exact whatever the cut points are; they decide only how few rows
reach step 3. A value held by a third of the table is one counted row by then.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.session import persisted

_SKETCH_GROUPS = 64
_BUCKETS = 256
_REFINE_ROWS = 2_000_000

Cuts = Mapping[str, Sequence[float]]
Cell = tuple[str, int]


class Ranked(NamedTuple):
    """A value, the rows strictly below it and the rows equal to it."""

    value: float
    below: int
    equal: int


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the columns in question; the passes read these again and again."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns])


def _quantile_ranks(buckets: int) -> Column:
    return F.array(*[F.lit(i / buckets) for i in range(1, buckets)])


def _sketch_group() -> Column:
    return F.spark_partition_id() % _SKETCH_GROUPS


def cut_points(df: DataFrame, columns: Sequence[str], buckets: int = _BUCKETS) -> dict:
    """Up to ``buckets - 1`` ascending cut points per column (one pass)."""
    at = range(len(columns))
    x = [F.col(c).cast("double") for c in columns]
    parts = df.groupBy(_sketch_group().alias("g")).agg(
        *[F.kll_sketch_agg_double(F.when(~F.isnan(x[i]), x[i])).alias(f"s{i}") for i in at],
        *[F.count_if(x[i].isNotNull() & ~F.isnan(x[i])).alias(f"n{i}") for i in at],
    )
    merged = parts.agg(
        *[F.kll_merge_agg_double(f"s{i}").alias(f"s{i}") for i in at],
        *[F.sum(f"n{i}").alias(f"n{i}") for i in at],
    )
    ranks = _quantile_ranks(buckets)
    row = merged.select(
        *[
            F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", ranks)).alias(
                f"q{i}"
            )
            for i in at
        ]
    ).first()
    return {c: sorted(set(row[f"q{i}"] or [])) for i, c in enumerate(columns)}


def _bucketed(df: DataFrame, cuts: Cuts, cells: Iterable[Cell] | None = None) -> DataFrame:
    """(column, x, bucket) rows of present numbers; a cut point opens its bucket.

    With ``cells`` given, only the numbers in those (column, bucket) pairs.
    """
    inf = float("inf")
    chosen = defaultdict(list)
    for c, b in cells or ():
        chosen[c].append(b)
    columns = list(cuts) if cells is None else list(chosen)
    names = [f"__b{i}" for i in range(len(columns))]
    splits = [[-inf, *([p for p in cuts[c] if -inf < p < inf] or [0.0]), inf] for c in columns]
    kept = Bucketizer(
        splitsArray=splits, inputCols=columns, outputCols=names, handleInvalid="keep"
    ).transform(df)
    out = []
    for c, b in zip(columns, names):
        x, bucket = F.col(c), F.col(b).cast("int")
        if cells is not None:
            x = F.when(bucket.isin(chosen[c]), x)
        out.append(F.struct(F.lit(c).alias("column"), x.alias("x"), bucket.alias("bucket")))
    long = kept.select(F.inline(F.array(*out)))
    return long.filter(F.col("x").isNotNull() & ~F.isnan("x"))


def _bucket_sizes(df: DataFrame, cuts: Cuts) -> dict[str, dict[int, int]]:
    """Rows per bucket: a few hundred numbers per column (one pass)."""
    sizes: dict[str, dict[int, int]] = {c: {} for c in cuts}
    for r in _bucketed(df, cuts).groupBy("column", "bucket").count().collect():
        sizes[r["column"]][r["bucket"]] = r["count"]
    return sizes


def _targets(wanted: Mapping[str, Sequence[int]], sizes) -> list[tuple[str, int, int, int]]:
    """(column, bucket, rank, rows before the bucket) of every rank that exists."""
    out = []
    for c, ranks in wanted.items():
        before = 0
        for b in sorted(sizes[c]):
            upto = before + sizes[c][b]
            out += [(c, b, r, before) for r in sorted(set(ranks)) if before < r <= upto]
            before = upto
    return out


def _finer(df: DataFrame, cuts: Cuts, cells: Iterable[Cell], buckets: int) -> dict:
    """The cut points with new ones added inside the given buckets (one pass).

    Each new point is cut off on both sides: a value that fills its bucket gets one
    of its own, and what lies beside it can be cut further.
    """
    sketches = (
        _bucketed(df, cuts, cells)
        .groupBy("column", "bucket", _sketch_group().alias("g"))
        .agg(F.kll_sketch_agg_double("x").alias("s"))
        .groupBy("column", "bucket")
        .agg(F.kll_merge_agg_double("s").alias("s"))
    )
    found = sketches.select(
        "column", F.kll_sketch_get_quantile_double("s", _quantile_ranks(buckets)).alias("q")
    )
    out = {c: set(points) for c, points in cuts.items()}
    for r in found.collect():
        out[r["column"]].update(r["q"], (math.nextafter(v, math.inf) for v in r["q"]))
    return {c: sorted(points) for c, points in out.items()}


def _located(
    df: DataFrame, wanted: Mapping[str, Sequence[int]], cuts: Cuts, sizes, buckets: int, limit: int
):
    """Cut wanted buckets until each is within the limit or cannot be cut further."""
    while large := {(c, b) for c, b, _, _ in _targets(wanted, sizes) if sizes[c][b] > limit}:
        finer = _finer(df, cuts, large, buckets)
        if finer == cuts:  # a large bucket is one repeated value
            break
        cuts, sizes = finer, _bucket_sizes(df, finer)
    return cuts, _targets(wanted, sizes)


def _refine(df: DataFrame, cuts: Cuts, targets) -> dict[str, dict[int, Ranked]]:
    found: dict[str, dict[int, Ranked]] = {c: {} for c in cuts}
    if not targets:
        return found
    in_order = Window.partitionBy("column", "bucket").orderBy("x")
    upto = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    counted = (
        _bucketed(df, cuts, {(c, b) for c, b, _, _ in targets})
        .groupBy("column", "bucket", "x")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", upto)
    )
    # One row per wanted rank: bounded by the caller's list, so safe to broadcast.
    asked = df.sparkSession.createDataFrame(
        targets, "column string, bucket int, rank bigint, before bigint"
    )
    within = F.col("rank") - F.col("before")
    hits = counted.join(F.broadcast(asked), ["column", "bucket"]).filter(
        (within <= F.col("upto")) & (within > F.col("upto") - F.col("n"))
    )
    below = F.col("before") + F.col("upto") - F.col("n")
    for r in hits.select("column", "rank", "x", below.alias("below"), "n").collect():
        found[r["column"]][r["rank"]] = Ranked(r["x"], r["below"], r["n"])
    return found


def order_statistics(
    df: DataFrame,
    wanted: Mapping[str, Sequence[int]],
    cuts: Cuts | None = None,
    buckets: int = _BUCKETS,
    limit: int = _REFINE_ROWS,
) -> dict[str, dict[int, Ranked]]:
    """Exact values at the wanted 1-based ranks of each column.

    Gives ``{column: {rank: (value, below, equal)}}``; ranks past the number of
    present values are left out. ``cuts`` saves a pass where the spread is known.
    At most ``limit`` rows of a bucket are put in order by one task, or all copies
    of one value counted as one row.
    """
    columns = list(wanted)
    with persisted(_numbers(df, columns)) as x:
        cuts = cut_points(x, columns, buckets) if cuts is None else dict(cuts)
        sizes = _bucket_sizes(x, cuts)
        cuts, targets = _located(x, wanted, cuts, sizes, buckets, limit)
        return _refine(x, cuts, targets)


def exact_quantiles(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    interpolate: bool = False,
    buckets: int = _BUCKETS,
    limit: int = _REFINE_ROWS,
) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns at once, missing values left aside.

    Without interpolation the result is the least value whose cumulative share
    reaches the probability; with it, the usual linear blend of two neighbours.
    """
    columns = list(probabilities)
    with persisted(_numbers(df, columns)) as x:
        cuts = cut_points(x, columns, buckets)
        sizes = _bucket_sizes(x, cuts)
        totals = {c: sum(sizes[c].values()) for c in columns}
        places = {
            c: [_positions(p, totals[c], interpolate) for p in probabilities[c]]
            for c in columns
            if totals[c]
        }
        wanted = {c: [r for lo, hi, _ in ps for r in (lo, hi)] for c, ps in places.items()}
        cuts, targets = _located(x, wanted, cuts, sizes, buckets, limit)
        found = _refine(x, cuts, targets)
    return {
        c: [_blend(found[c][lo].value, found[c][hi].value, share) for lo, hi, share in places[c]]
        if c in places
        else [None] * len(probabilities[c])
        for c in columns
    }


def _blend(low: float, high: float, share: float) -> float:
    return low if share == 0.0 or low == high else low + (high - low) * share


def _positions(p: float, n: int, interpolate: bool) -> tuple[int, int, float]:
    """The two ranks around a probability and the way between them."""
    if interpolate:
        place = p * (n - 1)
        lo = int(place)
        return lo + 1, min(lo + 2, n), place - lo
    rank = min(max(math.ceil(p * n), 1), n)
    return rank, rank, 0.0
