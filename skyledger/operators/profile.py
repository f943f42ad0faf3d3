"""Profiles of a whole table.

Each profile is one aggregation whose output size does not depend on the number of
rows (or, for map points, is the number of distinct places), so partial aggregates
are all that is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger import schema as S
from skyledger.operators.columns import column_kinds, present
from skyledger.session import persisted


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs of every column from one pass: (column, null_count)."""
    one_row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one_row.unpivot([], df.columns, "column", "null_count")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed summary, a row per column: (column, count, mean, stddev, min, max)."""
    columns = column_kinds(df)[0] if columns is None else present(df, columns)
    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return one_row.select(F.inline(F.array(*[F.col(c) for c in columns])))


def average_by(df: DataFrame, key: str, value: str = S.LABEL, name: str = "avg_tmp") -> DataFrame:
    """Mean of a measure per key value, in key order."""
    return df.groupBy(key).agg(F.avg(value).alias(name)).orderBy(key)


def distinct_keys(df: DataFrame, keys: Sequence[str] = ("year", "month")) -> DataFrame:
    return df.select(*keys).distinct().orderBy(*keys)


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] = tuple(S.CORRELATION_COLUMNS)
) -> DataFrame:
    """Pearson correlation of every ordered pair over the full table, in long form.

    Pairs are complete pairwise: a row counts for a pair if both values are there.
    The upper triangle is computed and mirrored: (x, y, corr).
    """
    columns = present(df, columns)
    pairs = list(combinations(columns, 2))
    one_row = df.agg(
        *[F.corr(x, y).alias(f"p{i}") for i, (x, y) in enumerate(pairs)],
        *[F.when(F.stddev_pop(c) > 0, 1.0).alias(f"d{i}") for i, c in enumerate(columns)],
    )
    cells = [(c, c, f"d{i}") for i, c in enumerate(columns)]
    for i, (x, y) in enumerate(pairs):
        cells += [(x, y, f"p{i}"), (y, x, f"p{i}")]
    rows = ", ".join(f"struct('{x}' AS x, '{y}' AS y, {v} AS corr)" for x, y, v in cells)
    return one_row.select(F.expr(f"inline(array({rows}))"))


def _finite(c: str) -> Column:
    """The value as a number; NULL if it is NaN or infinite."""
    x = F.col(c).cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def non_finite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN and infinite values, which histograms and limits leave out: (column, n_nan, n_inf)."""
    cells = []
    for c in columns:
        x = F.col(c).cast("double")
        inf = F.count_if(F.abs(x) == F.lit(float("inf")))
        cells.append(F.struct(F.lit(c).alias("column"), F.count_if(F.isnan(x)).alias("n_nan"), inf.alias("n_inf")))
    return df.agg(*[s.alias(f"c{i}") for i, s in enumerate(cells)]).select(
        F.inline(F.array(*[F.col(f"c{i}") for i in range(len(cells))]))
    )


def value_limits(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Least and greatest finite value of each column (runs one aggregation)."""
    row = df.agg(
        *[F.min(_finite(c)).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(_finite(c)).alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()
    return {
        c: (row[f"lo_{i}"], row[f"hi_{i}"])
        for i, c in enumerate(columns)
        if row[f"lo_{i}"] is not None
    }


def histogram(
    df: DataFrame,
    columns: Sequence[str],
    bins: int = 30,
    limits: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Equal-width histograms over the full table, empty bins included.

    Gives (column, bin, lo, hi, n). The last bin is closed. With ``limits`` known
    the table is read once, else the columns are held and limits taken first. Values
    outside given limits, NaN and infinities are not counted (``non_finite_counts``).
    """
    if limits is None:
        with persisted(df.select(*dict.fromkeys(columns))) as held:
            found = histogram(held, columns, bins, value_limits(held, columns))
            # A few rows per bin: safe to bring over before the columns are let go.
            return df.sparkSession.createDataFrame(found.collect(), found.schema)
    limits = dict(limits)
    for c, (lo, hi) in limits.items():
        if lo == hi:
            limits[c] = (lo - 0.5, hi + 0.5)
    spark = df.sparkSession
    names = [c for c in columns if c in limits]
    if not names:
        empty = "column string, bin int, lo double, hi double, n bigint"
        return spark.createDataFrame([], empty)

    def bin_of(c: str) -> Column:
        lo, hi = limits[c]
        x = _finite(c)
        raw = F.floor((x - F.lit(lo)) / F.lit((hi - lo) / bins)).cast("int")
        return F.when(x.between(lo, hi), F.least(raw, F.lit(bins - 1)))

    counted = (
        df.select(*[bin_of(c).alias(c) for c in names])
        .unpivot([], names, "column", "bin")
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = spark.createDataFrame(
        [
            (c, b, lo + b * (hi - lo) / bins, lo + (b + 1) * (hi - lo) / bins)
            for c in names
            for lo, hi in [limits[c]]
            for b in range(bins)
        ],
        "column string, bin int, lo double, hi double",
    )
    return edges.join(counted, ["column", "bin"], "left").select(
        "column", "bin", "lo", "hi", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def axis_limits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the least and greatest finite value over all the columns: (lo, hi)."""
    lows = [F.min(_finite(c)) for c in columns]
    highs = [F.max(_finite(c)) for c in columns]
    return df.agg(
        (F.least(*lows) if len(lows) > 1 else lows[0]).alias("lo"),
        (F.greatest(*highs) if len(highs) > 1 else highs[0]).alias("hi"),
    )


def map_points(df: DataFrame) -> DataFrame:
    """Distinct observation places with their row counts: (LATITUDE, LONGITUDE, n)."""
    places = ["LATITUDE", "LONGITUDE"]
    return df.dropna(subset=places).groupBy(*places).agg(F.count(F.lit(1)).alias("n"))


def top_k(df: DataFrame, measure: str, k: int, tie_break: str) -> DataFrame:
    """The k rows with the greatest measure, numbered from 1 in ``rank``.

    Spark keeps k rows per task for this. The numbering window sees those k only.
    """
    order = [F.desc(measure), F.asc(tie_break)]
    best = df.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
