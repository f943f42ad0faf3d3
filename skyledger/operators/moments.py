"""Linear models from moments: one scan, whatever the number of fits.

The row count, the means and the sums of products of deviations of features and label are all
a linear fit needs of its rows, and all its error on other rows needs of those. They are gathered per
group in one aggregation (means and co-moments merge without cancellation), as many numbers as
features squared, and add up: the moments of two groups give those of both. So every training
set that is a union of groups is solved, and every held-out group is scored, without a look
at the rows. Penalties follow the library's regressions: features are standardised by their sample deviation,
the L1 part takes lambda * alpha off a coordinate, the L2 part is divided by the label's deviation.
"""

from __future__ import annotations

from collections.abc import Hashable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.operators import features as X
from skyledger.operators.sampling import assign_folds, hash_cuts, subset_sizes


@dataclass
class Moments:
    """Row count, means, and sums of products of deviations; the label is the last column."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        return Moments(
            n, self.mean + gap * (other.n / n),
            self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n),
        )

    @classmethod
    def none(cls, columns: int) -> Moments:
        return cls(0, np.zeros(columns), np.zeros((columns, columns)))

    def deviations(self) -> np.ndarray:
        """Sample standard deviations of the features; 1 for a constant one, which gets no weight."""
        dev = np.sqrt(np.diag(self.products)[:-1] / max(self.n - 1, 1))
        return np.where(dev > 0, dev, 1.0)

    def rmse(self, line: Line) -> float | None:
        """Error of a line over the rows these moments are of."""
        if not self.n:
            return None
        w = np.append(-line.slopes, 1.0)
        bias = w @ self.mean - line.intercept
        return float(np.sqrt(max(w @ self.products @ w, 0.0) / self.n + bias * bias))


@dataclass
class Line:
    """Intercept and slopes on the features as they are."""

    intercept: float
    slopes: np.ndarray


def gather(
    df: DataFrame, features: Sequence[str], label: str, by: Mapping[str, Column] | None = None,
    handle_invalid: str = "error",
) -> dict[tuple, Moments]:
    """Moments per group, in one scan; groups are few and named by expressions.

    Rows with a missing value or NaN raise an error, or are left out with ``skip``.
    """
    columns = [*features, label]
    by = dict(by or {})
    x = [F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]
    rows = df.select(*[e.alias(f"__{n}") for n, e in by.items()], *x)
    bad = F.lit(False)
    for i in range(len(columns)):
        bad = bad | F.col(f"c{i}").isNull() | F.isnan(f"c{i}")
    seen = [F.when(~bad, F.col(f"c{i}")) for i in range(len(columns))]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    found = rows.groupBy(*[f"__{n}" for n in by]).agg(
        F.count_if(~bad).alias("n"), F.count_if(bad).alias("bad"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(seen)],
        *[F.covar_pop(seen[i], seen[j]).alias(f"p{i}_{j}") for i, j in pairs],
    ).collect()
    if handle_invalid == "error" and any(r["bad"] for r in found):
        raise ValueError(f"null or NaN in {columns}; pass handle_invalid='skip' to leave such rows out")
    out = {}
    for r in found:
        made = Moments.none(len(columns))
        if r["n"]:
            made = Moments(r["n"], np.array([r[f"m{i}"] for i in range(len(columns))]), made.products)
            for i, j in pairs:
                made.products[i, j] = made.products[j, i] = r[f"p{i}_{j}"] * r["n"]
        out[tuple(r[f"__{n}"] for n in by)] = made
    return out


def total(groups: Mapping[Hashable, Moments], columns: int) -> Moments:
    """Moments of all groups together, added in the order of their names."""
    out = Moments.none(columns)
    for key in sorted(groups, key=repr):
        out = out + groups[key]
    return out


def solve(
    moments: Moments, alpha: float = 0.0, reg_param: float = 0.0, start: np.ndarray | None = None,
    sweeps: int = 10_000, tolerance: float = 1e-13,
) -> tuple[Line, np.ndarray]:
    """The line of one penalty, and its slopes on standardised features to start the next from."""
    p = len(moments.mean) - 1
    dev = moments.deviations()
    flat = np.diag(moments.products)[:-1] <= 0
    g = moments.products[:p, :p] / moments.n / np.outer(dev, dev)
    c = moments.products[:p, p] / moments.n / dev
    spread = float(np.sqrt(moments.products[p, p] / moments.n))
    if not spread or flat.all():
        w = np.zeros(p)
    elif alpha == 0.0 or reg_param == 0.0:
        ridge = reg_param / spread * np.eye(p) if reg_param else 0.0
        w = np.zeros(p)
        use = np.flatnonzero(~flat)
        w[use] = np.linalg.lstsq((g + ridge)[np.ix_(use, use)], c[use], rcond=None)[0]
    else:
        w = np.zeros(p) if start is None else start.copy()
        l1, l2 = reg_param * alpha, reg_param * (1 - alpha) / spread
        for _ in range(sweeps):
            before = w.copy()
            for j in np.flatnonzero(~flat):
                r = c[j] - g[j] @ w + g[j, j] * w[j]
                w[j] = np.sign(r) * max(abs(r) - l1, 0.0) / (g[j, j] + l2)
            if np.abs(w - before).max() <= tolerance * max(np.abs(w).max(), 1e-300):
                break
    slopes = w / dev
    return Line(float(moments.mean[p] - slopes @ moments.mean[:p]), slopes), w


def path(moments: Moments, alpha: float, penalties: Sequence[float]) -> dict[float, Line]:
    """The lines of all penalties, largest first, each started from the one before."""
    lines, w = {}, None
    for r in sorted(set(penalties), reverse=True):
        lines[r], w = solve(moments, alpha, r, w)
    return {r: lines[r] for r in penalties}


def pipeline(
    spark: SparkSession, moments: Moments, line: Line, features: Sequence[str], label: str,
    handle_invalid: str = "error",
) -> PipelineModel:
    """The line as a fitted pipeline: assemble, standardise, regress.

    Spark makes such models by fitting only, so the scaler is fitted on two points with the wanted mean
    and deviation, and the regression on the points that span the plane.
    """
    p = len(features)
    mean, dev = moments.mean[:p], moments.deviations()
    flat = np.diag(moments.products)[:-1] <= 0
    half = np.where(flat, 0.0, dev / np.sqrt(2))
    two = spark.createDataFrame([(Vectors.dense(mean + s * half),) for s in (-1, 1)], ["features"])
    scale: StandardScaler = X.standardizer()
    w, level = line.slopes * dev, line.intercept + line.slopes @ mean
    corners = [(float(level), Vectors.dense(np.zeros(p)))]
    corners += [(float(level + w[j]), Vectors.dense(np.eye(p)[j])) for j in range(p)]
    corners += [(float(level - w[j]), Vectors.dense(-np.eye(p)[j])) for j in range(p)]
    plane = LinearRegression(featuresCol="scaledFeatures", labelCol=label, solver="normal")
    regression = plane.fit(spark.createDataFrame(corners, [label, "scaledFeatures"]).coalesce(1))
    return PipelineModel([X.assembler(features, handle_invalid), scale.fit(two.coalesce(1)), regression])


def learning_curve(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str,
    alpha: float = 0.0, reg_param: float = 0.0, steps: int = 6, folds: int = 3, seed: int = 42,
    handle_invalid: str = "error",
) -> DataFrame:
    """Mean training and validation error of a linear fit by number of rows: (size, train_rmse, val_rmse).

    A row belongs to the smallest subset that holds it and to one fold; the moments of these steps x
    folds cells come from one scan and add up to every training set. Subsets and folds are those of
    the general learning curve; rows of one key stay together.
    """
    sizes = subset_sizes(df.count(), steps)
    place, cuts = hash_cuts(df, sizes, keys, seed)
    step = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        step = F.when(place <= cuts[i], F.lit(i)).otherwise(step)
    rows = assign_folds(df, keys, folds, "__fold", salt=f"fold{seed}")
    cells = gather(rows, features, label, {"step": step, "fold": F.col("__fold")}, handle_invalid)
    width, out = len(features) + 1, []
    for i, n in enumerate(sizes):
        scores = []
        for k in range(folds):
            inside = total({c: m for c, m in cells.items() if c[0] <= i and c[1] != k}, width)
            outside = total({c: m for c, m in cells.items() if c[0] <= i and c[1] == k}, width)
            if inside.n:
                line, _ = solve(inside, alpha, reg_param)
                scores.append((inside.rmse(line), outside.rmse(line)))
        out.append((n, *(_mean([s[j] for s in scores]) for j in (0, 1))))
    return df.sparkSession.createDataFrame(out, "size bigint, train_rmse double, val_rmse double")


def _mean(values: Sequence[float | None]) -> float | None:
    known = [v for v in values if v is not None]
    return float(np.mean(known)) if known else None
