"""Boosted trees with leaf penalties, grown by DataFrame aggregations.

Features are binned once, at exact quantiles, and rows are kept as bin numbers. A round adds a
tree to every model that is still growing; a level of it is one aggregation: sums of
the gradient and row counts per (model, node, feature, bin), combined on the map side; running sums along
the bins then give the best split per (model, node). Only those splits reach the driver. Rows find their node by an
expression over the tree's arrays, so they are never moved to it.

With gradient sum G and row count H (the second derivative of the squared error is 1), a
leaf weighs -T(G) / (H + lambda), T taking alpha off the absolute value, and scores T(G)**2 / (H + lambda).
A split gains the scores of both sides less that of the node, and stands if that is at least gamma
and both sides hold ``min_child_weight`` rows.

Many models grow side by side over the same rows: the draws of a search, or the subsets and
folds of a learning curve. A row has a role per model: to fit on, to stop by, held out, or none. Each round writes
the margins of all models to the shared folder and observes their losses in the same
pass, so a lost executor costs no earlier round and stopping needs no job of its own. A model stops
after ``patience`` rounds without a lesser loss on its stopping rows; no round is fitted beyond.

The draws of a search need nothing from each other. While the binned rows fit one task (``_ALONE``), each
draw is therefore grown in a task of its own, all its rounds without a job between them; its trees go to the
shared folder and only losses to the driver. Larger tables are grown side by side as above. Both give the same trees.

Gradients are summed as whole numbers of a fixed unit, chosen so that no sum overflows.
Sums are then exact, and with bins and samples that follow the row alone the same rows give the
same trees at any partitioning, alone or beside other models.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from skyledger.functions.numeric import key_hash
from skyledger.functions.text import as_column
from skyledger.operators.profile import top_k
from skyledger.operators.ranks import exact_quantiles
from skyledger.operators.sampling import assign_folds, hash_cuts, subset_sizes, validation_flag
from skyledger.session import discard, persisted, stored

# --- fixed values: parameters of the base model ------------------------------
DEFAULTS = {
    "n_estimators": 400, "learning_rate": 0.05, "max_depth": 6, "min_child_weight": 1.0,
    "subsample": 0.8, "colsample_bytree": 0.8, "reg_alpha": 0.0, "reg_lambda": 1.0, "gamma": 0.0,
}
PATIENCE = 50

BINS = 256
FIT, STOP, HELD = 1, 2, 3  # roles; 0 is none
_PICK = 1 << 20
_LEAST_GAIN = 1e-6  # below it a gain is rounding
_BITS = 60
_SHALLOW = 3  # depth up to which a tree is written as cases
_SPREAD = 64  # groups that choose splits side by side
_ALONE = 256 << 20  # bytes of rows up to which one task grows a model by itself
_LOW = 30  # low bits of a gradient, which are summed by themselves
_TREES = 16  # trees a task hands over together


def _literal(values: Sequence, kind: str) -> Column:
    """An array constant of any length, as one literal that is folded before the job runs."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


@dataclass
class Binned:
    """Rows as bin numbers (``key``, ``y``, ``bins``, kept columns), and the cuts that made them."""

    rows: DataFrame
    features: list[str]
    cuts: list[list[float]]


def bin_features(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] | None = None,
    keep: Sequence[str] = (), bins: int = BINS,
) -> Binned:
    """Bin numeric features at up to ``bins`` - 1 exact quantiles each, and store the rows.

    A value's bin is the number of cuts that are not above it; a missing value has bin -1 and stands before
    all numbers. Rows are told apart by a hash of the keys, or of label and features if none are given.
    """
    shares = [i / bins for i in range(1, bins)]
    columns = [f"__f{i}" for i in range(len(features))]
    narrow = df.select(
        key_hash(*(keys or [label, *features]), digits=15).alias("key"),
        as_column(label).cast("double").alias("y"),
        *[F.col(f"`{f}`").cast("double").alias(c) for f, c in zip(features, columns)],
        *keep,
    )
    def bin_of(feature: str, points: Sequence[float]) -> Column:
        x = F.nanvl(F.col(feature), F.lit(None))
        upto = F.lit(0)
        # Halving: each step looks at one cut, chosen by what is known so far.
        steps = max(1, len(points)).bit_length()
        if points:
            padded = _literal([*map(float, points), *[math.inf] * (2**steps - len(points))], "double")
            upto = F.aggregate(
                _literal([2**s for s in reversed(range(steps))], "int"), F.lit(0),
                lambda at, width: F.when(F.get(padded, at + width - 1) <= x, at + width).otherwise(at),
            )
            upto = F.least(upto, F.lit(len(points)))
        return F.when(x.isNull(), F.lit(-1)).otherwise(upto).cast("smallint")

    # Files of few bytes hold many rows, and every round reads and writes as many tasks as there are files.
    spread = narrow.repartition(df.sparkSession.sparkContext.defaultParallelism)
    with persisted(spread) as held:
        found = exact_quantiles(held, dict.fromkeys(columns, shares))
        cuts = [sorted({v for v in found[c] if v is not None}) for c in columns]
        places = F.array(*[bin_of(c, p) for c, p in zip(columns, cuts)]).alias("bins")
        rows = stored(held.select("key", "y", places, *held.columns[2 + len(columns):]), "binned")
    return Binned(rows, list(features), cuts)


def slots(vectors: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The slots of the ``features`` vector as columns, and the kept columns."""
    cells = vector_to_array("features")
    return vectors.select(*keep, *[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(names)])


@dataclass
class Tree:
    """One tree in heap order: children of node i are 2i + 1 and 2i + 2; feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @classmethod
    def root(cls, depth: int, root_value: float = 0.0, cover: float = 0.0) -> Tree:
        size = 2 ** (depth + 1) - 1
        tree = cls(
            np.full(size, -1), np.full(size, -1), np.zeros(size), np.zeros(size), np.zeros(size)
        )
        tree.value[0], tree.cover[0] = root_value, cover
        return tree

    def cut_back(self, depth: int) -> Tree:
        """Without levels below the given depth."""
        size = 2 ** (depth + 1) - 1
        return Tree(*(getattr(self, n)[:size] for n in ("feature", "bin", "value", "gain", "cover")))

    def depth(self) -> int:
        deepest = np.flatnonzero(self.feature >= 0)
        return int(deepest.max() + 1).bit_length() if len(deepest) else 0


def _weight(g, h, alpha, lam):
    return -math.copysign(max(abs(g) - alpha, 0.0), g) / (h + lam) if h + lam > 0 else 0.0


def _branch(tree: Tree, node: int, bins: str) -> Column:
    """The same for a shallow tree, as nested cases."""
    f = int(tree.feature[node])
    if f < 0:
        return F.lit(node)
    right = F.get(F.col(bins), F.lit(f)) > int(tree.bin[node])
    return F.when(right, _branch(tree, 2 * node + 2, bins)).otherwise(_branch(tree, 2 * node + 1, bins))


def node_of(tree: Tree, bins: str = "bins") -> Column:
    """Number of the node a row ends in."""
    depth = tree.depth()
    if not depth:
        return F.lit(0)
    if depth <= _SHALLOW:
        return _branch(tree, 0, bins)
    part = tree.cut_back(depth)
    feature, cut = _literal(part.feature.tolist(), "int"), _literal(part.bin.tolist(), "int")

    def down(node: Column, _: Column) -> Column:
        at = F.get(feature, node)
        right = (F.get(F.col(bins), at) > F.get(cut, node)).cast("int")
        return F.when(at >= 0, node * 2 + 1 + right).otherwise(node)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), down)


@dataclass
class Boosted:
    """A grown model: start value, trees with their rates, and the losses of every round fitted.

    ``losses`` holds (fit, stop, held) mean squared errors, None without such rows. ``kept``
    trees count: those up to the least loss on the stopping rows, or all.
    """

    features: list[str]
    cuts: list[list[float]]
    params: dict
    base: float
    trees: list[Tree] = field(default_factory=list)
    rates: list[float] = field(default_factory=list)
    losses: list[tuple] = field(default_factory=list)
    best: int | None = None
    rows: tuple = (0, 0, 0)  # fit, stop, held

    @property
    def kept(self) -> int:
        return len(self.rates) if self.best is None else self.best + 1

    def ends(self, patience: int | None) -> bool:
        """Note the last round's loss; whether no round follows."""
        round_ = len(self.losses) - 1
        stop = self.losses[-1][STOP - 1]
        if stop is not None and patience and (self.best is None or stop < self.losses[self.best][STOP - 1]):
            self.best = round_
        over = self.best is not None and round_ - self.best >= patience
        return over or round_ + 1 >= int(self.params["n_estimators"])

    def rmse(self, *which: int, at: int | None = None) -> float | None:
        """Root of the mean squared error over the given roles after the kept rounds."""
        losses = self.losses[self.kept - 1 if at is None else at]
        n = sum(self.rows[w - 1] for w in which)
        return math.sqrt(sum(losses[w - 1] * self.rows[w - 1] for w in which if self.rows[w - 1]) / n) if n else None

    def node_table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, cut, value, gain, cover) of the kept trees; leaves have no feature."""
        out = []
        for t, tree in enumerate(self.trees[: self.kept]):
            for i in _nodes(tree):
                f, b = int(tree.feature[i]), int(tree.bin[i])
                name, cut = (self.features[f], self.cuts[f][b] if b >= 0 else None) if f >= 0 else (None, None)
                out.append((t, int(i), name, cut, float(tree.value[i]), float(tree.gain[i]), float(tree.cover[i])))
        return spark.createDataFrame(
            out, "tree int, node int, feature string, cut double, value double, gain double, cover double"
        )

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """Add the prediction, in Arrow batches."""
        spark = df.sparkSession
        packed = [_packed(t, self.cuts) for t in self.trees[: self.kept]]
        held = spark.sparkContext.broadcast((packed, self.rates, self.base))

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            trees, rates, base = held.value
            x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
            return pd.Series(margins(x, trees, rates, base))

        inputs = [F.col(f"`{f}`").cast("double") for f in self.features]
        return df.withColumn(prediction, predict(*inputs))

    def save(self, spark: SparkSession, path: str) -> str:
        """Node table and description below a folder, overwritten."""
        self.node_table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        about = {
            "features": self.features, "params": self.params, "base": self.base,
            "rates": self.rates[: self.kept], "trees": self.kept,
        }
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/about")
        return path


def load(spark: SparkSession, path: str) -> Boosted:
    """A saved model; it predicts as before, its losses are not kept."""
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    nodes = spark.read.parquet(f"{path}/nodes").collect()
    cuts = {f: sorted({r["cut"] for r in nodes if r["feature"] == f and r["cut"] is not None}) for f in about["features"]}
    place = {f: i for i, f in enumerate(about["features"])}
    trees = []
    for t in range(about["trees"]):
        mine = [r for r in nodes if r["tree"] == t]
        tree = Tree.root(max(r["node"] + 1 for r in mine).bit_length())
        for r in mine:
            i = r["node"]
            if r["feature"] is not None:
                tree.feature[i] = place[r["feature"]]
                tree.bin[i] = -1 if r["cut"] is None else cuts[r["feature"]].index(r["cut"])
            tree.value[i], tree.gain[i], tree.cover[i] = r["value"], r["gain"], r["cover"]
        trees.append(tree)
    return Boosted(
        about["features"], [cuts[f] for f in about["features"]], about["params"], about["base"],
        trees, about["rates"],
    )


def _nodes(tree: Tree) -> list[int]:
    """Nodes that exist, from the root."""
    out, queue = [], [0]
    for i in queue:
        out.append(i)
        if tree.feature[i] >= 0:
            queue += [2 * i + 1, 2 * i + 2]
    return out


def _packed(tree: Tree, cuts: Sequence[Sequence[float]]):
    """Existing nodes only: feature, cut, left child, value. The right child follows the left."""
    nodes = _nodes(tree)
    at = {n: i for i, n in enumerate(nodes)}
    feature = tree.feature[nodes]
    cut = np.array([
        cuts[f][b] if f >= 0 and b >= 0 else -np.inf for f, b in zip(feature, tree.bin[nodes])
    ])
    left = np.array([at.get(2 * n + 1, i) for i, n in enumerate(nodes)])
    return feature, cut, left, tree.value[nodes]


def margins(x: np.ndarray, trees, rates: Sequence[float], base: float) -> np.ndarray:
    """Predictions for a matrix of features; a missing value goes left."""
    out = np.full(len(x), base)
    row = np.arange(len(x))
    for (feature, cut, left, value), rate in zip(trees, rates):
        node = np.zeros(len(x), np.int64)
        while True:
            split = feature[node] >= 0
            if not split.any():
                break
            at = x[row, np.maximum(feature[node], 0)]
            right = at >= cut[node]  # false for a missing value
            node = np.where(split, left[node] + right, node)
        out += rate * value[node]
    return out


# ------------------------------------------------------------------ growing ---
def _sampled(params: Mapping, seed: int, round_: int) -> Column:
    """Whether a row is in a round's sample; it depends on row, seed and round only."""
    share = float(params["subsample"])
    if share >= 1:
        return F.lit(True)
    pick = F.pmod(F.xxhash64("key", F.lit(seed), F.lit(round_)), F.lit(_PICK))
    return pick < F.lit(round(share * _PICK))


def _columns(params: Mapping, features: int, seed: int, round_: int) -> list[int]:
    """The features one tree may split on."""
    n = max(1, int(float(params["colsample_bytree"]) * features + 1e-9))
    if n >= features:
        return list(range(features))
    return sorted(np.random.RandomState((seed, round_)).permutation(features)[:n].tolist())


def _cells(
    state: DataFrame, growing, allowed: Mapping, features: int, seed: int, round_: int, level: int, unit: float
) -> DataFrame:
    """(m, node, f, bin, g, n): gradient sums and row counts of the nodes of a level."""
    at = []
    for m, params, tree in growing:
        node = node_of(tree) if level else F.lit(0)
        gradient = F.rint((F.get("margins", F.lit(m)) - F.col("y")) * unit).cast("long")
        used = (F.get("roles", F.lit(m)) == FIT) & _sampled(params, seed, round_)
        at.append(F.when(used, F.struct(F.lit(m).alias("m"), node.alias("node"), gradient.alias("g"))))
    rows = state.select("bins", F.explode(F.array_compact(F.array(*at))).alias("c")).filter(
        F.col("c.node") >= 2**level - 1
    )
    cells = rows.select("c.m", "c.node", "c.g", F.posexplode("bins").alias("f", "bin"))
    if any(len(c) < features for c in allowed.values()):
        most = max(allowed) + 1
        masks = [[f in allowed.get(m, ()) for f in range(features)] for m in range(most)]
        flat = _literal([b for row in masks for b in row], "boolean")
        cells = cells.filter(F.get(flat, F.col("m") * features + F.col("f")))
    return cells.groupBy("m", "node", "f", "bin").agg(F.sum("g").alias("g"), F.count("*").alias("n"))


def _choose(known: Mapping[int, Mapping], unit: float):
    """The best split of every (m, node) among its cells: gain, place, and sums; gain -1 if none stands."""

    def run(table: pa.Table) -> pa.Table:
        m, node, f, bin_, g, n = (table.column(c).to_numpy() for c in ("m", "node", "f", "bin", "g", "n"))
        order = np.lexsort((bin_, f, node, m))
        m, node, f, bin_, g, n = (x[order] for x in (m, node, f, bin_, g, n))
        new_node = np.ones(len(m), bool)
        new_node[1:] = (m[1:] != m[:-1]) | (node[1:] != node[:-1])
        new_feature = new_node.copy()
        new_feature[1:] |= f[1:] != f[:-1]
        starts = np.flatnonzero(new_feature)
        at = np.cumsum(new_feature) - 1  # the (m, node, f) of each cell
        # Whole numbers wrap around in running sums, and back in their differences.
        def along(x):
            total = np.cumsum(x)
            before = total[starts] - x[starts]
            whole = np.append(total[starts[1:] - 1], total[-1]) - before
            return total - before[at], whole[at]

        (gl, g), (hl, h) = along(g), along(n)
        gl, g = gl / unit, g / unit
        param = lambda name: np.array([float(known[i][name]) for i in m])
        alpha, lam = param("reg_alpha"), param("reg_lambda")

        def score(g, h):
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(h + lam > 0, np.maximum(np.abs(g) - alpha, 0) ** 2 / (h + lam), 0)

        gain = score(gl, hl) + score(g - gl, h - hl) - score(g, h)
        least = np.maximum(param("min_child_weight"), 1)
        stands = (hl >= least) & (h - hl >= least) & (gain > _LEAST_GAIN) & (gain >= param("gamma"))
        gain = np.where(stands, gain, -1.0)
        best = np.lexsort((bin_, f, -gain, np.cumsum(new_node)))
        best = best[np.flatnonzero(new_node)]
        return pa.table({
            "m": m[best], "node": node[best], "gain": gain[best], "f": f[best], "bin": bin_[best].astype(np.int32),
            "gl": gl[best], "hl": hl[best], "g": g[best], "h": h[best],
        })

    return run


def _best_splits(cells: DataFrame, growing, unit: float) -> list:
    """One row per (m, node): its best split. Cells of a node meet in one task, bins x features rows."""
    known = {m: p for m, p, _ in growing}
    spread = cells.groupBy(F.pmod(F.xxhash64("m", "node"), F.lit(_SPREAD)))
    return spread.applyInArrow(
        _choose(known, unit),
        "m int, node int, gain double, f int, bin int, gl double, hl long, g double, h long",
    ).collect()


def _grow_round(state, live, features: int, seed: int, round_: int, unit: float) -> dict[int, Tree]:
    """One more tree for each live model, level by level."""
    trees = {m: Tree.root(int(p["max_depth"])) for m, p in live}
    open_ = {m: p for m, p in live}
    allowed = {m: _columns(p, features, seed, round_) for m, p in live}
    level = 0
    while growing := [(m, p, trees[m]) for m, p in open_.items() if level < int(p["max_depth"]) or not level]:
        cells = _cells(state, growing, allowed, features, seed, round_, level, unit)
        found = _best_splits(cells, growing, unit)
        grew = set()
        for r in found:
            m, node = r["m"], r["node"]
            tree, p = trees[m], open_[m]
            alpha, lam = float(p["reg_alpha"]), float(p["reg_lambda"])
            if not level:
                tree.value[0], tree.cover[0] = _weight(r["g"], r["h"], alpha, lam), r["h"]
            if r["gain"] < 0 or level >= int(p["max_depth"]):
                continue
            tree.feature[node], tree.bin[node], tree.gain[node] = r["f"], r["bin"], r["gain"]
            for child, g, h in (
                (2 * node + 1, r["gl"], r["hl"]), (2 * node + 2, r["g"] - r["gl"], r["h"] - r["hl"])
            ):
                tree.value[child], tree.cover[child] = _weight(g, h, alpha, lam), h
            grew.add(m)
        open_ = {m: p for m, p in open_.items() if m in grew}
        level += 1
    return trees


def _rate(params: Mapping, round_: int) -> float:
    rate = params["learning_rate"]
    return float(rate[round_] if isinstance(rate, Sequence) else rate)


class _Errors:
    """Sums of squared errors, as whole numbers of a fixed unit and of a part of it.

    Neither sum overflows and both together hold a double, so a loss is the same however rows lie.
    """

    def __init__(self, grown: Sequence[Boosted], n: int, reach: float):
        whole = 50 - n.bit_length() - 2 * math.ceil(math.log2(max(reach, 1e-200)))
        self.unit = 2.0 ** max(min(whole, 52), -1000)
        self.part = 2 ** max(_BITS - n.bit_length(), 0)
        self.grown = grown

    def columns(self) -> list[Column]:
        out = []
        for m, g in enumerate(self.grown):
            error = F.get("margins", F.lit(m)) - F.col("y")
            square = error * error * F.lit(self.unit)
            whole = F.rint(square)
            rest = F.rint((square - whole) * F.lit(float(self.part)))
            for role in (FIT, STOP, HELD):
                if g.rows[role - 1]:
                    mine = F.get("roles", F.lit(m)) == role
                    out.append(F.sum(F.when(mine, whole.cast("long"))).alias(f"w{m}_{role}"))
                    out.append(F.sum(F.when(mine, rest.cast("long"))).alias(f"r{m}_{role}"))
        return out

    def of(self, m: int) -> _Errors:
        """The same for one model alone, as model 0."""
        one = object.__new__(_Errors)
        one.unit, one.part, one.grown = self.unit, self.part, [self.grown[m]]
        return one

    def sums(self, margin: np.ndarray, y: np.ndarray, role: np.ndarray) -> dict:
        """What ``columns`` gives for model 0, from rows in memory."""
        square = (margin - y) * (margin - y) * self.unit
        whole = np.rint(square)
        rest = np.rint((square - whole) * float(self.part))
        out = {}
        for r in (FIT, STOP, HELD):
            if self.grown[0].rows[r - 1]:
                out[f"w0_{r}"], out[f"r0_{r}"] = (int(x[role == r].astype(np.int64).sum()) for x in (whole, rest))
        return out

    def means(self, m: int, found: Mapping) -> tuple:
        """(fit, stop, held) mean squared errors of a model, None without such rows."""
        return tuple(
            (found[f"w{m}_{r}"] + found[f"r{m}_{r}"] / self.part) / self.unit / n if n else None
            for r, n in zip((FIT, STOP, HELD), self.grown[m].rows)
        )


def _begin(binned: Binned, models: Sequence[tuple[Mapping, Column | int]]):
    """Rows with their role per model, models without trees, the unit of gradients, and the errors to sum; None without rows."""
    merged = [{**DEFAULTS, **p} for p, _ in models]
    roles = F.array(*[F.coalesce(r if isinstance(r, Column) else F.lit(r), F.lit(0)).cast("tinyint") for _, r in models])
    start = binned.rows.filter(F.col("y").isNotNull() & ~F.isnan("y")).select("key", "y", "bins", roles.alias("roles"))
    n, low, high = start.agg(F.count("*"), F.min("y"), F.max("y")).first()
    if not n:
        return None, [Boosted(binned.features, binned.cuts, p, 0.0) for p in merged], 0.0, None
    # Whole numbers of 1 / unit: n sums of up to four ranges stay below 2**62.
    ends = [low, high, *(float(p["base_score"]) for p in merged if p.get("base_score") is not None)]
    reach = max(ends) - min(ends)
    unit = 2.0 ** (_BITS - n.bit_length() - math.ceil(math.log2(max(reach, 1e-200))) - 2)
    unit = min(unit, 2.0**52)
    shifted = F.rint((F.col("y") - low) * unit).cast("long")
    counts = [
        F.count_if(F.get("roles", F.lit(m)) == role).alias(f"n{m}_{role}")
        for m in range(len(models)) for role in (FIT, STOP, HELD)
    ]
    sums = [F.sum(F.when(F.get("roles", F.lit(m)) == FIT, shifted)).alias(f"s{m}") for m in range(len(models))]
    row = start.agg(*counts, *sums).first()
    grown = []
    for m, p in enumerate(merged):
        rows = tuple(row[f"n{m}_{r}"] for r in (FIT, STOP, HELD))
        base = p.get("base_score")
        if base is None:
            base = low + row[f"s{m}"] / unit / rows[0] if rows[0] else 0.0
        grown.append(Boosted(binned.features, binned.cuts, p, float(base), rows=rows))
    return start, grown, unit, _Errors(grown, n, reach)


def grow(
    binned: Binned, models: Sequence[tuple[Mapping, Column | int]], patience: int | None = None,
    seed: int = 42,
) -> list[Boosted]:
    """Grow a model per (parameters, role of each row) side by side over the same rows.

    ``learning_rate`` may be a list, one rate per round. A model without rows to fit on predicts 0.
    """
    return _side_by_side(len(binned.features), *_begin(binned, models), patience, seed)


def _side_by_side(features: int, start, grown: list[Boosted], unit: float, errors, patience, seed: int) -> list[Boosted]:
    if start is None:
        return grown
    state = stored(start.withColumn("margins", _literal([g.base for g in grown], "double")), "margins")
    live = [m for m, g in enumerate(grown) if g.rows[0] and int(g.params["n_estimators"]) > 0]
    round_ = 0
    while live:
        trees = _grow_round(
            state, [(m, grown[m].params) for m in live], features, seed, round_, unit
        )
        moved = []
        for m in range(len(grown)):
            margin = F.get("margins", F.lit(m))
            if m in trees:
                step = _rate(grown[m].params, round_) * trees[m].value[: 2 ** (trees[m].depth() + 1) - 1]
                margin = margin + F.get(_literal([float(v) for v in step], "double"), node_of(trees[m]))
            moved.append(margin)
        seen = Observation()
        after = state.withColumn("margins", F.array(*moved)).observe(seen, *errors.columns())
        before, state = state, stored(after, "margins")
        discard(before)
        found = seen.get
        for m in list(live):
            g = grown[m]
            g.trees.append(trees[m])
            g.rates.append(_rate(g.params, round_))
            g.losses.append(errors.means(m, found))
            if g.ends(patience):
                live.remove(m)
        round_ += 1
    discard(state)
    return grown


# ------------------------------------------------------------ growing alone ---
_PRIMES = [np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
)]


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _hashed(x: np.ndarray | int, seed: np.ndarray, size: int) -> np.ndarray:
    """Spark's xxhash64 of a number of 8 or 4 bytes on top of a hash."""
    p1, p2, p3, p4, p5 = _PRIMES
    x = np.atleast_1d(x).astype(np.int64).astype(np.uint64)  # arrays wrap around in silence
    h = seed + p5 + np.uint64(size)
    if size == 8:
        h = _turned(h ^ (_turned(x * p2, 31) * p1), 27) * p1 + p4
    else:
        h = _turned(h ^ ((x & np.uint64(0xFFFFFFFF)) * p1), 23) * p2 + p3
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def _cell_sums(cell: np.ndarray, g: np.ndarray, high: np.ndarray, low: np.ndarray, size: int):
    """Cells that hold rows, their gradient sums and row counts, in order; ``high`` and ``low`` are the parts of ``g``."""
    if size <= 4 * len(cell):
        n = np.bincount(cell, minlength=size)
        held = np.flatnonzero(n)
        sums = [np.bincount(cell, part, size)[held].astype(np.int64) for part in (high, low)]
        return held, (sums[0] << _LOW) + sums[1], n[held]
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    return cell[starts], np.add.reduceat(g[order], starts), np.diff(np.append(starts, len(cell)))


def _tree_alone(bins: np.ndarray, widths: Sequence[int], used: np.ndarray, g: np.ndarray, p: Mapping, allowed, unit: float):
    """The tree of one round over rows in memory, by the rules of ``_choose`` and ``_grow_round``.

    ``bins`` holds a line per feature, missing as 0; ``g`` the gradients of the ``used`` rows. Gives the columns of the
    tree's nodes (number, feature, bin, value, gain, cover) and the place of every row's node among them.
    """
    alpha, lam, gamma = (float(p[k]) for k in ("reg_alpha", "reg_lambda", "gamma"))
    least = max(float(p["min_child_weight"]), 1)

    def weight(g, h):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + lam > 0, -np.copysign(np.maximum(np.abs(g) - alpha, 0.0), g) / (h + lam), 0.0)

    def score(g, h):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + lam > 0, np.maximum(np.abs(g) - alpha, 0) ** 2 / (h + lam), 0)

    at = np.zeros(bins.shape[1], np.int32)
    total = g.sum()
    number, cover = [np.zeros(1, np.int64)], [np.array([float(len(g))])]
    value = [weight(total / unit, np.array([len(g)])) if len(g) else np.zeros(1)]
    feature, cut, gain = ([np.array([x])] for x in (-1, -1, 0.0))
    # Of the open nodes: place, number, gradient sum, rows. Of the rows in them: which, and in which node.
    place, heap, gs, hs = np.zeros(1, np.int32), np.zeros(1, np.int64), np.array([total]), np.array([len(g)])
    rows, slot = np.arange(bins.shape[1]), np.zeros(bins.shape[1], np.int32)
    mine, own = used, np.zeros(len(used), np.int32)
    high, low = (g >> _LOW).astype(float), (g & ((1 << _LOW) - 1)).astype(float)
    size = 1
    for _ in range(int(p["max_depth"])):
        wide = hs >= 2 * least  # others hold too few rows for two sides
        if not wide.all():
            renumber = np.where(wide, np.cumsum(wide) - 1, -1).astype(np.int32)
            place, heap, gs, hs = (x[wide] for x in (place, heap, gs, hs))
            stay = wide[slot]
            rows, slot = rows[stay], renumber[slot[stay]]
            stay = wide[own]
            mine, own, g, high, low = mine[stay], renumber[own[stay]], g[stay], high[stay], low[stay]
        k = len(heap)
        if not k:
            break
        best = np.full(k, -1.0)
        split = np.full((2, k), -1)  # feature, bin
        left = np.zeros((2, k), np.int64)  # gradient sum, rows
        whole = gs / unit
        for f in allowed:
            cell, sums, counts = _cell_sums(own * np.int32(widths[f]) + bins[f].take(mine), g, high, low, k * widths[f])
            node = cell // widths[f]
            first = np.append(0, np.cumsum(np.bincount(node, minlength=k))[:-1])  # an open node holds rows
            gl, hl = np.cumsum(sums), np.cumsum(counts)
            gl, hl = gl - (gl[first] - sums[first])[node], hl - (hl[first] - counts[first])[node]
            a, h = whole[node], hs[node]
            gained = score(gl / unit, hl) + score(a - gl / unit, h - hl) - score(whole, hs)[node]
            stands = (hl >= least) & (h - hl >= least) & (gained > _LEAST_GAIN) & (gained >= gamma)
            gained = np.where(stands, gained, -1.0)
            top = np.maximum.reduceat(gained, first)
            better = top > best  # of equal gains the first feature and bin stay
            if better.any():
                tops = np.flatnonzero((gained == top[node]) & better[node])
                tops = tops[np.append(True, node[tops][1:] != node[tops][:-1])]
                which = node[tops]
                best[which], split[0, which], split[1, which] = gained[tops], f, cell[tops] % widths[f]
                left[0, which], left[1, which] = gl[tops], hl[tops]
        grew = np.flatnonzero(best >= 0)
        if not len(grew):
            break
        renumber = np.full(k, -1, np.int32)
        renumber[grew] = np.arange(len(grew))
        heap, gs, hs, whole = heap[grew], gs[grew], hs[grew], whole[grew]
        (f, b), (gl, hl) = split[:, grew], left[:, grew]
        feature_, cut_, gain_ = (np.concatenate(x) for x in (feature, cut, gain))
        feature_[place[grew]], cut_[place[grew]], gain_[place[grew]] = f, b - 1, best[grew]

        def both(x, y):  # of the left and the right child, by turns
            return np.column_stack([x, y]).ravel()

        heap = both(2 * heap + 1, 2 * heap + 2)
        number.append(heap)
        value.append(both(weight(gl / unit, hl), weight(whole - gl / unit, hs - hl)))
        cover.append(both(hl, hs - hl).astype(float))
        gs, hs = both(gl, gs - gl), both(hl, hs - hl)
        feature, cut = [feature_, np.full(len(heap), -1)], [cut_, np.full(len(heap), -1)]
        gain = [gain_, np.zeros(len(heap))]
        place = np.arange(size, size + len(heap), dtype=np.int32)
        size += len(heap)

        def down(rows, slot):
            slot = renumber[slot]
            stay = slot >= 0
            rows, slot = rows[stay], slot[stay]
            return stay, rows, 2 * slot + (bins[f[slot], rows] > b[slot])

        _, rows, slot = down(rows, slot)
        at[rows] = place[slot]
        stay, mine, own = down(mine, own)
        g, high, low = g[stay], high[stay], low[stay]
    nodes = [np.concatenate(x) for x in (number, feature, cut, value, gain, cover)]
    return nodes, at


def _rounds_alone(bins, widths, y, key, role, model: Boosted, unit: float, errors: _Errors, patience, seed: int):
    """Grow all rounds of a model over rows in memory; yields the nodes of every tree and its losses."""
    p = model.params
    fit = np.flatnonzero(role == FIT)
    margin = np.full(len(y), model.base)
    share = round(float(p["subsample"]) * _PICK)
    seeded = _hashed(seed, _hashed(key[fit], np.uint64(42), 8), 4 if abs(seed) < 1 << 31 else 8)
    over = not len(fit) or int(p["n_estimators"]) < 1
    while not over:
        round_ = len(model.losses)
        used = fit
        if float(p["subsample"]) < 1:
            used = fit[(_hashed(round_, seeded, 4) & np.uint64(_PICK - 1)) < share]
        g = np.rint((margin[used] - y[used]) * unit).astype(np.int64)
        nodes, at = _tree_alone(bins, widths, used, g, p, _columns(p, len(widths), seed, round_), unit)
        margin += (_rate(p, round_) * nodes[3])[at]
        model.losses.append(errors.means(0, errors.sums(margin, y, role)))
        over = model.ends(patience)
        yield nodes, model.losses[-1]


_NODES = {"node": "int", "feature": "int", "bin": "int", "value": "double", "gain": "double", "cover": "double"}


def _packed_rows(models: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows as bytes, a line per model and batch."""

    def run(batches):
        for batch in batches:
            bins, roles = (batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) for c in ("bins", "roles"))
            rest = [batch.column("key").to_numpy().tobytes(), batch.column("y").to_numpy().tobytes()]
            shifted = (bins.T + 1).astype(np.uint16).tobytes()  # a line per feature, missing as 0
            for m in range(models):
                yield pa.RecordBatch.from_pylist(
                    [{"m": m, "n": batch.num_rows, "key": rest[0], "y": rest[1], "bins": shifted,
                      "role": roles[:, m].astype(np.int8).tobytes()}],
                    pa.schema([("m", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("key", "y", "bins", "role")]]),
                )

    return run


def _grown_alone(grown: list[Boosted], widths: Sequence[int], unit: float, errors: _Errors, patience, seed: int):
    """Grow the model whose packed rows a task holds."""
    lists = {"int": pa.list_(pa.int32()), "double": pa.list_(pa.float64())}
    schema = pa.schema([
        ("m", pa.int32()), ("round", pa.int32()), *[(c, pa.float64()) for c in ("fit", "stop", "held")],
        *[(c, lists[t]) for c, t in _NODES.items()],
    ])

    def run(batches):
        packs, m = [], None
        for line in (r for batch in batches for r in batch.to_pylist()):
            m = line["m"]
            packs.append([
                np.frombuffer(line["bins"], np.uint16).reshape(len(widths), line["n"]),
                *[np.frombuffer(line[c], t) for c, t in (("y", np.float64), ("key", np.int64), ("role", np.int8))],
            ])
        if m is None:
            return
        rows = [np.concatenate([p.pop(0) for p in packs], axis=-1) for _ in range(4)]
        one = errors.of(m)
        made = []
        for round_, (nodes, losses) in enumerate(_rounds_alone(rows[0], widths, *rows[1:], grown[m], unit, one, patience, seed)):
            made.append([m, round_, *losses, *nodes])
            if len(made) == _TREES:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*made), schema)], schema=schema)
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*made), schema)], schema=schema)

    return run


def _fits_alone(rows: int, features: int) -> bool:
    """Whether one task holds the rows: two bytes a feature and eight numbers a row; growing takes about twice that."""
    return rows * (2 * features + 64) <= _ALONE and rows < 1 << (53 - _LOW)


def _apart(binned: Binned, start: DataFrame, grown: list[Boosted], unit: float, errors: _Errors, patience, seed: int):
    """Grow every model in a task of its own; the table of their trees. Models get their losses, not the trees."""
    packed = start.mapInArrow(_packed_rows(len(grown)), "m int, n int, key binary, y binary, bins binary, role binary")
    # The longest first, so that they are not alone in the end.
    order = sorted(range(len(grown)), key=lambda m: -int(grown[m].params["n_estimators"]) * int(grown[m].params["max_depth"]))
    turn = F.get(_literal(np.argsort(order).tolist(), "int"), F.col("m"))
    widths = [len(c) + 2 for c in binned.cuts]
    trees = packed.repartitionById(len(grown), turn).mapInArrow(
        _grown_alone(grown, widths, unit, errors, patience, seed),
        "m int, round int, fit double, stop double, held double, "
        + ", ".join(f"{c} array<{t}>" for c, t in _NODES.items()),
    )
    trees = stored(trees, "trees")
    for r in sorted(trees.select("m", "round", "fit", "stop", "held").collect()):
        g = grown[r["m"]]
        g.losses.append((r["fit"], r["stop"], r["held"]))
        g.rates.append(_rate(g.params, r["round"]))
        g.ends(patience)
    return trees


def _with_trees(model: Boosted, m: int, trees: DataFrame) -> Boosted:
    """The model with its kept trees from the table of all."""
    for r in sorted(trees.filter((F.col("m") == m) & (F.col("round") < model.kept)).collect(), key=lambda r: r["round"]):
        tree = Tree.root((max(r["node"]) + 1).bit_length() - 1)
        for c in ("feature", "bin", "value", "gain", "cover"):
            getattr(tree, c)[r["node"]] = r[c]
        model.trees.append(tree)
    return model


def fit(
    binned: Binned, params: Mapping | None = None, validation: str | None = None,
    patience: int | None = None, seed: int = 42,
) -> Boosted:
    """One model; rows that a boolean ``validation`` column marks stop it by patience, 50 rounds unless given."""
    role = F.when(F.col(validation), STOP).otherwise(FIT) if validation else FIT
    if validation and patience is None:
        patience = PATIENCE
    return grow(binned, [(params or {}, role)], patience, seed)[0]


def rounds_table(spark: SparkSession, model: Boosted) -> DataFrame:
    """(round, loss, kept): loss on the stopping rows, or on the fitted ones without any."""
    which = STOP if model.rows[STOP - 1] else FIT
    rows = [(i + 1, float(loss[which - 1]), i < model.kept) for i, loss in enumerate(model.losses)]
    return spark.createDataFrame(rows, "round int, loss double, kept boolean")


@dataclass
class Draws:
    """Outcome of a search: the model of the best draw (read when asked for), its parameters, and all trials."""

    read: Callable[[], Boosted]
    best: dict
    trials: DataFrame

    @cached_property
    def model(self) -> Boosted:
        return self.read()


def search(
    binned: Binned, draws: Sequence[Mapping], validation: str, patience: int = PATIENCE,
    seed: int = 42, together: int = 20,
) -> Draws:
    """Fit every draw with early stopping, each in a task of its own, or up to ``together`` of them side by side.

    The least validation error wins, the first draw on ties. Its model is what a fit of that draw alone
    on the same rows gives, so it needs no refit. Trials carry the parameters, the trees kept and the error.
    """
    role = F.when(F.col(validation), STOP).otherwise(FIT)
    grown: list[Boosted] = []
    readers: list[Callable[[], Boosted]] = []
    for first in range(0, len(draws), together):
        start, some, unit, errors = _begin(binned, [(d, role) for d in draws[first : first + together]])
        if start is not None and _fits_alone(sum(some[0].rows), len(binned.features)):
            trees = _apart(binned, start, some, unit, errors, patience, seed)
            readers += [partial(_with_trees, g, m, trees) for m, g in enumerate(some)]
        else:
            some = _side_by_side(len(binned.features), start, some, unit, errors, patience, seed)
            readers += [partial(lambda g: g, g) for g in some]
        grown += some
    scores = [g.rmse(STOP) for g in grown]
    best = min(range(len(draws)), key=lambda i: scores[i])
    rows = [{**d, "trial": i, "trees": g.kept, "rmse": scores[i]} for i, (d, g) in enumerate(zip(draws, grown))]
    spark = binned.rows.sparkSession
    return Draws(readers[best], dict(draws[best]), spark.createDataFrame(rows))


def learning_curve(
    binned: Binned, keys: Sequence[str], params: Mapping | None = None, steps: int = 6, folds: int = 3,
    seed: int = 42, patience: int | None = PATIENCE, early_percent: int = 15, cells: bool = False,
) -> DataFrame:
    """Mean training and validation error by number of rows: (size, train_rmse, val_rmse).

    All subsets and folds grow side by side. Subsets are nested; of each training part, ``early_percent`` of the rows
    stop the fit and still count as training rows in its error. Rows of one key stay together. The
    keys are kept columns of the binned rows. With ``cells``, a row per subset and fold instead.
    """
    rows = assign_folds(binned.rows, keys, folds, "__fold", salt=f"fold{seed}")
    rows = validation_flag(rows, keys, early_percent, "__early", salt=f"validation{seed}")
    sizes = subset_sizes(rows.count(), steps)
    place, cuts = hash_cuts(rows, sizes, keys, seed)
    inside = F.when(F.col("__early"), STOP).otherwise(FIT) if patience else F.lit(FIT)
    models = [
        (params or {}, F.when(place <= cut, F.when(F.col("__fold") == k, HELD).otherwise(inside)).otherwise(0))
        for cut in cuts for k in range(folds)
    ]
    grown = grow(Binned(rows, binned.features, binned.cuts), models, patience, seed)
    out = [
        (n, k, grown[i * folds + k].kept, grown[i * folds + k].rmse(FIT, STOP), grown[i * folds + k].rmse(HELD))
        for i, n in enumerate(sizes) for k in range(folds)
    ]
    spark = binned.rows.sparkSession
    if cells:
        return spark.createDataFrame(out, "size bigint, fold int, trees int, train_rmse double, val_rmse double")
    means = [
        (n, *(float(np.mean([c[j] for c in out if c[0] == n])) for j in (3, 4))) for n in dict.fromkeys(sizes)
    ]
    return spark.createDataFrame(means, "size bigint, train_rmse double, val_rmse double")


def importance(nodes: DataFrame, features: Sequence[str], kind: str = "gain") -> DataFrame:
    """(feature, importance) from a node table: mean gain or cover per split, or splits (``weight``).

    Only features that were split on have one. A model without any split gives every feature 0.
    """
    measure = {"gain": F.avg("gain"), "cover": F.avg("cover"), "weight": F.count("*").cast("double")}[kind]
    splits = nodes.filter("feature is not null").groupBy("feature").agg(measure.alias("importance"))
    if splits.isEmpty():
        return nodes.sparkSession.createDataFrame([(f, 0.0) for f in features], "feature string, importance double")
    return splits


def top_importance(nodes: DataFrame, features: Sequence[str], k: int = 20) -> DataFrame:
    """The k features with the largest mean gain per split, ranked."""
    return top_k(importance(nodes, features), "importance", k, "feature")
