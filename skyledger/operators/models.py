"""Distributed regression models.

Fitting and scoring stay on executors. What reaches the driver is what a model is
made of (coefficients, trees) and a score per candidate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schema as S
from skyledger.functions.numeric import key_bucket, rmse
from skyledger.operators import features as X
from skyledger.operators.columns import model_columns
from skyledger.operators.moments import Moments, gather, path, pipeline
from skyledger.operators.sampling import (
    assign_folds, nested_samples, subset_sizes, validation_flag,
)
from skyledger.session import TRAIN_PARTITIONS, held_for_training, persisted, shared_folder, stored

# --- fixed values: penalty grids, tried for each mixing weight ---------------
RIDGE_GRID = [1e-6, 1e-5, 1e-4, 1e-3, 3e-3, 1e-2, 3e-2, 1e-1, 3e-1, 1.0]
LASSO_GRID = [1e-5, 1e-4, 1e-3, 3e-3, 1e-2, 3e-2, 1e-1]
ALPHAS = [0.0, 0.25, 0.5, 0.75, 1.0]

# --- fixed values: boosting defaults and search ranges -----------------------
BOOSTED_DEFAULTS = {
    "n_estimators": 400, "learning_rate": 0.05, "max_depth": 6,
    "subsample": 0.8, "colsample_bytree": 0.8,
}
SEARCH_SPACE = {
    "n_estimators": ("hundreds", 200, 1201),
    "learning_rate": ("real", 0.01, 0.3),
    "max_depth": ("whole", 3, 13),
    "min_child_weight": ("whole", 1, 10),
    "subsample": ("real", 0.5, 1.0),
    "colsample_bytree": ("real", 0.5, 1.0),
    "reg_alpha": ("real", 0.0, 1.0),
    "reg_lambda": ("real", 0.0, 2.0),
    "gamma": ("real", 0.0, 2.0),
}
# Spark's boosted trees have no leaf-weight penalties, and minInfoGain is the gain per row where
# gamma is a total per split. ``operators.boosting`` has all of them.
BOOSTED_PARAMS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "min_child_weight": "minInstancesPerNode",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
}


# ------------------------------------------------------------------ linear ---
def fit_ols(
    train: DataFrame,
    features: Sequence[str] = tuple(S.LINEAR_FEATURES),
    label: str = S.LABEL,
    handle_invalid: str = "error",
) -> PipelineModel:
    """Ordinary least squares; the moments are gathered in one pass."""
    assemble = X.assembler(features, handle_invalid)
    regression = LinearRegression(featuresCol="features", labelCol=label, maxIter=100)
    vectors = assemble.transform(model_columns(train, label, features))
    return PipelineModel([assemble, regression.fit(vectors.select(label, "features"))])


def regularized(alpha: float, reg_param: float, label: str = S.LABEL) -> LinearRegression:
    """Ridge (alpha 0), lasso (alpha 1) or elastic net on standardised features."""
    return LinearRegression(
        featuresCol="scaledFeatures", labelCol=label, elasticNetParam=float(alpha),
        regParam=float(reg_param), maxIter=200, standardization=False, tol=1e-10,
    )


def fit_penalized(
    train: DataFrame,
    alpha: float,
    reg_param: float,
    features: Sequence[str] = tuple(S.LINEAR_FEATURES),
    label: str = S.LABEL,
    handle_invalid: str = "error",
) -> PipelineModel:
    """One regularised fit: assemble, standardise, regress."""
    assemble = X.assembler(features, handle_invalid)
    vectors = assemble.transform(model_columns(train, label, features)).select(label, "features")
    scale = X.standardizer().fit(vectors)
    model = regularized(alpha, reg_param, label).fit(scale.transform(vectors))
    return PipelineModel([assemble, scale, model])


@dataclass
class Search:
    """Outcome of a search: the model refitted on the best candidate, and all trials."""

    model: PipelineModel
    best: dict
    trials: DataFrame


def default_grid(alpha: float) -> list[float]:
    return RIDGE_GRID if alpha == 0.0 else LASSO_GRID


def search_penalties(
    train: DataFrame,
    grids: Mapping[float, Sequence[float] | None],
    features: Sequence[str] = tuple(S.LINEAR_FEATURES),
    label: str = S.LABEL,
    train_ratio: float = 0.8,
    keys: Sequence[str] | None = None,
    handle_invalid: str = "error",
    validation: str | None = None,
) -> dict[float, Search]:
    """Per mixing weight, pick the penalty with the least validation RMSE and refit on all rows.

    Validation rows are those a boolean ``validation`` column marks, or a share picked by
    a hash of the key columns (of label and features if none are given), so the same rows
    are held out at any partitioning. One scan gathers the moments of both parts
    (``operators.moments``); every candidate is solved and scored from them, whatever the
    number of weights and penalties. Trials: (reg_param, rmse).
    """
    if validation:
        held_out = F.coalesce(F.col(validation), F.lit(False))
    else:
        percent = round(100 * (1 - train_ratio))
        held_out = key_bucket(*(keys or [label, *features]), salt="validation") < percent
    found = gather(train, features, label, {"out": held_out}, handle_invalid)
    none = Moments.none(len(features) + 1)
    fitted, out = found.get((False,), none), found.get((True,), none)
    if not fitted.n or not out.n:
        raise ValueError("a penalty search needs training and validation rows")
    whole, spark, results = fitted + out, train.sparkSession, {}
    for a, grid in grids.items():
        tried = default_grid(a) if grid is None else list(grid)
        scores = {r: out.rmse(line) for r, line in path(fitted, a, tried).items()}
        best = min(scores, key=scores.get)
        model = pipeline(spark, whole, path(whole, a, tried)[best], features, label, handle_invalid)
        trials = spark.createDataFrame(
            [(float(r), s) for r, s in scores.items()], "reg_param double, rmse double"
        )
        results[a] = Search(model, {"elasticNetParam": float(a), "best_regParam": float(best)}, trials)
    return results


def search_penalty(
    train: DataFrame, alpha: float, grid: Sequence[float] | None = None, *args, **options
) -> Search:
    """``search_penalties`` for one mixing weight."""
    return search_penalties(train, {alpha: grid}, *args, **options)[alpha]


# ------------------------------------------------------------------- trees ---
def fit_forest(
    train: DataFrame,
    features: Sequence[str] = tuple(S.FOREST_FEATURES),
    label: str = S.LABEL,
    num_trees: int = 80,
    max_depth: int = 10,
    subsample: float = 0.7,
    seed: int = 42,
    relative_error: float = 0.001,
    feature_subset: str = "sqrt",
    bootstrap: bool = True,
    partitions: int = TRAIN_PARTITIONS,
) -> PipelineModel:
    """Random forest on features with missing values set to the exact median."""
    table = model_columns(train, label, features)
    with persisted(table) as rows:
        impute = X.fit_exact_median(rows, features, relative_error)
        assemble = X.assembler([c + X.IMPUTED for c in features])
        forest = RandomForestRegressor(
            featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
            subsamplingRate=subsample, featureSubsetStrategy=feature_subset, seed=seed,
            bootstrap=bootstrap,
            # A row keeps its node per tree, instead of a walk from every root at every level.
            cacheNodeIds=True, checkpointInterval=-1,
        )
        vectors = assemble.transform(impute.transform(rows)).select(label, "features")
        with held_for_training(vectors, partitions) as held:
            return PipelineModel([impute, assemble, forest.fit(held)])


def boosted(params: Mapping, label: str = S.LABEL, seed: int = 42, **extra) -> GBTRegressor:
    """Boosted trees from parameters under their usual names.

    Rounds run one after the other: each tree is grown by the cluster, but 400 trees
    are 400 dependent steps.
    """
    known = {BOOSTED_PARAMS[k]: v for k, v in params.items() if k in BOOSTED_PARAMS}
    if "featureSubsetStrategy" in known:
        known["featureSubsetStrategy"] = str(known["featureSubsetStrategy"])
    return GBTRegressor(
        featuresCol="features", labelCol=label, lossType="squared", seed=seed, **known, **extra
    )


def prepare_boosting(
    train: DataFrame,
    label: str = S.LABEL,
    exclude: Sequence[str] = ("DATE",),
    keep: Sequence[str] = (),
    numbers: Sequence[str] = ("STATION",),
) -> tuple[PipelineModel, DataFrame, list[str]]:
    """Fit the feature preparation on every column but label and excluded ones.

    Text columns in ``numbers`` become one numeric feature each.

    Gives the fitted preparation, the training vectors (label, ``features`` and the
    kept columns) and the names of the vector's slots.
    """
    left_out = [label, *exclude, *keep]
    # Written once: medians, categories and vectors all read it, not the steps that made it.
    held = stored(train.drop(*exclude), "boosting-rows")
    stages, numeric = X.preparation(held, left_out, numbers)
    fitted = stages.fit(held)
    vectors = fitted.transform(held).select(*dict.fromkeys([label, "features", *keep]))
    return fitted, vectors, X.encoded_names(fitted, numeric)


def fit_boosted(
    vectors: DataFrame,
    params: Mapping | None = None,
    label: str = S.LABEL,
    seed: int = 42,
    validation: str | None = None,
    tolerance: float = 0.01,
    patience: int | None = None,
    partitions: int = TRAIN_PARTITIONS,
):
    """Boosted trees on prepared vectors.

    With a boolean ``validation`` column, adding trees stops as soon as the error on
    the marked rows no longer improves by the tolerance. With ``patience`` as well, it
    stops after so many rounds without a new least error, and the trees up to the best
    round are kept; Spark has no such rule, so all rounds are fitted on the unmarked rows,
    their errors evaluated, and the kept number of rounds, which come out the same, is fitted.
    """
    shared_folder(vectors.sparkSession)
    if validation and patience:
        return _fit_patient(vectors, params or {}, label, seed, validation, patience, partitions)[0]
    extra = {}
    if validation:
        extra = {"validationIndicatorCol": validation, "validationTol": tolerance}
    columns = [label, "features", *([validation] if validation else [])]
    with held_for_training(vectors.select(*columns), partitions) as held:
        return boosted({**BOOSTED_DEFAULTS, **(params or {})}, label, seed, **extra).fit(held)


def patient_rounds(losses: Sequence[float], patience: int) -> int:
    """Rounds to keep: up to the least loss before ``patience`` rounds without a lesser one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def _fit_patient(vectors, params, label, seed, validation, patience, partitions=TRAIN_PARTITIONS):
    """The model of the kept rounds, and the validation loss of every round."""
    shared_folder(vectors.sparkSession)
    merged = {**BOOSTED_DEFAULTS, **params}
    marked = vectors.filter(F.col(validation)).select(label, "features")
    with held_for_training(
        vectors.filter(~F.col(validation)).select(label, "features"), partitions
    ) as held:
        model = boosted(merged, label, seed).fit(held)
        losses = list(model.evaluateEachIteration(marked, "squared"))
        rounds = patient_rounds(losses, patience)
        if rounds < len(losses):
            model = boosted({**merged, "n_estimators": rounds}, label, seed).fit(held)
    return model, losses


def patient_boosting(
    vectors: DataFrame, validation: str, params: Mapping | None = None, patience: int = 50,
    label: str = S.LABEL, seed: int = 42, partitions: int = TRAIN_PARTITIONS,
):
    """Boosted trees stopped by patience, and their rounds: (round, loss, kept)."""
    model, losses = _fit_patient(vectors, params or {}, label, seed, validation, patience, partitions)
    rows = [(i + 1, float(x), i < model.getNumTrees) for i, x in enumerate(losses)]
    return model, vectors.sparkSession.createDataFrame(rows, "round int, loss double, kept boolean")


def draw_params(draws: int = 20, seed: int = 42, space: Mapping | None = None) -> list[dict]:
    """Seeded random draws from the search ranges."""
    rng = np.random.RandomState(seed)
    pick = {
        "hundreds": lambda lo, hi: int(rng.randint(lo, hi) // 100 * 100),
        "whole": lambda lo, hi: int(rng.randint(lo, hi)),
        "real": lambda lo, hi: float(rng.uniform(lo, hi)),
    }
    space = SEARCH_SPACE if space is None else space
    return [{k: pick[kind](lo, hi) for k, (kind, lo, hi) in space.items()} for _ in range(draws)]


def search_boosted(
    vectors: DataFrame,
    validation: str,
    draws: Sequence[Mapping] | None = None,
    label: str = S.LABEL,
    seed: int = 42,
    tolerance: float = 0.01,
    parallelism: int = 2,
    partitions: int = TRAIN_PARTITIONS,
) -> Search:
    """Fit each draw with early stopping, keep the least validation RMSE, refit it.

    Trials carry every drawn parameter, the trees kept and the score.
    """
    spark = vectors.sparkSession
    shared_folder(spark)
    draws = draw_params(seed=seed) if draws is None else [dict(d) for d in draws]
    stop = {"validationIndicatorCol": validation, "validationTol": tolerance}
    with held_for_training(vectors.select(label, "features", validation), partitions) as held:
        marked = held.filter(F.col(validation))

        def attempt(draw):
            model = boosted(draw, label, seed, **stop).fit(held)
            score = model.transform(marked).agg(rmse(label, "prediction")).first()[0]
            return float(score), model.getNumTrees

        with ThreadPool(max(1, parallelism)) as pool:
            outcomes = pool.map(attempt, draws)
        at = int(np.argmin([s for s, _ in outcomes]))
        best = boosted(draws[at], label, seed, **stop).fit(held)
    rows = [
        {**d, "trial": i, "trees": t, "rmse": s}
        for i, (d, (s, t)) in enumerate(zip(draws, outcomes))
    ]
    return Search(PipelineModel([best]), dict(draws[at]), spark.createDataFrame(rows))


# ---------------------------------------------------------- scoring, curves ---
def score(
    model, table: DataFrame, keep: Sequence[str] = (S.LABEL,), prediction: str = "prediction"
) -> DataFrame:
    """The kept columns and the prediction."""
    scored = model.transform(table)
    return scored.select(*keep, F.col("prediction").alias(prediction))


def save_model(model, path: str) -> str:
    """Overwrite a saved model folder."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def learning_curve(
    vectors: DataFrame,
    keys: Sequence[str],
    estimator,
    label: str = S.LABEL,
    steps: int = 6,
    folds: int = 3,
    seed: int = 42,
    validation: str | None = None,
    parallelism: int = 3,
    partitions: int = TRAIN_PARTITIONS,
) -> DataFrame:
    """Mean training and validation RMSE by number of rows: (size, train_rmse, val_rmse).

    Subsets are nested and folds follow the row key, so the curve does not depend on
    partitioning. A ``validation`` column name marks 15 percent of each training
    part for an estimator that stops early. Each fit is a distributed one.
    """
    spark = vectors.sparkSession
    rows = []
    table = assign_folds(vectors, keys, folds, "__fold", salt=f"fold{seed}")
    if validation:
        table = validation_flag(table, keys, 15, validation, salt=f"validation{seed}")
    error = F.pow(F.col(label) - F.col("prediction"), F.lit(2))
    with held_for_training(table, partitions) as held:
        sizes = subset_sizes(held.count(), steps)

        def fold_scores(subset: DataFrame, k: int) -> tuple[float, float]:
            inside = F.col("__fold") != k
            model = estimator.fit(subset.filter(inside))

            def part(where: Column) -> Column:
                return F.sqrt(F.avg(F.when(where, error)))

            return tuple(model.transform(subset).agg(part(inside), part(~inside)).first())

        samples = list(zip(sizes, nested_samples(held, sizes, keys, seed)))
        with ThreadPool(max(1, parallelism)) as pool:
            found = pool.starmap(fold_scores, [(s, k) for _, s in samples for k in range(folds)])
        for i, n in enumerate(sizes):
            scores = found[i * folds : (i + 1) * folds]
            means = [float(np.mean([s[j] for s in scores])) for j in (0, 1)]
            rows.append((n, *means))
    return spark.createDataFrame(rows, "size bigint, train_rmse double, val_rmse double")
