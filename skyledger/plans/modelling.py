"""Fit, score and report, one function per model family."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from skyledger import schema as S
from skyledger.functions.numeric import key_hash
from skyledger.operators import boosting as B, evaluate as E, models as M
from skyledger.operators.profile import axis_limits, histogram
from skyledger.operators.sampling import validation_flag
from skyledger.session import persisted, stored
from skyledger.sources.checks import require_columns, require_inputs
from skyledger.sources.tables import write_json, write_results, write_table


# --- fixed values: model names in reports ------------------------------------
BASELINE = "Baseline Linear Regression"
FAMILY = {0.0: "Ridge", 1.0: "Lasso"}  # any other mixing weight is "Enet"


@dataclass
class Report:
    """A fitted model, its scored test rows (lazy) and its small result tables."""

    model: PipelineModel
    predictions: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def write(self, folder: str) -> None:
        """Predictions as Parquet, result tables as CSV and the model, below a folder."""
        parts = ("metrics", "coefficients", "coefficient_diagnostics")
        M.save_model(self.model, f"{folder}/model")
        with persisted(self.predictions):  # scored once, also for the tables made from them
            write_table(self.predictions, f"{folder}/predictions")
            write_results(self.tables, folder)
            if set(parts) <= set(self.tables):
                nested = E.nested_result(*(self.tables[t] for t in parts))
                write_json(nested, f"{folder}/result", 1)


def _intercept(model: PipelineModel) -> float:
    return float(model.stages[-1].intercept)


def _linear_report(model, test, features, label, name, extra) -> Report:
    spark = test.sparkSession
    predictions = M.score(model, test, [c for c in ("DATE",) if c in test.columns] + [label])
    coefficients = E.coefficients(spark, model, features)
    metrics = E.metrics_row(E.regression_metrics(predictions, label), name, **extra)
    return Report(
        model,
        predictions,
        {
            "metrics": metrics,
            "coefficients": coefficients,
            "coefficient_diagnostics": E.coefficient_diagnostics(coefficients),
        },
    )


def linear_baseline(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str] = tuple(S.LINEAR_FEATURES),
    label: str = S.LABEL,
    handle_invalid: str = "error",
) -> Report:
    """Ordinary least squares on the training rows, scored on the test rows."""
    require_columns(test, [label, *features], "test table")
    model = M.fit_ols(train, features, label, handle_invalid)
    extra = {"intercept": _intercept(model)}
    return _linear_report(model, test, features, label, BASELINE, extra)


def regularized_family(
    train: DataFrame,
    test: DataFrame,
    alphas: Sequence[float] = tuple(M.ALPHAS),
    grids: Mapping[float, Sequence[float]] | None = None,
    features: Sequence[str] = tuple(S.LINEAR_FEATURES),
    label: str = S.LABEL,
    handle_invalid: str = "error",
    folder: str | None = None,
    keys: Sequence[str] | None = None,
) -> tuple[dict[float, Report], DataFrame]:
    """Ridge, elastic net and lasso: a report per mixing weight, and the comparison.

    Validation rows are picked by a hash of the keys (of label and features if none are given).
    With a folder, reports are written below it as ``ridge_a0``, ``enet_a0p25`` and so on.
    """
    reports = {}
    searches = M.search_penalties(
        train, {a: (grids or {}).get(a) for a in alphas}, features, label, keys=keys,
        handle_invalid=handle_invalid,
    )
    for alpha, found in searches.items():
        extra = {**found.best, "intercept": _intercept(found.model)}
        name = f"{FAMILY.get(alpha, 'Enet')} (alpha={alpha})"
        report = _linear_report(found.model, test, features, label, name, extra)
        report.tables["trials"] = found.trials
        reports[alpha] = report
    summary = E.model_comparison([r.tables["metrics"] for r in reports.values()])
    if folder:
        for alpha, report in reports.items():
            label = f"a{alpha:g}".replace(".", "p")
            report.write(f"{folder}/{FAMILY.get(alpha, 'Enet').lower()}_{label}")
        write_results({"regularized_summary": summary}, folder)
    return reports, summary


def rescore(
    path: str, table: DataFrame, features: Sequence[str] = tuple(S.FOREST_FEATURES),
    keep: Sequence[str] = (S.LABEL,), prediction: str = "prediction",
) -> DataFrame:
    """Score a table with a saved model, after checking that both fit the features."""
    model = M.load_model(path)
    require_inputs(model.stages[0], features)
    require_columns(table, features, "table to score")
    return M.score(model, table, keep, prediction)


def _diagnostics(predictions: DataFrame, label: str) -> dict[str, DataFrame]:
    residuals = E.residual_rows(predictions, label)
    return {
        "metrics": E.regression_metrics(predictions, label),
        "rmse_by_hour": E.error_by(predictions, "hour", label),
        "rmse_by_month": E.error_by(predictions, "month", label),
        "calibration": E.calibration(predictions, label),
        "residual_histogram": histogram(residuals, ["residual"], 50),
        "residual_qq": E.residual_qq(residuals),
        "axis_limits": axis_limits(predictions, [label, "prediction"]),
    }


@contextmanager
def diagnosed(model, test: DataFrame, label: str = S.LABEL):
    """Score once, hold the predictions, and give them with their diagnostic tables.

    The tables read the held predictions as long as the ``with`` block lasts.
    """
    with persisted(M.score(model, test, ["DATE", label])) as predictions:
        yield predictions, _diagnostics(predictions, label)


def forest(
    train: DataFrame,
    test: DataFrame,
    folder: str,
    features: Sequence[str] = tuple(S.FOREST_FEATURES),
    label: str = S.LABEL,
    **params,
) -> Report:
    """Fit a random forest, score the test rows and write everything below a folder."""
    require_columns(test, ["DATE", label, *features], "test table")
    model = M.fit_forest(train, features, label, **params)
    importance = E.feature_importance(test.sparkSession, model, features)
    with diagnosed(model, test, label) as (predictions, tables):
        tables["feature_importance"] = importance
        tables["top_features"] = E.top_importance(importance, 5)
        report = Report(model, predictions, tables)
        report.write(folder)
    return report


def boosting(
    train: DataFrame,
    test: DataFrame,
    folder: str,
    keys: Sequence[str] = ("STATION", "DATE"),
    label: str = S.LABEL,
    base: Mapping | None = None,
    draws: Sequence[Mapping] | None = None,
    curve: Mapping | None = None,
    seed: int = 42,
    patience: int = B.PATIENCE,
) -> DataFrame:
    """Base and searched boosted trees, written below a folder; their comparison.

    Rows are prepared and binned once for all models. The keys tell rows apart for the validation set and
    for the learning curves of the base model and the best draw, made if ``curve`` is given (``steps`` and
    ``folds``). The draws, every fit of a curve and the base model kept as ``patient`` stop after
    ``patience`` rounds without progress; the base model itself grows all its rounds.
    """
    spark = train.sparkSession
    require_columns(test, [label, *keys], "test table")
    marked = validation_flag(train, keys, 15, "is_validation").withColumn(
        "row_key", key_hash(*keys, digits=13)
    )
    keep = ("is_validation", "row_key")
    fitted, vectors, names = M.prepare_boosting(marked, label, exclude=("DATE",), keep=keep)
    rows = B.slots(stored(vectors, "vectors"), names, [label, *keep])
    binned = B.bin_features(rows, names, label, ["row_key"], keep)
    found = B.search(
        binned, M.draw_params(seed=seed) if draws is None else draws, "is_validation", patience, seed
    )
    models = {
        "base": B.fit(binned, base, seed=seed),
        "optimised": found.model,
        "patient": B.fit(binned, base, "is_validation", patience, seed),
    }
    inputs = stored(B.slots(fitted.transform(test), names, [label]), "test-slots")
    compared = []
    for name, model in models.items():
        path = f"{folder}/{name}"
        model.save(spark, f"{path}/model")
        scored = model.transform(inputs).select(label, "prediction")
        write_table(scored, f"{path}/predictions")
        metrics = E.regression_metrics(spark.read.parquet(f"{path}/predictions"), label)
        nodes = spark.read.parquet(f"{path}/model/nodes")
        write_results({
            "metrics": metrics, "importance": B.top_importance(nodes, names, 20),
            "rounds": B.rounds_table(spark, model),
        }, path)
        compared.append(E.metrics_row(metrics, name))
    tables = {"trials": found.trials, "best_params": E.params_row(spark, found.best)}
    if curve is not None:
        for name, params in (("learning_curve", found.best), ("base_learning_curve", base)):
            tables[name] = B.learning_curve(
                binned, ["row_key"], params, seed=seed, patience=patience, **curve
            )
    write_results(tables, folder)
    return E.model_comparison(compared, ["model", "rmse", "mae", "r2"])
