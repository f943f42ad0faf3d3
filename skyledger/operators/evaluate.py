"""Scores, diagnostics and report tables of fitted models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyledger import schema as S
from skyledger.functions.numeric import residual, rmse, unit_bin
from skyledger.operators.profile import top_k
from skyledger.operators.ranks import exact_quantiles


def regression_metrics(
    df: DataFrame, label: str = S.LABEL, prediction: str = "prediction"
) -> DataFrame:
    """One row (rmse, mae, r2) from one pass."""
    error = residual(label, prediction)
    both = F.when(error.isNotNull(), F.col(label))
    squares = F.sum(F.pow(error, F.lit(2)))
    return df.agg(
        rmse(label, prediction).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - squares / F.nullif(F.var_pop(both) * F.count(both), F.lit(0.0))).alias("r2"),
    )


def metrics_row(metrics: DataFrame, model: str, digits: int = 4, **extra) -> DataFrame:
    """A labelled report row: timestamp, model, extras, rounded scores."""
    return metrics.select(
        F.current_timestamp().alias("timestamp"),
        F.lit(model).alias("model"),
        *[F.lit(v).alias(k) for k, v in extra.items()],
        *[F.round(c, digits).alias(c) for c in ("rmse", "mae", "r2")],
    )


def residual_rows(
    df: DataFrame,
    label: str = S.LABEL,
    prediction: str = "prediction",
    fraction: float | None = None,
    seed: int = 42,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Label, prediction and residual of all rows, or of a seeded share of them."""
    rows = df if fraction is None else df.sample(False, fraction, seed)
    return rows.select(*keep, label, prediction, residual(label, prediction).alias("residual"))


def error_by(
    df: DataFrame,
    part: str,
    label: str = S.LABEL,
    prediction: str = "prediction",
    timestamp: str = "DATE",
) -> DataFrame:
    """RMSE and mean residual per ``hour`` or ``month`` of the timestamp."""
    pieces: dict[str, Column] = {"hour": F.hour(timestamp), "month": F.month(timestamp)}
    return (
        df.groupBy(pieces[part].alias(part))
        .agg(
            rmse(label, prediction).alias("rmse"),
            F.avg(residual(label, prediction)).alias("bias"),
        )
        .orderBy(part)
    )


def calibration(
    df: DataFrame, label: str = S.LABEL, prediction: str = "prediction", width: float = 1.0
) -> DataFrame:
    """Mean label and prediction per bin of the prediction: (bin, avg_true, avg_pred, n)."""
    return (
        df.groupBy(unit_bin(prediction, width).alias("bin"))
        .agg(
            F.avg(label).alias("avg_true"),
            F.avg(prediction).alias("avg_pred"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy("bin")
    )


def normal_quantiles(points: int) -> list[tuple[float, float]]:
    """Evenly spaced probabilities with their standard normal quantiles."""
    normal = NormalDist()
    return [(i / (points + 1), normal.inv_cdf(i / (points + 1))) for i in range(1, points + 1)]


def residual_qq(df: DataFrame, column: str = "residual", points: int = 99) -> DataFrame:
    """Exact residual quantiles against normal ones: (p, theoretical, sample).

    A grid of quantiles stands for the plot of all ordered residuals, which would be
    as long as the table and need a global sort.
    """
    grid = normal_quantiles(points)
    found = exact_quantiles(df, {column: [p for p, _ in grid]}, interpolate=True)[column]
    return df.sparkSession.createDataFrame(
        [(p, z, x) for (p, z), x in zip(grid, found)],
        "p double, theoretical double, sample double",
    )


def qq_line(qq: DataFrame) -> DataFrame:
    """Least-squares line through the points: (slope, intercept, r)."""
    return qq.agg(
        F.regr_slope("sample", "theoretical").alias("slope"),
        F.regr_intercept("sample", "theoretical").alias("intercept"),
        F.corr("sample", "theoretical").alias("r"),
    )


def coefficients(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """(feature, coefficient) of a linear model or of a pipeline that ends in one."""
    linear = model.stages[-1] if hasattr(model, "stages") else model
    rows = [(f, float(c)) for f, c in zip(features, linear.coefficients)]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def coefficient_diagnostics(table: DataFrame) -> DataFrame:
    """(nonzero, l1_norm, l2_norm) of a coefficient table."""
    c = F.col("coefficient")
    return table.agg(
        F.count_if(c != 0).alias("nonzero"),
        F.sum(F.abs(c)).alias("l1_norm"),
        F.sqrt(F.sum(c * c)).alias("l2_norm"),
    )


def nested_result(metrics: DataFrame, coefficients: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """One row: the metrics, a map of coefficients by feature, and their diagnostics.

    All three are a few rows made from one model, so they are put together as such.
    """
    spark = metrics.sparkSession
    pairs = {r["feature"]: r["coefficient"] for r in coefficients.collect()}
    kept = metrics.drop("timestamp")
    schema = T.StructType([
        T.StructField("metrics", kept.schema),
        T.StructField("coefficients", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("coef_diag", diagnostics.schema),
    ])
    return spark.createDataFrame([(kept.first(), pairs, diagnostics.first())], schema)


def feature_importance(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree model, most important first."""
    trees = model.stages[-1] if hasattr(model, "stages") else model
    values = trees.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def top_importance(table: DataFrame, k: int = 20) -> DataFrame:
    """The k most important features, ranked."""
    return top_k(table, "importance", k, "feature")


# fixed values: columns of the model comparison
COMPARISON_COLUMNS = [
    "model", "elasticNetParam", "best_regParam", "rmse", "mae", "r2", "intercept",
]


def model_comparison(
    rows: Sequence[DataFrame], columns: Sequence[str] = tuple(COMPARISON_COLUMNS)
) -> DataFrame:
    """Report rows of several models under each other; absent values are NULL."""
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    have = set(table.columns)
    return table.select(
        *[c if c in have else F.lit(None).cast("double").alias(c) for c in columns]
    )


def params_row(spark: SparkSession, params: dict) -> DataFrame:
    """One row of parameters."""
    return spark.createDataFrame([params])
