"""Input checks that fail early, before a job starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    """The table itself, or an error that lists what it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def require_inputs(fitted, columns: Sequence[str]) -> None:
    """Check that a fitted stage was made for exactly these input columns."""
    inputs = list(fitted.getInputCols())
    if inputs != list(columns):
        raise ValueError(f"model was fitted on {inputs}, not on {list(columns)}")


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files below a path or glob: (path, length). Contents are not read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        return reader.load(path).select("path", "length")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"nothing matches {path}") from e
        raise


def require_files(spark: SparkSession, path: str, pattern: str | None = None) -> str:
    """The path itself, or an error if no file matches."""
    if list_files(spark, path, pattern).isEmpty():
        raise FileNotFoundError(f"nothing matches {path}")
    return path
