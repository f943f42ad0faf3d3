"""Exploratory tables of a cleansed table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyledger import schema as S
from skyledger.operators import profile as P
from skyledger.operators.columns import present
from skyledger.sources.tables import write_csv, write_results


def explore(df: DataFrame, bins: int = 30) -> dict[str, DataFrame]:
    """Result tables by name; each reads only the columns it needs.

    All are small but ``map_points``, which is as long as there are distinct places.
    """
    correlated = present(df, S.CORRELATION_COLUMNS)
    nulls = P.null_counts(df)
    return {
        "describe_numeric": P.describe_numeric(df, S.PROFILE_COLUMNS),
        "null_counts": nulls,
        "top_null_counts": P.top_k(nulls, "null_count", 20, "column"),
        "avg_tmp_by_hour": P.average_by(df, "hour"),
        "avg_tmp_by_month": P.average_by(df, "month"),
        "correlation": P.correlation_matrix(df, correlated),
        "histogram": P.histogram(df, correlated, bins),
        "map_points": P.map_points(df),
    }


def write_explored(df: DataFrame, folder: str, bins: int = 30) -> dict[str, str]:
    """Write the tables as CSV, the small ones as one file each; their paths."""
    tables = explore(df, bins)
    places = tables.pop("map_points")
    return write_results(tables, folder) | {"map_points": write_csv(places, f"{folder}/map_points")}
