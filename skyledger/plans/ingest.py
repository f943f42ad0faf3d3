"""Raw files to Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.functions.numeric import key_bucket
from skyledger.plans.cleanse import cleanse
from skyledger.plans.typed import TYPED_SOURCE_COLUMNS, typed_humidity
from skyledger.sources.csv import read_raw
from skyledger.sources.tables import (
    read_table, write_counted, write_partitioned, write_table,
)


def ingest_raw(spark: SparkSession, source: str, target: str, pattern: str | None = None) -> int:
    """CSV files to one all-text Parquet folder; the rows written."""
    raw = read_raw(spark, source, pattern=pattern)
    return write_counted(raw, lambda df: write_table(df, target))


def ingest_clean(
    spark: SparkSession, source: str, target: str, pattern: str | None = None, **options
) -> int:
    """CSV files straight to the cleansed table, in one job; the rows written."""
    clean = cleanse(read_raw(spark, source, pattern=pattern), **options)
    return write_counted(clean, lambda df: write_table(df, target))


def write_split(
    df: DataFrame, target: str, keys: Sequence[str] = ("STATION", "DATE"), train_percent: int = 70
) -> tuple[DataFrame, DataFrame]:
    """Store a table with its train and test parts side by side, in one job.

    The parts are partitions of one folder: the whole table is written once, and each
    part is read back alone. Gives the stored train and test tables.
    """
    bucket = key_bucket(*keys)
    part = F.when(bucket < train_percent, "train").otherwise("test")
    df.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(target)
    stored = read_table(df.sparkSession, target)
    train, test = (stored.filter(F.col("part") == p).drop("part") for p in ("train", "test"))
    return train, test


def ingest_typed(
    spark: SparkSession,
    source: str,
    target: str,
    pattern: str | None = None,
    missing_tokens: str = "codes",
) -> int:
    """CSV files to the typed variant, partitioned by year and month; the rows written."""
    raw = read_raw(spark, source, TYPED_SOURCE_COLUMNS, pattern)
    typed = typed_humidity(raw, missing_tokens)
    return write_counted(typed, lambda df: write_partitioned(df, target))
