"""Parquet, CSV and JSON tables: reading, writing, layout."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from skyledger.session import discard, stored

PARTITION_KEYS = ("year", "month")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a missing partition key


def read_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """A Parquet file or folder; partition folders become columns.

    Filters on partition columns skip whole folders.
    """
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def _writer(df: DataFrame, num_files: int | None, max_records: int | None) -> DataFrameWriter:
    if num_files:
        # Gathering the table into few files also leaves few tasks to write it.
        df = df.coalesce(num_files)
    writer = df.write.mode("overwrite")
    return writer.option("maxRecordsPerFile", max_records) if max_records else writer


def write_table(
    df: DataFrame, path: str, num_files: int | None = None, max_records: int | None = None
) -> str:
    """Overwrite a snappy Parquet folder; ``num_files`` is for small tables."""
    writer = _writer(df, num_files, max_records)
    writer.option("compression", "snappy").parquet(path)
    return path


def clustered(df: DataFrame, keys: Sequence[str] = PARTITION_KEYS) -> DataFrame:
    """Rows of a key brought together, in tasks of a healthy size.

    Adaptive execution cuts a key that holds much of the table into several tasks
    and joins small ones, so a dozen months do not mean a dozen tasks.
    """
    return df.hint("rebalance", *keys)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = PARTITION_KEYS,
    max_records: int | None = None,
    only_touched: bool = False,
) -> str:
    """Overwrite a folder partitioned by the keys, with few files per folder.

    ``only_touched`` replaces just the partitions the table has rows for.
    """
    writer = _writer(clustered(df, keys), None, max_records)
    mode = "dynamic" if only_touched else "static"
    (
        writer.option("partitionOverwriteMode", mode)
        .option("compression", "snappy")
        .partitionBy(*keys)
        .parquet(path)
    )
    return path


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    keys: Sequence[str] = PARTITION_KEYS,
    max_records: int | None = None,
) -> str:
    """Rewrite a partitioned folder of many small files as fewer, larger ones."""
    return write_partitioned(read_table(spark, source), target, keys, max_records)


def partition_files(
    spark: SparkSession, path: str, keys: Sequence[str] = PARTITION_KEYS, small_bytes: int = 32 << 20
) -> DataFrame:
    """(keys, files, small) of every partition folder, from the file listing alone.

    Keys are the texts in the folder names; a missing value is NULL. ``small`` counts files
    below the given size.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", True
    ).load(path)
    named = []
    for k in keys:
        text = F.url_decode(F.regexp_extract("path", f"/{re.escape(k)}=([^/]*)/", 1))
        named.append(F.when(text != NO_VALUE, text).alias(k))
    return files.select(*named, "path", "length").groupBy(*keys).agg(
        F.collect_list("path").alias("files"),
        F.count_if(F.col("length") < small_bytes).alias("small"),
    )


def compact_touched(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = PARTITION_KEYS,
    most_small: int = 8,
    small_bytes: int = 32 << 20,
    max_records: int | None = None,
) -> int:
    """Rewrite the partitions with more than ``most_small`` files below ``small_bytes``; their number.

    Partitions are chosen from the file listing; files of the others are neither read nor moved. The
    chosen rows are written beside the table first and then replace their partitions by dynamic
    overwrite, so whenever a job fails, the old files or the staged copy are whole.
    """
    listed = partition_files(spark, path, keys, small_bytes)
    folder = F.regexp_extract(F.get("files", F.lit(0)), "^(.*)/[^/]*$", 1).alias("folder")
    # Folder names of the loose partitions come to the driver, as they do in Spark's own listing.
    wanted = [r["folder"] for r in listed.filter(F.col("small") > most_small).select(folder).collect()]
    if not wanted:
        return 0
    loose = spark.read.option("basePath", path).schema(spark.read.parquet(path).schema).parquet(
        *[re.sub(r"([\\*?\[\]{}])", r"\\\1", w) for w in wanted]
    )
    staged = stored(loose, "loose-partitions")
    write_partitioned(staged, path, keys, max_records, only_touched=True)
    discard(staged)
    return len(wanted)


def write_counted(df: DataFrame, write) -> int:
    """Run ``write`` on the table and tell its rows, counted on the way through."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, num_files: int | None = None) -> str:
    """Overwrite a folder of CSV files with header lines."""
    _writer(df, num_files, None).option("header", True).option("escape", '"').csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, num_files: int | None = None) -> str:
    _writer(df, num_files, None).json(path)
    return path


def write_results(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> dict[str, str]:
    """Write small result tables, one folder with one file each."""
    write = {"csv": write_csv, "json": write_json, "parquet": write_table}[fmt]
    return {name: write(df, f"{folder}/{name}", 1) for name, df in tables.items()}


def spread(df: DataFrame, partitions: int, keys: Sequence[str] = ()) -> DataFrame:
    """Repartition by count or by keys, where adaptive sizing is not wanted."""
    return df.repartition(partitions, *keys)
