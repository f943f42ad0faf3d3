"""The cleansing job over files that keep arriving.

Decoding, filters and scaling are row-wise, so the batch plan runs unchanged on a
stream: no state, no watermark, and append output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyledger import schema as S
from skyledger.plans.cleanse import cleanse


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Raw all-text Parquet files, as the raw ingest writes them, as a stream."""
    return spark.readStream.schema(S.RAW_SCHEMA).parquet(folder)


def cleanse_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, **options
) -> StreamingQuery:
    """Cleanse what has arrived since the last run and append it to a Parquet folder.

    The checkpoint, on shared storage, makes each file count exactly once.
    """
    return (
        cleanse(read_stream(spark, source), stored=True, **options)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
