"""Scoring of texts in Arrow batches, bounded samples, and tables that cut lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from skyledger.session import scratch_path

SLICE_BYTES = 1 << 20
SLICE_ROWS = 512


class Texts:
    """UTF-8 bytes of several texts in one buffer; nulls are empty texts."""

    def __init__(self, values: pa.Array):
        values = values.cast(pa.large_string())
        offsets = np.frombuffer(values.buffers()[1], np.int64)[
            values.offset : values.offset + len(values) + 1
        ]
        data = values.buffers()[2]
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.buf = whole[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.values = values

    def __len__(self):
        return len(self.offsets) - 1

    def owner(self, counts: np.ndarray) -> np.ndarray:
        """Text number of each of ``counts[i]`` consecutive items."""
        return np.repeat(np.arange(len(counts)), counts)

    def strings(self) -> list[str]:
        return [v or "" for v in self.values.to_pylist()]


def slices(values: pa.Array, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS):
    """(first, count) of consecutive runs of texts below both limits; a longer text runs alone."""
    sizes = np.diff(Texts(values).offsets)
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and (held + size > most_bytes or i - first >= most_rows):
            yield first, i - first
            first, held = i, 0
        held += size
    if len(sizes) > first:
        yield first, len(sizes) - first


def annotate(
    df: DataFrame, text: str, fields: T.StructType, make: Callable[[], Callable[[Texts], list]]
) -> DataFrame:
    """Add columns computed from the text column, in Arrow batches, without a shuffle.

    ``make`` runs once per task and returns a function from a slice of texts to one
    sequence per new field. Columns that already have a new field's name are replaced.
    """
    kept = df.drop(*fields.names)
    schema = T.StructType([*kept.schema.fields, *fields.fields])
    arrow = [_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(text))
            for first, count in slices(values):
                part = batch.slice(first, count)
                made = score(Texts(values.slice(first, count)))
                columns = [m if isinstance(m, pa.Array) else pa.array(m, t) for m, t in zip(made, arrow)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *columns], names=schema.names
                )

    return kept.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return {
        T.DoubleType: pa.float64(), T.LongType: pa.int64(), T.IntegerType: pa.int32(),
        T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(),
    }[type(kind)]


_KINDS = {
    "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(),
    "string": T.StringType(), "boolean": T.BooleanType(),
    "array<int>": T.ArrayType(T.IntegerType()), "array<long>": T.ArrayType(T.LongType()),
}


def fields(**kinds: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in kinds.items()])


def held_out(key: Column) -> Column:
    """The fold that no label may be learned from: crc32 of the key as text, remainder 2 of 4."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2


def sample_rows(df: DataFrame, n: int, by: str | None = None) -> DataFrame:
    """At most n rows (of each ``by`` value), those with the least hashes of all columns.

    The choice does not depend on the partitioning. Over the whole table each task keeps only
    its own n best before anything is shuffled. Per value, rows are first thinned by hash
    to about 2n of each value, by its count, so that no value fills a task; rows whose value
    is null are left out.
    """
    picked = df.withColumn("__h", F.xxhash64(*df.columns))
    if by is None:
        return picked.orderBy("__h").limit(n).drop("__h")
    counts = picked.groupBy(by).agg(F.count("*").alias("__all"))
    place = F.col("__h") / F.lit(2.0**64) + 0.5
    thin = picked.join(counts, by).filter(place * F.col("__all") <= 2 * n)
    order = Window.partitionBy(by).orderBy("__h")
    return thin.withColumn("__n", F.row_number().over(order)).filter(
        F.col("__n") <= n
    ).select(df.columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: short lineage that outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
