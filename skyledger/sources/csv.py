"""CSV files whose header sets and column orders differ.

Spark binds the columns of one CSV read by position. So the first line of every file
is looked at first (a few kilobytes each, in tasks), files are grouped by *where the
wanted columns sit*, and each group is read with a schema made for it. Files that
differ only in columns nobody wants share a group, which keeps the number of groups
small for feeds whose files carry many optional fields.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from skyledger import schema as S
from skyledger.functions.text import empty_to_null
from skyledger.session import persisted, stored
from skyledger.sources.checks import list_files

MANY_LAYOUTS = 16  # beyond it, one scan by position instead of a read per layout


def _header_places(wanted: Sequence[str]):
    """Task function: positions of the wanted columns in each file's first line.

    Everything it needs is inside, so executors run it without this package.
    """

    def open_stream(path: str):
        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        if scheme in ("file", path):
            return fs.LocalFileSystem().open_input_stream(rest if scheme == "file" else path)
        known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        system, inner = fs.FileSystem.from_uri(f"{known}:{quote(rest)}")
        return system.open_input_stream(inner)

    def first_line(path: str) -> str:
        data = b""
        with open_stream(path) as f:
            while b"\n" not in data and (more := f.read(1 << 16)):
                data += more
        return data.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")

    def places(line: str) -> str:
        names = [c.strip().upper() for c in next(csv.reader([line]), [])]
        found = [names.index(w) if w in names else -1 for w in upper]
        return ",".join(map(str, found))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [places(first_line(p)) for p in batch["path"]]
            yield pd.DataFrame({"path": batch["path"], "places": found})

    upper = [w.upper() for w in wanted]
    return look


def header_groups(
    spark: SparkSession, path: str, wanted: Sequence[str], pattern: str | None = None
) -> DataFrame:
    """Each file with the positions of the wanted columns, -1 if absent: (path, places)."""
    files = list_files(spark, path, pattern).filter("length > 0").select("path")
    return files.mapInPandas(_header_places(list(wanted)), "path string, places string")


def _read_group(
    spark: SparkSession, paths, places: str, wanted: Sequence[str], pattern, options
) -> DataFrame:
    at = {int(p): w for p, w in zip(places.split(","), wanted) if int(p) >= 0}
    # Placeholders for the columns in between, and one more so that the parser
    # always selects by position and takes rows of any greater length.
    width = max(at, default=0) + 2
    fields = [at.get(i, f"__skip_{i}") for i in range(width)]
    reader = spark.read.schema(
        T.StructType([T.StructField(f, T.StringType()) for f in fields])
    ).options(header=True, escape='"', **options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    have = set(at.values())
    return reader.csv(paths).select(
        *[
            empty_to_null(c).alias(c) if c in have else F.lit(None).cast("string").alias(c)
            for c in wanted
        ]
    )


def read_by_place(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = tuple(S.RAW_COLUMNS),
    pattern: str | None = None,
    **options,
) -> DataFrame:
    """The same rows as ``read_raw``, by one scan whatever the number of layouts.

    Every file is read by position; the places of the wanted columns are joined to its rows by file name, and each
    column is picked at its place. Distinct places come to the driver, file names do not. The table of places is
    stored, so Spark knows its size and sends it to all tasks only if it is small. A file
    that was not there when headers were looked at raises an error.
    """
    columns = list(columns)
    found = stored(header_groups(spark, path, columns, pattern), "header-places")
    kinds = [
        [int(p) for p in r["places"].split(",")] for r in found.select("places").distinct().collect()
    ]
    if not kinds:
        raise FileNotFoundError(f"no file with a header matches {path}")
    # One more than the last place, so that the parser takes longer rows.
    width = max(max(k) for k in kinds) + 2
    reader = spark.read.schema(
        T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    ).options(header=True, escape='"', **options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.csv(path).select("*", F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")).alias("__file"))
    names = found.select(
        F.col("path").alias("__path"), F.split("places", ",").cast("array<int>").alias("__at")
    )
    placed = rows.join(names, F.regexp_replace("__file", "^file:/+", "/") == F.regexp_replace("__path", "^file:/+", "/"), "left")
    known = F.when(F.col("__at").isNull(), F.raise_error(F.concat(F.lit("new file "), "__file")))
    picked = []
    for w, c in enumerate(columns):
        at = F.get("__at", F.lit(w))
        value = F.lit(None).cast("string")
        for i in sorted({k[w] for k in kinds if k[w] >= 0}):
            value = F.when(at == i, F.col(f"c{i}")).otherwise(value)
        picked.append(empty_to_null(F.coalesce(known.cast("string"), value)).alias(c))
    return placed.select(*picked)


def read_raw(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = tuple(S.RAW_COLUMNS),
    pattern: str | None = None,
    **options,
) -> DataFrame:
    """All files below a path or glob as text columns, bound by header name.

    A column that a file lacks is NULL in its rows; empty cells are NULL. Extra
    ``options`` go to the CSV reader (``multiLine=True`` for quoted line ends).
    Only file names and column positions come to the driver, as they do for the
    file listing itself; with a single group not even the names.
    """
    columns = list(columns)
    with persisted(header_groups(spark, path, columns, pattern)) as found:
        kinds = [r["places"] for r in found.select("places").distinct().collect()]
        if len(kinds) > MANY_LAYOUTS:
            return read_by_place(spark, path, columns, pattern, **options)
        if not kinds:
            raise FileNotFoundError(f"no file with a header matches {path}")
        if len(kinds) == 1:
            return _read_group(spark, path, kinds[0], columns, pattern, options)
        groups: dict[str, list[str]] = defaultdict(list)
        for r in found.toLocalIterator():
            groups[r["places"]].append(re.sub(r"([\\*?\[\]{}])", r"\\\1", r["path"]))
    parts = [
        _read_group(spark, groups[k], k, columns, None, options) for k in sorted(groups)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def project_raw(df: DataFrame, columns: Sequence[str] = tuple(S.RAW_COLUMNS)) -> DataFrame:
    """The raw columns as text, in their fixed order; absent ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in columns]
    )
