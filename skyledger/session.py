"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app: str = "skyledger", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings this library counts on.

    Shuffle partition counts are left to adaptive execution: it coalesces small
    shuffles and splits skewed ones, so no number is fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only where the session names none (a local test) is one made and set.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    if context.getCheckpointDir() is None:
        # Boosting cuts its lineage there every few rounds.
        context.setCheckpointDir(base)
    return base.rstrip("/")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    path = f"{shared_folder(spark)}/skyledger/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def written_paths() -> list[str]:
    """Scratch paths handed out and not cleared yet."""
    return list(_scratch)


def clear_scratch(spark: SparkSession) -> int:
    """Remove what this program has written to its scratch paths; their number.

    For the end of a job: tables that are read from such a path are gone with it.
    """
    conf = spark._jsc.hadoopConfiguration()
    gone = 0
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a scratch path and read back: short lineage that outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more."""
    spark = table.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _scratch.remove(table.stored_at)


# Serialized in memory, spilling to disk: the cheapest form for wide cached tables.
SERIALIZED = StorageLevel(True, True, False, False, 1)


@contextlib.contextmanager
def persisted(*tables: DataFrame, level: StorageLevel = SERIALIZED):
    """Persist the tables for the length of a ``with`` block.

    A lost executor costs a recompute of its blocks, nothing else.
    """
    held = [t.persist(level) for t in tables]
    try:
        yield held[0] if len(held) == 1 else held
    finally:
        for t in held:
            t.unpersist()


TRAIN_PARTITIONS = 16


@contextlib.contextmanager
def held_for_training(df: DataFrame, partitions: int = TRAIN_PARTITIONS):
    """Persist a table that an iterative fit will read many times.

    Fits draw their random numbers per partition and row, so the layout is part of the
    model: rows go to a fixed number of partitions by a hash of their content and are put
    in its order there. The same rows then give the same model on any cluster,
    from any files, and after a lost executor. Give a large table more partitions; their
    number, and nothing else, belongs with the seed.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed = df.withColumn("__row", row).repartition(partitions, "__row")
    with persisted(placed.sortWithinPartitions("__row").drop("__row")) as held:
        yield held
