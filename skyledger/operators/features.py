"""Feature preparation: imputation, encoding, assembly and standardisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer,
    StringIndexerModel, VectorAssembler,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from skyledger.operators.columns import column_kinds
from skyledger.operators.ranks import exact_quantiles
from skyledger.session import stored

IMPUTED = "_imp"
FILLED = "_fill"
NUMBER = "_num"
SHORT_DICTIONARY = 10_000  # values; up to here Spark chooses how it is joined
COMMON_ROWS = 100_000  # rows of one value that one task may well take


def median_imputer(columns: Sequence[str], relative_error: float = 0.001) -> Imputer:
    """Estimator that writes ``<column>_imp`` with missing values set to the median.

    The median is approximate within the rank error. An error of zero would make
    Spark hold every value; ``fit_exact_median`` gives the exact one at scale.
    """
    return Imputer(
        strategy="median",
        inputCols=list(columns),
        outputCols=[c + IMPUTED for c in columns],
        relativeError=relative_error,
    )


def fit_exact_median(df: DataFrame, columns: Sequence[str], relative_error: float = 0.001):
    """Fitted imputer with the exact (lower) median of each column.

    The medians come from a rank search; the imputer is then fitted on the one row that
    holds them, of which they are the medians as well.
    """
    medians = exact_quantiles(df, {c: [0.5] for c in columns})
    empty = [c for c in columns if medians[c][0] is None]
    if empty:
        raise ValueError(f"no value to impute from in {empty}")
    schema = ", ".join(f"`{c}` double" for c in columns)
    row = df.sparkSession.createDataFrame([tuple(float(medians[c][0]) for c in columns)], schema)
    return median_imputer(columns, relative_error).fit(row)


def impute_exact_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_imp`` with NULL and NaN set to the exact (lower) median."""
    medians = exact_quantiles(df, {c: [0.5] for c in columns})
    return df.withColumns(
        {
            c + IMPUTED: F.coalesce(
                F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(medians[c][0])
            )
            for c in columns
        }
    )


class Category(NamedTuple):
    """The most frequent value of a column and its number of distinct values."""

    mode: str | None
    distinct: int


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, Category]:
    """Profile categorical columns in one job; ties go to the least value.

    Values are counted first, so a hot value is one row per task in the shuffle and
    no task holds more than its share of distinct values.
    """
    if not columns:
        return {}
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = (
        text.unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .count()
    )
    best = counted.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("mode"),
        F.count(F.lit(1)).alias("distinct"),
    )
    found = {r["column"]: Category(r["mode"], r["distinct"]) for r in best.collect()}
    return {c: found.get(c, Category(None, 0)) for c in columns}


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing categorical values with the most frequent one, in place."""
    fill = {c: v.mode for c, v in categories(df, columns).items() if v.mode is not None}
    return df.fillna(fill) if fill else df


def fill_stage(modes: Mapping[str, str | None]) -> SQLTransformer:
    """Stage that writes ``<column>_fill`` with missing values set to the given ones."""
    filled = []
    for c, v in modes.items():
        literal = (v or "").replace("\\", "\\\\").replace("'", "\\'")
        filled.append(f"coalesce(cast(`{c}` AS string), '{literal}') AS `{c}{FILLED}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")


def one_hot_stages(columns: Sequence[str]) -> list:
    """Index and encode categories; an unknown or missing one gives all zeros.

    Categories are ordered by name, as encoded names list them. The vectors are in
    ``<column>_vec``.
    """
    indexed = [c + "_idx" for c in columns]
    return [
        StringIndexer(
            inputCols=list(columns), outputCols=indexed,
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=indexed, outputCols=[c + "_vec" for c in columns], dropLast=True
        ),
    ]


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, number) of the distinct values of a column, numbered in order, none on the driver.

    Values are range-partitioned and numbered within a partition; one row per partition says how many values lie
    before it. A missing value has no number.
    """
    values = df.select(F.col(f"`{column}`").cast("string").alias("value")).filter(
        F.col("value").isNotNull()
    ).distinct()
    ranges = stored(
        values.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "value-ranges"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
    return stored(
        ranges.withColumn("place", place).join(F.broadcast(starts), "part").select(
            "value", (F.col("start") + F.col("place")).cast("int").alias("number")
        ),
        "dictionary",
    )


def one_hot_by_dictionary(df: DataFrame, column: str, names: DataFrame, salts: int = 16) -> DataFrame:
    """Add ``<column>_vec``, a sparse vector with a one at the value's number; all zeros without one.

    The dictionary is joined to the rows. Values with more than ``COMMON_ROWS`` rows, a short list, are salted, so
    that each meets ``salts`` tasks; Spark may send a short dictionary to all tasks instead. Only the number of values
    comes to the driver: the column knows its length, but not a name for every slot, as OneHotEncoder would give it.
    """
    n = names.count()
    text = F.col(f"`{column}`").cast("string")
    counted = df.select(text.alias("__common")).filter(F.col("__common").isNotNull()).groupBy("__common").count()
    common = F.broadcast(
        stored(counted.filter(F.col("count") > COMMON_ROWS).select("__common"), "common-values")
    )
    many = F.col("__common").isNotNull()
    last = F.when(many, salts - 1).otherwise(0)
    salted = names.join(common, F.col("value") == F.col("__common"), "left").select(
        F.col("value").alias("__value"), F.col("number").alias("__number"),
        F.explode(F.sequence(F.lit(0), last)).alias("__salted"),
    )
    if n > SHORT_DICTIONARY:  # its stored size tells nothing of its size in memory
        salted = salted.hint("merge")
    salt = F.when(many, F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0).cast("int")
    rows = df.join(common, text == F.col("__common"), "left").withColumn("__salt", salt)
    joined = rows.join(salted, (text == F.col("__value")) & (F.col("__salt") == F.col("__salted")), "left")
    vector = _unit_vector(F.col("__number"), n).alias(f"{column}_vec", metadata={"ml_attr": {"num_attrs": n}})
    return joined.select(*df.columns, vector)


def _unit_vector(place: Column, size: int) -> Column:
    """A sparse vector with a one at the place; all zeros where it is NULL."""
    cell = F.when(place.isNotNull(), F.array(place))
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.coalesce(cell, F.array().cast("array<int>")).alias("indices"),
        F.when(place.isNotNull(), F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )
    schema = StructType([StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), schema)["v"]


def slot_sums(vectors: DataFrame, column: str) -> DataFrame:
    """(slot, total) over the stored cells of a column of sparse vectors, a row per slot that has any.

    Summed by slot: no task holds a vector's whole length.
    """
    cells = F.unwrap_udt(F.col(f"`{column}`"))
    pairs = F.arrays_zip(cells["indices"].alias("slot"), cells["values"].alias("x"))
    return vectors.select(F.inline(pairs)).groupBy("slot").agg(F.sum("x").alias("total"))


def encoded_names(fitted: PipelineModel, numeric: Sequence[str]) -> list[str]:
    """Names of the assembled slots: numeric ones, then ``column=value``."""
    names = list(numeric)
    for stage in fitted.stages:
        if isinstance(stage, StringIndexerModel):
            for c, labels in zip(stage.getInputCols(), stage.labelsArray):
                names += [f"{c.removesuffix(FILLED)}={v}" for v in labels]
    return names


def assembler(columns: Sequence[str], handle_invalid: str = "error", out: str = "features"):
    """Assemble a dense feature vector; ``skip`` drops rows with missing features."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=out, handleInvalid=handle_invalid
    )


def standardizer(column: str = "features", out: str = "scaledFeatures") -> StandardScaler:
    """Zero mean and unit sample standard deviation."""
    return StandardScaler(inputCol=column, outputCol=out, withMean=True, withStd=True)


def number_stage(columns: Sequence[str]) -> SQLTransformer:
    """Stage that writes ``<column>_num``: text read as a whole number, NULL if it is none."""
    read = [f"cast(try_cast(`{c}` AS bigint) AS double) AS `{c}{NUMBER}`" for c in columns]
    return SQLTransformer(statement=f"SELECT *, {', '.join(read)} FROM __THIS__")


def preparation(
    df: DataFrame,
    exclude: Sequence[str],
    numbers: Sequence[str] = (),
    relative_error: float = 0.001,
) -> tuple[Pipeline, list[str]]:
    """Median-imputed numbers and one-hot categories as one ``features`` vector.

    Column kinds are read off the schema; text columns named in ``numbers`` (an id such
    as STATION) are read as numbers, so a model does not grow with their values. Gives the
    pipeline, whose medians and category fill are already taken from ``df``, and the names
    of the numeric columns. The values of every other text column become part of the model
    and pass through the driver: exclude free text.
    """
    numeric, categorical = column_kinds(df, exclude)
    numbers = [c for c in numbers if c in categorical]
    categorical = [c for c in categorical if c not in numbers]
    stages, inputs = [], [*numeric, *(c + NUMBER for c in numbers)]
    if numbers:
        stages.append(number_stage(numbers))
        df = stages[0].transform(df)
    if inputs:
        stages.append(fit_exact_median(df, inputs, relative_error))
    if categorical:
        profile = categories(df, categorical)
        stages.append(fill_stage({c: p.mode for c, p in profile.items()}))
        stages += one_hot_stages([c + FILLED for c in categorical])
    stages.append(
        assembler([c + IMPUTED for c in inputs] + [c + FILLED + "_vec" for c in categorical])
    )
    return Pipeline(stages=stages), [*numeric, *numbers]
