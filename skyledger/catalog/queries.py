"""One query per operator, over the whole derived feed or a whole given table.

Floating results are rounded to six places so that engines which add in another
order agree, and rows of predictions to four.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from skyledger import schema as S
from skyledger.functions import calendar as CAL, humidity as HUM, text as TXT
from skyledger.functions.numeric import key_hash
from skyledger.operators import (
    boosting as B, columns as C, evaluate as E, features as X, filters as L, models as M,
    moments as MOM, profile as P,
    sampling as D,
)
from skyledger.operators.ranks import exact_quantiles
from skyledger.plans.cleanse import cleanse
from skyledger.plans.feed import raw_feed
from skyledger.plans.ingest import write_split
from skyledger.plans.modelling import regularized_family, rescore
from skyledger.plans.typed import TYPED_SOURCE_COLUMNS, typed_humidity
from skyledger.session import scratch_path, stored, written_paths
from skyledger.sources import csv as SRC, tables as TAB

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = ["event_id"]
# Boosting rounds depend on each other: 400 trees of depth 6 are 2,400 jobs in a row, so the
# registered fits stay small. The library's defaults are the full ones.
SMALL_BOOST = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All floating columns rounded; negative zero becomes zero."""
    return df.select(
        *[
            (F.round(f.name, digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def clean(spark: SparkSession, d: str) -> DataFrame:
    return cleanse(raw_feed(spark, d)).drop("RH")


def parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return D.keyed_split(clean(spark, d), KEY, 70)


def typed(spark: SparkSession, d: str) -> DataFrame:
    return typed_humidity(raw_feed(spark, d))


def lineitem(spark: SparkSession, d: str) -> DataFrame:
    return TAB.read_table(spark, f"{d}/lineitem.parquet")


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ------------------------------------------------------- sources and sinks ---
_csv_feeds: dict[tuple[str, str], str] = {}


def _feed_as_csv(spark: SparkSession, d: str) -> str:
    """The feed as CSV files of two header sets; written once per application and folder."""
    made = (spark.sparkContext.applicationId, d)
    if _csv_feeds.get(made) not in written_paths():
        base = scratch_path(spark, "raw-csv")
        feed = raw_feed(spark, d).drop("event_id")
        plain = feed.filter(F.col("RH").isNull()).drop("RH")
        TAB.write_csv(plain, f"{base}/plain")
        humid = feed.filter(F.col("RH").isNotNull()).drop("ELEVATION")
        TAB.write_csv(humid.select(*reversed(humid.columns)), f"{base}/humid")
        _csv_feeds[made] = base
    return f"{_csv_feeds[made]}/*"


@query
def read_raw_csv(spark, d):
    return SRC.read_raw(spark, _feed_as_csv(spark, d), pattern="*.csv")


@query
def read_raw_layouts(spark, d):
    """The feed as CSV files of three layouts, read by position in one scan."""
    base = scratch_path(spark, "raw-layouts")
    feed = raw_feed(spark, d).withColumn("kind", F.col("event_id") % 3).drop("event_id")
    for k, drop in enumerate((["RH"], ["ELEVATION"], ["DEW", "RH"])):
        some = feed.filter(F.col("kind") == k).drop("kind", *drop)
        order = some.columns if k == 0 else sorted(some.columns, reverse=k == 1)
        if k == 2:
            some, order = some.withColumn("REMARK", F.lit("a, b")), ["REMARK", *order]
        TAB.write_csv(some.select(*order), f"{base}/kind{k}")
    return SRC.read_by_place(spark, f"{base}/*", pattern="*.csv")


@query
def raw_projection(spark, d):
    return SRC.project_raw(raw_feed(spark, d))


@query
def typed_scan(spark, d):
    raw = SRC.read_raw(
        spark, _feed_as_csv(spark, d), TYPED_SOURCE_COLUMNS, pattern="*.csv"
    )
    return raw.select(
        "STATION",
        CAL.cast_timestamp("DATE").alias("DATE"),
        *[TXT.try_number(c).alias(c) for c in [*S.GEO_COLUMNS, "RH"]],
        F.year(CAL.cast_timestamp("DATE")).alias("year"),
        F.month(CAL.cast_timestamp("DATE")).alias("month"),
    )


@query
def row_count(spark, d):
    return P.row_count(raw_feed(spark, d))


@query
def parquet_roundtrip(spark, d):
    path = TAB.write_table(clean(spark, d), scratch_path(spark, "clean"))
    return TAB.read_table(spark, path)


@query
def partitioned_roundtrip(spark, d):
    path = TAB.write_partitioned(typed(spark, d), scratch_path(spark, "typed"))
    return rounded(TAB.read_table(spark, path))


@query
def partition_pruned(spark, d):
    path = TAB.write_partitioned(typed(spark, d), scratch_path(spark, "typed"))
    return rounded(TAB.read_table(spark, path).filter("year = 2024 AND month IN (2, 7)"))


@query
def compact(spark, d):
    loose = scratch_path(spark, "loose")
    typed(spark, d).write.partitionBy("year", "month").parquet(loose)
    path = TAB.compact(spark, loose, scratch_path(spark, "compact"))
    return rounded(TAB.read_table(spark, path))


@query
def compact_incremental(spark, d):
    """Partitions of many small files rewritten, the others left as they are: rows, and whether files stayed."""
    path = scratch_path(spark, "loose")
    table = typed(spark, d)
    TAB.write_partitioned(table, path)
    scattered = table.filter("month <= 3").repartition(8)
    scattered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "year", "month"
    ).parquet(path)
    before = TAB.partition_files(spark, path, ["year", "month"])
    before = stored(before.select("year", "month", F.array_sort("files").alias("before")), "files-before")
    TAB.compact_touched(spark, path, most_small=2, small_bytes=1 << 30)
    after = TAB.partition_files(spark, path, ["year", "month"]).select(
        "year", "month", F.array_sort("files").alias("after")
    )
    kept = before.join(after, ["year", "month"]).select(
        F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
        (F.col("before") == F.col("after")).alias("kept"), (F.size("after") <= 2).alias("few"),
    )
    rows = TAB.read_table(spark, path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))
    return kept.join(rows, ["year", "month"])


@query
def spread_rows(spark, d):
    """The cleansed table dealt by a key and written as three files."""
    dealt = TAB.spread(clean(spark, d), 7, ["STATION"])
    path = TAB.write_table(dealt, scratch_path(spark, "spread"), num_files=3)
    return TAB.read_table(spark, path)


@query
def csv_roundtrip(spark, d):
    table = clean(spark, d)
    path = TAB.write_csv(table, scratch_path(spark, "csv"))
    return TAB.read_csv(spark, path, table.schema)


@query
def ingest_counts(spark, d):
    path = scratch_path(spark, "counted")
    rows = TAB.write_counted(typed(spark, d), lambda df: TAB.write_partitioned(df, path))
    kept = TAB.read_table(spark, path).agg(F.count(F.lit(1)).alias("rows_stored"))
    return kept.select(F.lit(rows).cast("bigint").alias("rows_written"), "rows_stored")


# ------------------------------------------------- columns and expressions ---
def _split(*fields: str) -> Query:
    layouts = {f: S.PACKED_LAYOUTS[f] for f in fields}

    def run(spark, d):
        return C.split_packed(raw_feed(spark, d).select("event_id", *fields), layouts)

    return run


QUERIES["split_wnd"] = _split("WND")
QUERIES["split_cig"] = _split("CIG")
QUERIES["split_vis"] = _split("VIS")
QUERIES["split_tmp_dew_slp"] = _split("TMP", "DEW", "SLP")


@query
def cast_geo(spark, d):
    raw = raw_feed(spark, d).select("event_id", "STATION", *S.GEO_COLUMNS)
    return C.cast_geo(raw, station_as_int=True)


@query
def scale_units(spark, d):
    tokens = C.split_packed(raw_feed(spark, d))
    return C.rename_units(C.scale_units(tokens.select("event_id", *S.UNIT_DIVISORS)))


@query
def calendar_parts(spark, d):
    return C.add_calendar(raw_feed(spark, d).select("event_id", "DATE"))


@query
def tenths_decode(spark, d):
    codes, compat = S.TYPED_SENTINELS["codes"], S.TYPED_SENTINELS["compat"]
    return raw_feed(spark, d).select(
        "event_id",
        *[TXT.decode_tenths(c, codes[c]).alias(c) for c in ("TMP", "DEW", "SLP")],
        *[TXT.decode_tenths(c, compat[c]).alias(f"{c}_compat") for c in ("TMP", "DEW", "SLP")],
    )


@query
def vis_decode(spark, d):
    return raw_feed(spark, d).select(
        "event_id",
        TXT.decode_visibility("VIS", S.TYPED_SENTINELS["codes"]["VIS"]).alias("VIS_m"),
        TXT.decode_visibility("VIS", S.TYPED_SENTINELS["compat"]["VIS"]).alias("VIS_compat"),
    )


@query
def relative_humidity(spark, d):
    codes = S.TYPED_SENTINELS["codes"]
    decoded = raw_feed(spark, d).select(
        "event_id",
        "RH",
        TXT.decode_tenths("TMP", codes["TMP"]).alias("t"),
        TXT.decode_tenths("DEW", codes["DEW"]).alias("td"),
    )
    return rounded(
        decoded.select(
            "event_id",
            HUM.magnus_humidity("t", "td").alias("magnus"),
            HUM.relative_humidity("t", "td", "RH").alias("RH_pct"),
        )
    )


# -------------------------------------------------------- filters, cleanse ---
@query
def missing_rule_counts(spark, d):
    return L.missing_rule_counts(C.split_packed(raw_feed(spark, d), once=True))


@query
def drop_missing(spark, d):
    return L.drop_missing(C.split_packed(raw_feed(spark, d), once=True)).drop("RH")


@query
def qc_filter(spark, d):
    return L.keep_accepted(C.split_packed(raw_feed(spark, d), once=True)).drop("RH")


@query
def cleanse_funnel(spark, d):
    return L.cleanse_funnel(C.split_packed(raw_feed(spark, d), once=True))


QUERIES["cleanse"] = clean


@query
def cleanse_variable_wind(spark, d):
    table = cleanse(raw_feed(spark, d), station_as_int=True, variable_wind_dir="null")
    return table.select("event_id", "STATION", "WND_DIR_DEG", "WND_TYPE")


QUERIES["typed_humidity"] = lambda spark, d: rounded(typed(spark, d))


@query
def typed_humidity_compat(spark, d):
    return rounded(typed_humidity(raw_feed(spark, d), "compat"))


# --------------------------------------------------------------- profiling ---
@query
def null_counts(spark, d):
    return P.null_counts(raw_feed(spark, d))


@query
def describe_numeric(spark, d):
    return rounded(P.describe_numeric(clean(spark, d), S.PROFILE_COLUMNS))


@query
def describe_lineitem(spark, d):
    return rounded(P.describe_numeric(lineitem(spark, d), LINE_NUMBERS), 4)


@query
def avg_by_hour(spark, d):
    return rounded(P.average_by(clean(spark, d), "hour"))


@query
def avg_by_month(spark, d):
    return rounded(P.average_by(clean(spark, d), "month"))


@query
def distinct_months(spark, d):
    return P.distinct_keys(typed(spark, d))


@query
def correlation_matrix(spark, d):
    return rounded(P.correlation_matrix(clean(spark, d)))


@query
def correlation_lineitem(spark, d):
    return rounded(P.correlation_matrix(lineitem(spark, d), LINE_NUMBERS))


@query
def histogram(spark, d):
    return rounded(P.histogram(clean(spark, d), S.CORRELATION_COLUMNS, 30))


@query
def histogram_lineitem(spark, d):
    return rounded(P.histogram(lineitem(spark, d), ["l_quantity", "l_extendedprice"], 40))


def _with_gaps(spark, d) -> DataFrame:
    """A price per unit that is NaN or infinite in some lines."""
    price, line = F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_linenumber")
    odd = F.when(line == 1, F.lit(float("nan"))).when(line == 2, F.lit(float("inf"))).when(
        line == 3, F.lit(float("-inf"))
    )
    return lineitem(spark, d).select(F.coalesce(odd, price.cast("double")).alias("unit_price"))


@query
def histogram_non_finite(spark, d):
    return rounded(P.histogram(_with_gaps(spark, d), ["unit_price"], 20))


@query
def non_finite_counts(spark, d):
    limits = P.axis_limits(_with_gaps(spark, d), ["unit_price"])
    return rounded(P.non_finite_counts(_with_gaps(spark, d), ["unit_price"]).crossJoin(limits))


@query
def geo_points(spark, d):
    return P.map_points(clean(spark, d))


@query
def head_rows(spark, d):
    """The first twenty observations by id."""
    return clean(spark, d).orderBy("event_id").limit(20)


@query
def alpha_labels(spark, d):
    """Labels of mixing weights, here of the discounts that occur."""
    weights = lineitem(spark, d).select(F.col("l_discount").cast("double").alias("weight")).distinct()
    return weights.withColumn("label", TXT.alpha_label("weight"))


@query
def top_k(spark, d):
    return P.top_k(P.null_counts(typed(spark, d)), "null_count", 5, "column")


# ---------------------------------------------------- sampling and splits ---
@query
def sample_fraction(spark, d):
    return D.sample_fraction(clean(spark, d), 0.1)


@query
def sample_n(spark, d):
    return D.sample_n(clean(spark, d), 300, KEY)


@query
def sample_n_lineitem(spark, d):
    keys = ["l_orderkey", "l_linenumber"]
    return D.sample_n(lineitem(spark, d).select(*keys).distinct(), 2500, keys)


def _gappy(spark, d) -> DataFrame:
    """Lines whose first key part is missing in every order's first line."""
    order = F.when(F.col("l_linenumber") != 1, F.col("l_orderkey"))
    return lineitem(spark, d).select(
        order.alias("k"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )


@query
def keyed_split_nulls(spark, d):
    both = _labelled(*D.keyed_split(_gappy(spark, d), ["k", "l_suppkey"], 70))
    flagged = D.validation_flag(D.assign_folds(both, ["k"]), ["k"])
    return flagged.groupBy("part", "fold", "is_validation").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query
def sample_n_nulls(spark, d):
    rows = _gappy(spark, d).select("k", "l_orderkey", "l_linenumber")
    return D.sample_n(rows, 2500, ["k", "l_orderkey", "l_linenumber"])


@query
def sample_n_ties(spark, d):
    """Keys that repeat: ties are broken by the whole row."""
    rows = _gappy(spark, d).select("l_suppkey", "l_orderkey", "l_linenumber")
    return D.sample_n(rows, 2500, ["l_suppkey"])


@query
def sample_share(spark, d):
    """The seeded sample: its share of the rows, and that all of it stems from them."""
    whole = clean(spark, d).select("event_id")
    drawn = D.sample_fraction(whole, 0.1).withColumn("drawn", F.lit(1))
    both = whole.join(drawn, "event_id", "full")
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"),
        F.avg(F.coalesce("drawn", F.lit(0))).between(0.06, 0.14).alias("share_ok"),
    )


@query
def random_split(spark, d):
    left, right = D.random_split(clean(spark, d).select("event_id"))
    both = left.withColumn("train", F.lit(1)).unionByName(right.withColumn("train", F.lit(0)))
    share = F.avg("train")
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("event_id").alias("id_sum"),
        share.between(0.6, 0.8).alias("share_ok"),
    )


def _labelled(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def keyed_split(spark, d):
    return _labelled(*parts(spark, d)).select("event_id", "part", "TMP_C")


@query
def split_tables(spark, d):
    path = scratch_path(spark, "split")
    return _labelled(*write_split(clean(spark, d), path, KEY)).select("event_id", "part", "TMP_C")


@query
def keyed_split_lineitem(spark, d):
    table = lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_quantity")
    both = _labelled(*D.keyed_split(table, ["l_orderkey", "l_linenumber"], 70))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query
def validation_flag(spark, d):
    return D.validation_flag(clean(spark, d).select("event_id"), KEY)


@query
def kfold_assign(spark, d):
    return D.assign_folds(clean(spark, d).select("event_id"), KEY)


@query
def quantiles_refined(spark, d):
    """Exact quantiles where buckets above a small limit must be cut again."""
    shares = [0.01, 0.25, 0.5, 0.9, 0.999]
    found = exact_quantiles(
        lineitem(spark, d), {"l_extendedprice": shares}, buckets=8, limit=40
    )["l_extendedprice"]
    return spark.createDataFrame(list(zip(shares, map(float, found))), "p double, x double")


# ---------------------------------------------------------------- features ---
@query
def impute_median(spark, d):
    table = typed(spark, d).select("STATION", "DATE", "TMP_C", "DEW_C", "SLP_hPa")
    return X.impute_exact_median(table, ["TMP_C", "DEW_C", "SLP_hPa"])


@query
def impute_mode(spark, d):
    tokens = C.split_packed(raw_feed(spark, d).select("event_id", "WND"))
    return X.impute_mode(tokens.select("event_id", "WND_TYPE"), ["WND_TYPE"])


def _indicators(df: DataFrame, keep: Sequence[str], column: str) -> DataFrame:
    fitted = Pipeline(stages=X.one_hot_stages([column])).fit(df)
    names = X.encoded_names(fitted, [])
    cells = vector_to_array(f"{column}_vec")
    return fitted.transform(df).select(
        *keep, *[F.get(cells, F.lit(i)).cast("int").alias(n) for i, n in enumerate(names)]
    )


@query
def one_hot(spark, d):
    tokens = C.split_packed(raw_feed(spark, d).select("event_id", "WND"))
    return _indicators(tokens.select("event_id", "WND_TYPE"), ["event_id"], "WND_TYPE")


@query
def one_hot_lineitem(spark, d):
    flags = _indicators(lineitem(spark, d).select("l_returnflag"), [], "l_returnflag")
    return flags.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in flags.columns])


@query
def one_hot_dictionary(spark, d):
    """A column of many values encoded through a distributed dictionary: rows per slot of the sparse vector."""
    table = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").cast("string").alias("order"))
    names = X.dictionary(table, "order")
    vectors = X.one_hot_by_dictionary(table, "order", names)
    slots = X.slot_sums(vectors, "order_vec")
    return names.join(slots, F.col("number") == F.col("slot"), "left").select(
        "value", F.col("number").cast("bigint").alias("slot"),
        F.coalesce("total", F.lit(0.0)).cast("bigint").alias("n"),
    )


@query
def standardize(spark, d):
    vectors = X.assembler(S.LINEAR_FEATURES).transform(clean(spark, d))
    vectors = vectors.select("event_id", "features")
    scaled = X.standardizer().fit(vectors).transform(vectors)
    cells = vector_to_array("scaledFeatures")
    return rounded(
        scaled.select(
            "event_id", *[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(S.LINEAR_FEATURES)]
        )
    )


@query
def prepare_features(spark, d):
    train, test = parts(spark, d)
    fitted, _, names = M.prepare_boosting(train.drop("event_id"))
    vectors = fitted.transform(test).select("event_id", "features")
    cells = vector_to_array("features")
    return rounded(
        vectors.select("event_id", *[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(names)])
    )


@query
def prepare_features_nulls(spark, d):
    """The same on a table with missing values in most columns; sums tell the fills."""
    table = typed(spark, d)
    fitted, vectors, names = M.prepare_boosting(table, "RH_pct")
    cells = vector_to_array("features")
    filled = vectors.select(*[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(names)])
    return rounded(filled.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]), 3)


# ------------------------------------------------------------------ models ---
def _coefficient_rows(
    model: PipelineModel, features: Sequence[str], spark, digits: int = 6
) -> DataFrame:
    table = E.coefficients(spark, model, features)
    intercept = float(model.stages[-1].intercept)
    rows = spark.createDataFrame([("(intercept)", intercept)], table.schema)
    return rounded(table.unionByName(rows), digits)


@query
def ols_fit(spark, d):
    return _coefficient_rows(M.fit_ols(parts(spark, d)[0]), S.LINEAR_FEATURES, spark)


@query
def ols_fit_lineitem(spark, d):
    features = ["l_quantity", "l_discount", "l_tax"]
    model = M.fit_ols(lineitem(spark, d), features, "l_extendedprice")
    return _coefficient_rows(model, features, spark, 3)


@query
def ridge_fit(spark, d):
    model = M.fit_penalized(parts(spark, d)[0], 0.0, 0.3)
    return _coefficient_rows(model, S.LINEAR_FEATURES, spark)


@query
def lasso_fit(spark, d):
    model = M.fit_penalized(parts(spark, d)[0], 1.0, 0.1)
    return _coefficient_rows(model, S.LINEAR_FEATURES, spark, 4)


@query
def enet_fit(spark, d):
    model = M.fit_penalized(parts(spark, d)[0], 0.5, 0.1)
    return _coefficient_rows(model, S.LINEAR_FEATURES, spark, 4)


@query
def regularization_path(spark, d):
    """All mixing weights over their whole grids, on the default split."""
    searches = M.search_penalties(parts(spark, d)[0], dict.fromkeys(M.ALPHAS), keys=KEY)
    error = F.round("rmse", 4).alias("rmse")
    rows = [s.trials.select(F.lit(a).alias("alpha"), "reg_param", error) for a, s in searches.items()]
    return reduce(DataFrame.unionByName, rows)


def _ols_scored(spark, d) -> DataFrame:
    train, test = parts(spark, d)
    return M.score(M.fit_ols(train), test, ["event_id", "DATE", "TMP_C"])


@query
def ols_predict(spark, d):
    return rounded(_ols_scored(spark, d), 4)


@query
def model_roundtrip(spark, d):
    train, test = parts(spark, d)
    model = M.fit_forest(train)
    path = M.save_model(model, scratch_path(spark, "forest"))
    before = M.score(model, test, test.columns, "before")
    again = rescore(path, before, keep=["before"])
    return again.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("before") == F.col("prediction")).alias("n_same"),
    )


def _scores(spark, d, model: PipelineModel) -> DataFrame:
    test = parts(spark, d)[1]
    return rounded(E.regression_metrics(M.score(model, test, ["TMP_C"])), 4)


@query
def rf_fit(spark, d):
    return _scores(spark, d, M.fit_forest(parts(spark, d)[0]))


@query
def feature_importance(spark, d):
    model = M.fit_forest(parts(spark, d)[0])
    return rounded(E.feature_importance(spark, model, S.FOREST_FEATURES))


# One tree of depth two on two features with few values: small enough to state in SQL.
ONE_TREE = {"num_trees": 1, "max_depth": 2, "subsample": 1.0, "feature_subset": "all", "bootstrap": False}


@query
def rf_tree(spark, d):
    train, test = parts(spark, d)
    model = M.fit_forest(train, ["hour", "month"], **ONE_TREE)
    return rounded(M.score(model, test, ["event_id", "hour", "month"]))


@query
def rf_tree_importance(spark, d):
    model = M.fit_forest(parts(spark, d)[0], ["hour", "month"], **ONE_TREE)
    return rounded(E.feature_importance(spark, model, ["hour", "month"]))


def _boost_inputs(spark, d):
    train = D.validation_flag(parts(spark, d)[0], KEY)
    return M.prepare_boosting(train, exclude=("DATE", "event_id"), keep=("is_validation",))


@query
def gbt_fit(spark, d):
    fitted, vectors, _ = _boost_inputs(spark, d)
    model = M.fit_boosted(vectors, SMALL_BOOST)
    return _scores(spark, d, PipelineModel([*fitted.stages, model]))


STUMPS = {"max_depth": 1, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0}


@query
def gbt_stumps(spark, d):
    """Two rounds of one-split trees on the hour, small enough to state in SQL."""
    train, test = parts(spark, d)
    assemble = X.assembler(["hour"])
    model = M.fit_boosted(assemble.transform(train), STUMPS | {"n_estimators": 2})
    return rounded(M.score(PipelineModel([assemble, model]), test, ["event_id", "hour"]))


@query
def gbt_stumps_importance(spark, d):
    assemble = X.assembler(["hour", "month"])
    model = M.fit_boosted(assemble.transform(parts(spark, d)[0]), STUMPS | {"n_estimators": 2})
    return rounded(E.feature_importance(spark, model, ["hour", "month"]))


@query
def gbt_patience(spark, d):
    """Validation loss of each round of one-split trees, and which rounds stay."""
    train = D.validation_flag(parts(spark, d)[0], KEY)
    vectors = X.assembler(["hour"]).transform(train).select("TMP_C", "features", "is_validation")
    params = STUMPS | {"n_estimators": 5, "learning_rate": 0.9}
    return rounded(M.patient_boosting(vectors, "is_validation", params, patience=2)[1])


@query
def gbt_early_stop(spark, d):
    fitted, vectors, _ = _boost_inputs(spark, d)
    model = M.fit_boosted(vectors, SMALL_BOOST, validation="is_validation")
    scores = _scores(spark, d, PipelineModel([*fitted.stages, model]))
    return scores.withColumn("trees", F.lit(model.getNumTrees))


@query
def gbt_random_search(spark, d):
    _, vectors, _ = _boost_inputs(spark, d)
    small = M.SEARCH_SPACE | {"n_estimators": ("whole", 2, 5), "max_depth": ("whole", 2, 4)}
    draws = M.draw_params(3, space=small)
    return rounded(M.search_boosted(vectors, "is_validation", draws).trials)


@query
def gbt_importance(spark, d):
    _, vectors, names = _boost_inputs(spark, d)
    model = M.fit_boosted(vectors, SMALL_BOOST)
    return rounded(E.top_importance(E.feature_importance(spark, model, names)))


def _binned(spark, d, features: Sequence[str], flagged: bool = False) -> B.Binned:
    train = parts(spark, d)[0]
    if flagged:
        train = D.validation_flag(train, KEY)
    keep = [*KEY, *(["is_validation"] if flagged else [])]
    return B.bin_features(train, features, "TMP_C", KEY, keep)


# Every row and feature counts, so that SQL can state the same trees.
WHOLE = {"subsample": 1.0, "colsample_bytree": 1.0}
REGULARISED = WHOLE | {
    "n_estimators": 2, "max_depth": 2, "learning_rate": 0.3,
    "reg_lambda": 1.0, "reg_alpha": 20.0, "gamma": 10500.0,
}


@query
def gbt_regularised(spark, d):
    """Two rounds of depth two under all three penalties."""
    model = B.fit(_binned(spark, d, ["hour", "month"]), REGULARISED)
    scored = model.transform(parts(spark, d)[1]).select("event_id", "hour", "month", "prediction")
    return rounded(scored)


@query
def gbt_nodes(spark, d):
    """The same trees as their node table, saved and read back."""
    model = B.fit(_binned(spark, d, ["hour", "month"]), REGULARISED)
    path = model.save(spark, scratch_path(spark, "boosted"))
    return rounded(B.load(spark, path).node_table(spark).drop("cut"), 4)


@query
def gbt_gain_importance(spark, d):
    """Mean gain per split of each feature, from the node table of a saved model."""
    names = ["hour", "month", "DEW_C"]
    model = B.fit(_binned(spark, d, names), REGULARISED | {"n_estimators": 3, "gamma": 0.0})
    path = model.save(spark, scratch_path(spark, "boosted"))
    return rounded(B.top_importance(spark.read.parquet(f"{path}/nodes"), names), 4)


@query
def gbt_patience_rounds(spark, d):
    """Rounds of one-split trees up to patience; none is fitted beyond."""
    params = WHOLE | {"n_estimators": 40, "max_depth": 1, "learning_rate": 0.9}
    return rounded(B.rounds_table(spark, B.fit(
        _binned(spark, d, ["hour"], True), params, "is_validation", patience=2
    )))


def _published_search(spark, d) -> B.Draws:
    """The twenty published draws on every feature, each stopped by patience."""
    train, keep = D.validation_flag(parts(spark, d)[0], KEY), ("is_validation", *KEY)
    _, vectors, names = M.prepare_boosting(train, exclude=("DATE",), keep=keep)
    rows = B.slots(vectors, names, ["TMP_C", *keep])
    return B.search(B.bin_features(rows, names, "TMP_C", KEY, keep), M.draw_params(), "is_validation")


@query
def gbt_search(spark, d):
    return rounded(_published_search(spark, d).trials)


@query
def gbt_best_params(spark, d):
    return rounded(E.params_row(spark, _published_search(spark, d).best))


@query
def learning_curve_boosted(spark, d):
    """Six sizes by three folds, every fit stopped by patience."""
    params = WHOLE | {"n_estimators": 4, "max_depth": 1, "learning_rate": 0.8}
    return rounded(B.learning_curve(_binned(spark, d, ["hour", "month"]), KEY, params, patience=1))


@query
def learning_curve(spark, d):
    return rounded(MOM.learning_curve(parts(spark, d)[0], KEY, S.LINEAR_FEATURES, "TMP_C"))


@query
def learning_curve_gbt(spark, d):
    train = parts(spark, d)[0].withColumn("row_key", key_hash(*KEY, digits=13))
    _, vectors, _ = M.prepare_boosting(
        train, exclude=("DATE", "event_id"), keep=("row_key",)
    )
    trees: GBTRegressor = M.boosted(
        {"n_estimators": 3, "max_depth": 2}, validationIndicatorCol="early", validationTol=0.01
    )
    curve = M.learning_curve(
        vectors, ["row_key"], trees, steps=2, folds=2, validation="early"
    )
    return rounded(curve, 4)


# -------------------------------------------------------------- evaluation ---
@query
def regression_metrics(spark, d):
    return rounded(E.regression_metrics(_ols_scored(spark, d)))


@query
def metrics_row(spark, d):
    row = E.metrics_row(E.regression_metrics(_ols_scored(spark, d)), "ols")
    return row.drop("timestamp")


@query
def rmse_by_hour(spark, d):
    return rounded(E.error_by(_ols_scored(spark, d), "hour"))


@query
def rmse_by_month(spark, d):
    return rounded(E.error_by(_ols_scored(spark, d), "month"))


@query
def calibration(spark, d):
    return rounded(E.calibration(_ols_scored(spark, d)))


@query
def residuals(spark, d):
    return rounded(E.residual_rows(_ols_scored(spark, d), keep=["event_id"]), 4)


@query
def residual_histogram(spark, d):
    rows = E.residual_rows(_ols_scored(spark, d))
    return rounded(P.histogram(rows, ["residual"], 50))


@query
def residual_qq(spark, d):
    return rounded(E.residual_qq(E.residual_rows(_ols_scored(spark, d))))


@query
def residual_qq_line(spark, d):
    return rounded(E.qq_line(E.residual_qq(E.residual_rows(_ols_scored(spark, d)))), 5)


@query
def pred_limits(spark, d):
    return rounded(P.axis_limits(_ols_scored(spark, d), ["TMP_C", "prediction"]))


@query
def coefficients(spark, d):
    train = parts(spark, d)[0]
    model = M.fit_ols(train, ["DEW_C", "LATITUDE"])
    return rounded(E.coefficients(spark, model, ["DEW_C", "LATITUDE"]))


@query
def coef_diagnostics(spark, d):
    model = M.fit_penalized(parts(spark, d)[0], 0.0, 0.003)
    return rounded(E.coefficient_diagnostics(E.coefficients(spark, model, S.LINEAR_FEATURES)))


@query
def result_json(spark, d):
    """The nested result of a ridge fit, written as JSON and read back."""
    train, test = parts(spark, d)
    model = M.fit_penalized(train, 0.0, 0.3)
    table = E.coefficients(spark, model, S.LINEAR_FEATURES)
    metrics = E.metrics_row(E.regression_metrics(M.score(model, test, ["TMP_C"])), "ridge")
    nested = E.nested_result(metrics, table, E.coefficient_diagnostics(table))
    path = TAB.write_json(nested, scratch_path(spark, "result"), 1)
    back = spark.read.schema(nested.schema).json(path)
    return rounded(back.select(
        "metrics.model", "metrics.rmse", "metrics.mae", "metrics.r2", "coef_diag.nonzero",
        F.explode("coefficients").alias("feature", "coefficient"),
    ))


@query
def model_comparison(spark, d):
    train, test = parts(spark, d)
    rows = []
    for features in (["DEW_C"], ["SLP_hPa"], S.LINEAR_FEATURES):
        model = M.fit_ols(train, features)
        metrics = E.regression_metrics(M.score(model, test, ["TMP_C"]))
        rows.append(
            E.metrics_row(
                metrics, f"ols_{len(features)}_{features[0]}",
                intercept=float(model.stages[-1].intercept),
            )
        )
    columns = ["model", "rmse", "mae", "r2", "intercept"]
    return rounded(E.model_comparison(rows, columns), 4)


@query
def family_comparison(spark, d):
    """Ridge, elastic net and lasso over their whole grids, the best of each scored on the test rows."""
    summary = regularized_family(*parts(spark, d), keys=KEY)[1]
    return rounded(summary, 4)
