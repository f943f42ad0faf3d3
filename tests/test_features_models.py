import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from skyledger import schema as S
from skyledger.operators import evaluate as E, features as X, models as M
from skyledger.operators.sampling import keyed_split, validation_flag
from skyledger.session import held_for_training
from skyledger.sources.checks import require_inputs


@pytest.fixture(scope="module")
def split(clean):
    train, test = keyed_split(clean, ["event_id"])
    return train.persist(), test.persist()


def test_median_imputers_agree(spark):
    rows = [(float(i % 10), None if i % 4 == 0 else float(i)) for i in range(101)]
    df = spark.createDataFrame([*rows, (float("nan"), None)], "a double, b double")
    ours = X.impute_exact_median(df, ["a", "b"])
    theirs = X.median_imputer(["a", "b"], 0.0).fit(df).transform(df)
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, theirs.collect()))
    model = X.median_imputer(["a", "b"]).fit(df)
    require_inputs(model, ["a", "b"])
    with pytest.raises(ValueError):
        require_inputs(model, ["b", "a"])
    assert model.getRelativeError() == 0.001


def test_mode_takes_the_least_on_ties(spark):
    df = spark.createDataFrame(
        [("b", None), ("a", None), (None, None), ("b", None), ("a", "it's")], "x string, y string"
    )
    assert X.categories(df, ["x", "y"]) == {"x": ("a", 2), "y": ("it's", 1)}
    assert X.impute_mode(df, ["x"]).filter("x = 'a'").count() == 3
    assert X.fill_stage({"x": "a", "y": "it's"}).transform(df).filter("y_fill = \"it's\"").count() == 5


def test_one_hot_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("N",), ("C",), ("N",)], "t string")
    fitted = Pipeline(stages=X.one_hot_stages(["t"])).fit(df)
    assert X.encoded_names(fitted, ["n"]) == ["n", "t=C", "t=N"]
    new = spark.createDataFrame([("C",), ("N",), ("?",), (None,)], "t string")
    got = fitted.transform(new).select(vector_to_array("t_vec")).collect()
    assert [r[0] for r in got] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_preparation_reads_ids_as_numbers(spark):
    """An id is one numeric slot however many values it has; what is no number is filled."""
    df = spark.range(301).select(
        F.when(F.col("id") == 7, "A7").otherwise(F.col("id").cast("string")).alias("t"),
        F.when(F.col("id") > 0, F.col("id").cast("double")).alias("x"),
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 > 1, "a").otherwise("b")).alias("c"),
    )
    stages, numeric = X.preparation(df, [], ["t"])
    fitted = stages.fit(df)
    assert numeric == ["x", "t"] and X.encoded_names(fitted, numeric) == ["x", "t", "c=a", "c=b"]
    rows = {r["t"]: r["features"].toArray().tolist() for r in fitted.transform(df).collect()}
    assert rows["A7"] == [7.0, 150.0, 0.0, 1.0] and rows["0"] == [150.0, 0.0, 1.0, 0.0]


def test_exact_median_stage(spark):
    rows = [(float(i), None if i % 2 else float(-i)) for i in range(9)] + [(float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    model = X.fit_exact_median(df, ["a", "b"])
    assert tuple(model.surrogateDF.first()) == (4.0, -4.0)
    require_inputs(model, ["a", "b"])
    with pytest.raises(ValueError, match="b"):
        X.fit_exact_median(df.withColumn("b", F.lit(None).cast("double")), ["a", "b"])


def test_fits_do_not_depend_on_partitions(spark, split):
    train, test = split
    forest, penalty, boosted = set(), set(), set()
    for n in (1, 2, 7):
        rows = train.repartition(n)
        model = M.fit_forest(rows, num_trees=3, max_depth=4)
        forest.add(round(E.regression_metrics(M.score(model, test)).first()["rmse"], 9))
        found = M.search_penalty(rows, 0.5, [0.001, 0.05, 5.0], keys=["event_id"])
        penalty.add(tuple(round(r["rmse"], 7) for r in found.trials.collect()))
        vectors = X.assembler(["DEW_C", "hour"]).transform(rows).select("TMP_C", "features")
        trees = M.fit_boosted(vectors, {"n_estimators": 3, "max_depth": 2})
        boosted.add(round(float(trees.predict(vectors.orderBy("TMP_C").first()["features"])), 9))
    assert len(forest) == len(penalty) == len(boosted) == 1


def test_default_validation_rows_follow_the_row(split):
    train, _ = split
    scores = {
        tuple(round(r["rmse"], 7) for r in M.search_penalty(rows, 0.0, [0.01, 1.0]).trials.collect())
        for rows in (train.coalesce(1), train.repartition(5))
    }
    assert len(scores) == 1


def test_patience():
    assert M.patient_rounds([5.0, 4.0, 4.5, 4.2, 3.0], 2) == 2
    assert M.patient_rounds([5.0, 4.0, 4.5, 3.9, 3.0], 2) == 5
    assert M.patient_rounds([1.0, 2.0, 3.0], 50) == 1
    assert M.patient_rounds([1.0], 1) == 1


def test_patient_model_keeps_the_best_rounds(split):
    train = validation_flag(split[0], ["event_id"])
    vectors = X.assembler(["hour"]).transform(train).select("TMP_C", "features", "is_validation")
    params = {"n_estimators": 12, "max_depth": 1, "learning_rate": 1.0, "subsample": 1.0, "colsample_bytree": 1.0}
    model, rounds = M.patient_boosting(vectors, "is_validation", params, patience=2)
    losses = [r["loss"] for r in rounds.orderBy("round").collect()]
    assert len(losses) == 12 and model.getNumTrees == M.patient_rounds(losses, 2)
    assert rounds.filter("kept").count() == model.getNumTrees
    same = M.fit_boosted(vectors, params, validation="is_validation", patience=2)
    assert same.getNumTrees == model.getNumTrees


def test_assembler_on_missing_features(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert X.assembler(["a", "b"], "skip").transform(df).count() == 1
    with pytest.raises(Exception, match="null"):
        X.assembler(["a", "b"]).transform(df).collect()


def matrix(df, features):
    pdf = df.select(*features, S.LABEL).toPandas()
    return pdf[list(features)].to_numpy(float), pdf[S.LABEL].to_numpy(float)


def test_ols_equals_least_squares(split):
    train, _ = split
    x, y = matrix(train, S.LINEAR_FEATURES)
    want = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)[0]
    model = M.fit_ols(train).stages[-1]
    assert np.allclose([model.intercept, *model.coefficients], want, rtol=1e-6, atol=1e-9)


def test_penalties_shrink(split):
    norms = [
        np.linalg.norm(M.fit_penalized(split[0], 0.0, r).stages[-1].coefficients.toArray())
        for r in (0.0, 0.1, 1.0, 10.0)
    ]
    assert norms == sorted(norms, reverse=True)
    sparse = M.fit_penalized(split[0], 1.0, 1.0).stages[-1].coefficients.toArray()
    assert np.count_nonzero(sparse) < 8


def test_penalty_search(split):
    train, test = split
    found = M.search_penalty(train, 0.5, [0.001, 5.0])
    trials = {r["reg_param"]: r["rmse"] for r in found.trials.collect()}
    assert found.best == {"elasticNetParam": 0.5, "best_regParam": min(trials, key=trials.get)}
    direct = M.fit_penalized(train, 0.5, found.best["best_regParam"]).stages[-1]
    assert np.allclose(
        direct.coefficients.toArray(), found.model.stages[-1].coefficients.toArray(), atol=1e-6
    )
    assert M.score(found.model, test).columns == ["TMP_C", "prediction"]


def test_forest_importance_and_reload(spark, split, tmp_path):
    train, test = split
    model = M.fit_forest(train, num_trees=5, max_depth=4)
    table = E.feature_importance(spark, model, S.FOREST_FEATURES)
    assert math.isclose(table.agg(F.sum("importance")).first()[0], 1.0, rel_tol=1e-9)
    assert E.top_importance(table, 5).count() == 5
    require_inputs(model.stages[0], S.FOREST_FEATURES)
    loaded = M.load_model(M.save_model(model, f"{tmp_path}/m"))
    same = loaded.transform(M.score(model, test, test.columns, "before"))
    assert same.filter("before <> prediction").isEmpty()
    forest = loaded.stages[-1]
    assert (forest.getNumTrees, forest.getOrDefault("subsamplingRate")) == (5, 0.7)


def test_forest_defaults():
    import inspect

    d = {k: p.default for k, p in inspect.signature(M.fit_forest).parameters.items()}
    assert (d["num_trees"], d["max_depth"], d["subsample"], d["seed"]) == (80, 10, 0.7, 42)
    assert M.default_grid(0.0) == M.RIDGE_GRID and M.default_grid(0.5) == M.LASSO_GRID


def test_draws_are_the_published_ones():
    draws = M.draw_params()
    assert len(draws) == 20 and draws == M.draw_params()
    best = draws[6]
    assert (best["n_estimators"], best["max_depth"], best["min_child_weight"]) == (600, 12, 2)
    assert math.isclose(best["learning_rate"], 0.291179542051722)
    trees = M.boosted(best)
    assert (trees.getMaxIter(), trees.getMinInstancesPerNode()) == (600, 2)
    assert math.isclose(trees.getMinInfoGain(), best["gamma"])
    assert M.boosted(M.BOOSTED_DEFAULTS).getFeatureSubsetStrategy() == "0.8"


def test_boosting(spark, split):
    train, test = split
    train = validation_flag(train, ["event_id"])
    fitted, vectors, names = M.prepare_boosting(
        train, exclude=("DATE", "event_id"), keep=("is_validation",)
    )
    assert vectors.columns == ["TMP_C", "features", "is_validation"]
    assert len(names) == len(vectors.first()["features"]) and names[-1] == "WND_TYPE=V"
    assert names.count("STATION") == 1 and not any(n.startswith("STATION=") for n in names)
    small = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.5}
    model = M.fit_boosted(vectors, small)
    scored = M.score(PipelineModel([*fitted.stages, model]), test)
    assert E.regression_metrics(scored).first()["r2"] > 0.7
    early = M.fit_boosted(
        vectors, {**small, "n_estimators": 40}, validation="is_validation", tolerance=0.5
    )
    assert early.getNumTrees < 40
    found = M.search_boosted(vectors, "is_validation", [small, {**small, "n_estimators": 1}])
    trials = found.trials.orderBy("trial").collect()
    assert found.best == small and trials[0]["rmse"] < trials[1]["rmse"]


def test_learning_curve(split):
    vectors = X.assembler(S.LINEAR_FEATURES).transform(split[0]).select("event_id", "TMP_C", "features")
    linear = LinearRegression(labelCol="TMP_C")
    one = M.learning_curve(vectors, ["event_id"], linear, steps=2, folds=2).collect()
    other = M.learning_curve(vectors.repartition(3), ["event_id"], linear, steps=2, folds=2).collect()
    assert [r["size"] for r in one] == [50, split[0].count()]
    for a, b in zip(one, other):
        assert math.isclose(a["train_rmse"], b["train_rmse"], rel_tol=1e-9)
        assert math.isclose(a["val_rmse"], b["val_rmse"], rel_tol=1e-9)
    assert one[1]["train_rmse"] <= one[1]["val_rmse"] * 1.05


def test_forest_rows_keep_their_nodes_and_trees_stay_the_same(clean):
    columns, params = ["DEW_C", "hour", "month"], {"num_trees": 4, "max_depth": 5}
    model = M.fit_forest(clean, columns, **params)
    forest = model.stages[-1]
    assert forest.getCacheNodeIds()  # no walk from the root for each row, tree and level
    vectors = PipelineModel(model.stages[:2]).transform(M.model_columns(clean, "TMP_C", columns))
    plain = RandomForestRegressor(
        labelCol="TMP_C", numTrees=4, maxDepth=5, subsamplingRate=0.7, featureSubsetStrategy="sqrt", seed=42,
    )
    with held_for_training(vectors.select("TMP_C", "features")) as held:
        walked = plain.fit(held)
    assert walked.toDebugString.split("\n")[1:] == forest.toDebugString.split("\n")[1:]
