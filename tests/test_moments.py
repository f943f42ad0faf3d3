"""Fits and errors from moments beside fits on the rows."""

import math

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from skyledger import schema as S
from skyledger.operators import features as X, models as M, moments as MOM


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(1e6, 3.0, 400), rng.normal(size=400), rng.integers(0, 4, 400)]
    y = 2e5 + 0.3 * (x[:, 0] - 1e6) - 2 * x[:, 1] + rng.normal(size=400)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(5)


def test_groups_add_up(table):
    x, y, df = table
    parts = MOM.gather(df, ["a", "b", "c"], "y", {"k": F.col("id") % 7})
    assert len(parts) == 7
    whole = MOM.total(parts, 4)
    z = np.c_[x, y]
    assert whole.n == 400 and np.allclose(whole.mean, z.mean(axis=0), rtol=1e-13)
    gaps = z - z.mean(axis=0)
    assert np.allclose(whole.products, gaps.T @ gaps, rtol=1e-9)
    line, _ = MOM.solve(whole)
    want = np.linalg.lstsq(np.c_[np.ones(400), gaps[:, :3]], y, rcond=None)[0]
    assert np.allclose(line.slopes, want[1:], rtol=1e-7)
    some = np.arange(400) % 7 == 3
    error = np.sqrt(np.mean((y - line.intercept - x @ line.slopes)[some] ** 2))
    assert math.isclose(parts[(3,)].rmse(line), error, rel_tol=1e-6)


@pytest.mark.parametrize("alpha, penalty", [(0.0, 0.3), (0.5, 0.1), (1.0, 0.2)])
def test_penalties_are_those_of_spark(spark, table, alpha, penalty):
    _, _, df = table
    theirs = M.fit_penalized(df, alpha, penalty, ["a", "b", "c"], "y")
    found = M.search_penalty(df, alpha, [penalty], ["a", "b", "c"], "y", keys=["id"])
    ours = found.model.stages[-1]
    assert np.allclose(ours.coefficients.toArray(), theirs.stages[-1].coefficients.toArray(), atol=1e-6)
    both = found.model.transform(theirs.transform(df).select(*df.columns, F.col("prediction").alias("p")))
    assert both.select(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-5


def test_missing_and_constant_columns(spark):
    rows = [(i, float(i), 1.0, None if i == 5 else 2.0 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    with pytest.raises(ValueError, match="skip"):
        M.search_penalty(df, 0.0, [0.0], ["a", "b"], "y", keys=["id"])
    found = M.search_penalty(df, 0.0, [0.0], ["a", "b"], "y", keys=["id"], handle_invalid="skip")
    predicted = found.model.transform(df.filter("id = 7")).first()["prediction"]
    assert math.isclose(predicted, 14.0, rel_tol=1e-9)
    with pytest.raises(ValueError, match="rows"):
        M.search_penalty(df.limit(0), 0.5, [0.1], ["a"], "y")


def test_curve_is_the_general_one(split):
    train = split[0]
    vectors = X.assembler(S.LINEAR_FEATURES).transform(train).select("event_id", "TMP_C", "features")
    want = M.learning_curve(vectors, ["event_id"], LinearRegression(labelCol="TMP_C"), steps=2, folds=2).collect()
    for n in (1, 6):
        got = MOM.learning_curve(train.repartition(n), ["event_id"], S.LINEAR_FEATURES, "TMP_C", steps=2, folds=2)
        for a, b in zip(got.collect(), want):
            assert a["size"] == b["size"]
            assert math.isclose(a["train_rmse"], b["train_rmse"], rel_tol=1e-7)
            assert math.isclose(a["val_rmse"], b["val_rmse"], rel_tol=1e-7)


@pytest.fixture(scope="module")
def split(clean, tmp_path_factory):
    from skyledger.plans.ingest import write_split

    return write_split(clean, f"{tmp_path_factory.mktemp('moments')}/split", ["event_id"])
