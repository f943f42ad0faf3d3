import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from skyledger.operators import evaluate as E, profile as P


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.RandomState(3)
    x = rng.normal(size=400)
    rows = [
        (float(a), float(2 * a + e), None if i % 5 == 0 else float(e), i)
        for i, (a, e) in enumerate(zip(x, rng.normal(size=400)))
    ]
    return spark.createDataFrame(rows, "a double, b double, c double, n int").repartition(4)


def test_null_counts(numbers):
    assert {r[0]: r[1] for r in P.null_counts(numbers).collect()} == {"a": 0, "b": 0, "c": 80, "n": 0}


def test_describe(numbers):
    pdf = numbers.toPandas()
    for r in P.describe_numeric(numbers).collect():
        s = pdf[r["column"]]
        assert r["count"] == s.count()
        assert math.isclose(r["mean"], s.mean(), abs_tol=1e-12)
        assert math.isclose(r["stddev"], s.std(), rel_tol=1e-12)
        assert (r["min"], r["max"]) == (s.min(), s.max())


def test_correlation_is_complete_pairwise(numbers):
    want = numbers.toPandas()[["a", "b", "c"]].corr()
    got = P.correlation_matrix(numbers, ["a", "b", "c", "absent"]).collect()
    assert len(got) == 9
    assert all(math.isclose(r["corr"], want.loc[r["x"], r["y"]], abs_tol=1e-12) for r in got)


def test_histogram_matches_numpy(numbers):
    pdf = numbers.toPandas()
    got = P.histogram(numbers, ["a", "c"], 30).collect()
    for c in ("a", "c"):
        counts, edges = np.histogram(pdf[c].dropna(), 30)
        mine = sorted((r["bin"], r["lo"], r["n"]) for r in got if r["column"] == c)
        assert [m[2] for m in mine] == list(counts)
        assert np.allclose([m[1] for m in mine], edges[:-1])


def test_histogram_corner_cases(spark, numbers):
    same = spark.range(5).select(F.lit(2.0).alias("x"), F.lit(None).cast("double").alias("y"))
    got = P.histogram(same, ["x", "y"], 4).collect()
    assert sum(r["n"] for r in got) == 5 and {r["column"] for r in got} == {"x"}
    assert P.histogram(same, ["y"], 4).isEmpty()
    given = P.histogram(numbers, ["a"], 2, {"a": (0.0, 1.0)})
    inside = numbers.filter("a between 0 and 1").count()
    assert given.agg(F.sum("n")).first()[0] == inside


def test_map_points_and_limits(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (None, 3.0)], "LATITUDE double, LONGITUDE double")
    assert [tuple(r) for r in P.map_points(df).collect()] == [(1.0, 2.0, 2)]
    assert tuple(P.axis_limits(df, ["LATITUDE", "LONGITUDE"]).first()) == (1.0, 3.0)


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 9.0), ("d", 0.0)], "f string, v double")
    assert [tuple(r) for r in P.top_k(df, "v", 3, "f").orderBy("rank").collect()] == [
        ("c", 9.0, 1), ("a", 1.0, 2), ("b", 1.0, 3),
    ]


def test_metrics_equal_the_evaluator(numbers):
    row = E.regression_metrics(numbers, "b", "a").first()
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="b", predictionCol="a", metricName=name).evaluate(numbers)
        assert math.isclose(row[name], want, rel_tol=1e-12)


def test_metrics_of_constant_label(spark):
    df = spark.range(3).select(F.lit(1.0).alias("y"), F.col("id").cast("double").alias("p"))
    assert E.regression_metrics(df, "y", "p").first()["r2"] is None


def test_qq_of_normal_residuals_is_a_line(spark):
    from statistics import NormalDist

    z = [NormalDist(3.0, 2.0).inv_cdf((i + 0.5) / 2000) for i in range(2000)]
    qq = E.residual_qq(spark.createDataFrame([(v,) for v in z], "residual double"))
    assert qq.count() == 99
    line = E.qq_line(qq).first()
    assert abs(line["slope"] - 2) < 0.01 and abs(line["intercept"] - 3) < 0.01 and line["r"] > 0.9999


def test_error_tables(spark):
    df = spark.createDataFrame(
        [("2024-01-01 05:00:00", 1.0, 2.0), ("2024-02-01 05:00:00", 4.0, 1.0)],
        "DATE string, TMP_C double, prediction double",
    ).withColumn("DATE", F.to_timestamp("DATE"))
    assert [tuple(r) for r in E.error_by(df, "hour").collect()] == [(5, math.sqrt(5.0), 1.0)]
    assert [tuple(r) for r in E.error_by(df, "month").collect()] == [(1, 1.0, -1.0), (2, 3.0, 3.0)]
    assert [tuple(r) for r in E.calibration(df).collect()] == [(1, 4.0, 1.0, 1), (2, 1.0, 2.0, 1)]
    assert E.calibration(df, width=2.0).count() == 2


def test_coefficient_diagnostics(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", -4.0), ("c", 0.0)], "feature string, coefficient double")
    assert tuple(E.coefficient_diagnostics(df).first()) == (2, 7.0, 5.0)


def test_reports(spark, numbers):
    metrics = E.regression_metrics(numbers, "b", "a")
    rows = [E.metrics_row(metrics, "x", intercept=1.0), E.metrics_row(metrics, "y", best_regParam=0.1)]
    table = E.model_comparison(rows).collect()
    assert [(r["model"], r["intercept"], r["best_regParam"]) for r in table] == [
        ("x", 1.0, None), ("y", None, 0.1),
    ]


def test_non_finite_values_are_counted_apart(spark):
    rows = [(1.0,), (2.0,), (5.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    df = spark.createDataFrame(rows, "x double")
    bins = {r["bin"]: (r["lo"], r["hi"], r["n"]) for r in P.histogram(df, ["x"], 4).collect()}
    assert bins == {0: (1.0, 2.0, 1), 1: (2.0, 3.0, 1), 2: (3.0, 4.0, 0), 3: (4.0, 5.0, 1)}
    assert tuple(P.axis_limits(df, ["x"]).first()) == (1.0, 5.0)
    assert tuple(P.non_finite_counts(df, ["x"]).first()) == ("x", 1, 2)
    assert P.histogram(df.filter("isnan(x)"), ["x"], 4).count() == 0
