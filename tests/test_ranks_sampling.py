import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators import ranks as R, sampling as D


def disc(values, p):
    v = sorted(values)
    return v[max(1, int(np.ceil(p * len(v)))) - 1]


def test_quantiles_are_exact(spark):
    rng = np.random.RandomState(7)
    x = rng.lognormal(3, 4, 5000)
    y = np.round(rng.normal(0, 2, 5000), 1)
    y[:2000] = 1.5  # one value holds much of the column
    rows = [(float(a), float(b), None if i % 7 == 0 else i) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, z int").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = R.exact_quantiles(df, {"x": probs, "y": probs, "z": probs})
    # Few coarse buckets and a low limit force cutting again and again.
    assert got == R.exact_quantiles(df, {c: probs for c in "xyz"}, buckets=3, limit=20)
    z = [r[2] for r in rows if r[2] is not None]
    assert got["x"] == [disc(x, p) for p in probs]
    assert got["y"] == [disc(y, p) for p in probs]
    assert got["z"] == [disc(z, p) for p in probs]
    blend = R.exact_quantiles(df, {"x": probs, "y": probs}, interpolate=True)
    assert np.allclose(blend["x"], np.quantile(x, probs), rtol=1e-12)
    assert np.allclose(blend["y"], np.quantile(y, probs), rtol=1e-12)


def test_quantiles_of_odd_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, 5.0, float("nan")), (1.0, None, float("nan"), float("inf")),
         (1.0, None, 7.0, 2.0)],
        "same double, none double, holes double, wide double",
    )
    got = R.exact_quantiles(df, {c: [0.5, 1.0] for c in df.columns})
    assert got == {
        "same": [1.0, 1.0], "none": [None, None], "holes": [5.0, 7.0],
        "wide": [2.0, float("inf")],
    }


@pytest.mark.parametrize("cuts", [[], [0.0], [10.0, 20.0], [-5.0, 500.0]])
def test_any_cut_points_give_the_same_ranks(spark, cuts):
    df = spark.range(100).select((F.col("id") % 40).cast("double").alias("x"))
    got = R.order_statistics(df, {"x": [1, 50, 100, 101]}, {"x": cuts})["x"]
    values = sorted(i % 40 for i in range(100))
    assert got == {
        r: (v, values.index(v), values.count(v)) for r in (1, 50, 100) for v in [values[r - 1]]
    }


def test_value_that_hides_its_neighbours(spark):
    # All but a few rows hold one value, so no quantile of the bucket shows the rest.
    x = F.when(F.col("id") < 9000, 0.0).otherwise(F.col("id").cast("double"))
    df = spark.range(9050).select(x.alias("x"))
    got = R.order_statistics(df, {"x": [5000, 9001, 9050]}, {"x": []}, buckets=4, limit=10)["x"]
    assert got == {5000: (0.0, 0, 9000), 9001: (9000.0, 9000, 1), 9050: (9049.0, 9049, 1)}


def test_sample_n_is_exact_and_nested(spark):
    df = spark.range(5000).repartition(5)
    sizes = [0, 1, 100, 2500, 5000, 6000]
    sets = [
        {r[0] for r in s.collect()} for s in D.nested_samples(df, sizes, ["id"], seed=1)
    ]
    assert [len(s) for s in sets] == [0, 1, 100, 2500, 5000, 5000]
    assert all(a <= b for a, b in zip(sets, sets[1:]))
    assert {r[0] for r in D.sample_n(df.coalesce(1), 100, ["id"], seed=1).collect()} == sets[2]
    assert {r[0] for r in D.sample_n(df, 100, ["id"], seed=2).collect()} != sets[2]


def test_sample_n_breaks_ties(spark):
    # One key holds a third of all rows.
    df = spark.range(900).select("id", F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("k"))
    for n in (1, 200, 450, 899):
        assert D.sample_n(df, n, ["k"]).count() == n


def test_ties_do_not_depend_on_partitions(spark):
    df = spark.range(600).select((F.col("id") % 4).alias("k"), F.col("id").alias("v"))
    for n in (1, 77, 599):
        sets = [
            sorted(tuple(r) for r in D.sample_n(rows, n, ["k"]).collect())
            for rows in (df.coalesce(1), df.repartition(7), df.repartition(3, "v"))
        ]
        assert sets[0] == sets[1] == sets[2] and len(sets[0]) == n
    same = spark.range(50).select(F.lit("a").alias("k"), F.lit(None).cast("int").alias("v"))
    assert D.sample_n(same, 20, ["k"]).count() == 20


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (None, "a"), (None, None)], "i int, k string")
    for keys in (["k"], ["i", "k"]):
        train, test = D.keyed_split(df, keys, 50)
        assert train.count() + test.count() == 5 and train.intersect(test).isEmpty()
        assert D.validation_flag(df, keys).filter("is_validation is null").isEmpty()
        assert D.assign_folds(df, keys).filter("fold is null").isEmpty()
        for n in range(6):
            assert D.sample_n(df, n, keys).count() == n
    swapped = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert swapped.select(D.key_hash("x", "y").alias("h")).distinct().count() == 2


def test_splits(spark):
    df = spark.range(4000).withColumn("v", F.col("id") * 2)
    train, test = D.keyed_split(df.repartition(7), ["id"], 70)
    assert train.count() + test.count() == 4000 and train.intersect(test).isEmpty()
    assert 2650 < train.count() < 2950
    again, _ = D.keyed_split(df.coalesce(1), ["id"], 70)
    assert again.exceptAll(train).isEmpty()
    left, right = D.random_split(df)
    assert left.count() + right.count() == 4000 and left.intersect(right).isEmpty()
    assert 2600 < left.count() < 3000
    assert 300 < D.sample_fraction(df, 0.1).count() < 500


def test_flags_and_folds(spark):
    df = spark.range(3000)
    share = D.validation_flag(df, ["id"]).filter("is_validation").count()
    assert 380 < share < 520
    folds = D.assign_folds(df, ["id"], 3).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2] and all(r["count"] > 900 for r in folds)


def test_subset_sizes():
    assert D.subset_sizes(1000) == [100, 280, 460, 640, 820, 1000]
    assert D.subset_sizes(200)[0] == 50
    assert D.subset_sizes(30) == [30] * 6
