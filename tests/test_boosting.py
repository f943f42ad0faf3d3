"""Boosted trees beside a plain version of the same rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.catalog import queries as Q
from skyledger.operators import boosting as B, features as X, models as M
from skyledger.plans.ingest import write_split
from tests.conftest import SMALL


def plain_tree(x, y, margin, use, p, allowed):
    """Depth-first growth on raw values; returns a function of a row."""

    def weight(g, h):
        return -math.copysign(max(abs(g) - p["reg_alpha"], 0), g) / (h + p["reg_lambda"]) if h + p["reg_lambda"] else 0.0

    def score(g, h):
        return max(abs(g) - p["reg_alpha"], 0) ** 2 / (h + p["reg_lambda"])

    def grow(rows, depth):
        g = (margin - y)[rows].sum()
        leaf = weight(g, len(rows))
        best = (-1.0,)
        if depth < p["max_depth"]:
            for f in allowed:
                for cut in np.unique(x[rows, f])[1:]:
                    left = rows[x[rows, f] < cut]
                    gl, hl = (margin - y)[left].sum(), len(left)
                    h = len(rows)
                    if min(hl, h - hl) < p["min_child_weight"]:
                        continue
                    gain = score(gl, hl) + score(g - gl, h - hl) - score(g, h)
                    if gain > 1e-6 and gain >= p["gamma"] and gain > best[0] + 1e-9:
                        best = (gain, f, cut)
        if best[0] < 0:
            return lambda r: leaf
        _, f, cut = best
        low, high = grow(rows[x[rows, f] < cut], depth + 1), grow(rows[x[rows, f] >= cut], depth + 1)
        return lambda r: low(r) if r[f] < cut else high(r)

    return grow(np.flatnonzero(use), 0)


def plain_boost(x, y, p, fit, rounds):
    margin = np.full(len(y), y[fit].mean())
    out = []
    for _ in range(rounds):
        tree = plain_tree(x, y, margin, fit, p, range(x.shape[1]))
        margin = margin + p["learning_rate"] * np.array([tree(r) for r in x])
        out.append(margin)
    return out


PLAIN = {**B.DEFAULTS, "subsample": 1.0, "colsample_bytree": 1.0, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = np.c_[rng.integers(0, 9, 300), rng.integers(0, 5, 300) / 4.0]
    y = np.where(x[:, 0] > 4, 3.0, -1.0) + x[:, 1] * (x[:, 0] % 3) + rng.normal(size=300)
    rows = [(i, float(a), float(b), float(v), i % 4 == 0) for i, ((a, b), v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double, v boolean")
    return x, y, df, B.bin_features(df, ["a", "b"], "y", ["id"], keep=["id", "v"])


@pytest.mark.parametrize("over", [
    {"max_depth": 2}, {"max_depth": 3, "reg_alpha": 4.0, "reg_lambda": 0.0},
    {"max_depth": 4, "gamma": 12.0, "reg_lambda": 2.5}, {"max_depth": 3, "min_child_weight": 40}, {"max_depth": 0},
])
def test_trees_are_the_plain_ones(spark, data, over):
    x, y, df, binned = data
    p = {**PLAIN, **over, "n_estimators": 3}
    model = B.fit(binned, p)
    want = plain_boost(x, y, p, np.ones(len(y), bool), 3)[-1]
    got = [r["prediction"] for r in model.transform(df).orderBy("id").collect()]
    assert np.allclose(got, want, atol=1e-9)
    assert math.isclose(model.rmse(B.FIT), math.sqrt(np.mean((want - y) ** 2)), rel_tol=1e-9)


def test_without_penalties_stumps_are_those_of_spark(spark, clean, split):
    train, test = split
    vectors = X.assembler(["hour"]).transform(train)
    stumps = {"max_depth": 1, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "n_estimators": 2}
    theirs = M.fit_boosted(vectors, stumps)
    binned = B.bin_features(train, ["hour"], "TMP_C", ["event_id"])
    # Spark fits the first tree at full rate and later ones to twice the residual.
    ours = B.fit(binned, {**stumps, "reg_lambda": 0.0, "gamma": 0.0, "learning_rate": [1.0, 0.6]})
    both = ours.transform(X.assembler(["hour"]).transform(test), "ours")
    gaps = theirs.transform(both).select(F.max(F.abs(F.col("ours") - F.col("prediction")))).first()[0]
    assert gaps < 1e-9


@pytest.fixture(scope="module")
def split(clean, tmp_path_factory):
    return write_split(clean, f"{tmp_path_factory.mktemp('boost')}/split", ["event_id"])


def test_layout_does_not_matter(data):
    _, _, df, _ = data
    made = set()
    for rows in (df.coalesce(1), df.repartition(7)):
        binned = B.bin_features(rows, ["a", "b"], "y", ["id"])
        model = B.fit(binned, {"n_estimators": 2, "max_depth": 2, "subsample": 0.7, "colsample_bytree": 0.5})
        made.add(tuple(tuple(t.value) for t in model.trees))
    assert len(made) == 1


def test_no_round_beyond_patience(spark, data):
    _, _, _, binned = data
    p = {**PLAIN, "n_estimators": 60, "learning_rate": 0.9, "max_depth": 3}
    model = B.fit(binned, p, "v", patience=3)
    losses = [loss[B.STOP - 1] for loss in model.losses]
    assert model.kept == M.patient_rounds(losses, 3) == int(np.argmin(losses)) + 1
    assert len(model.trees) == model.kept + 3 < 60
    table = B.rounds_table(spark, model)
    assert table.filter("kept").count() == model.kept and table.count() == len(losses)


def test_draws_grow_as_they_do_alone(data):
    _, _, _, binned = data
    draws = [
        {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.5, "subsample": 0.8},
        {"n_estimators": 2, "max_depth": 3, "reg_lambda": 0.0, "colsample_bytree": 0.5},
        {"n_estimators": 3, "max_depth": 1, "reg_alpha": 3.0, "gamma": 2.0, "min_child_weight": 9},
    ]
    found = B.search(binned, draws, "v", patience=2)
    rows = found.trials.orderBy("trial").collect()
    assert found.best == draws[min(range(3), key=lambda i: rows[i]["rmse"])]
    assert found.model.kept == rows[draws.index(found.best)]["trees"]
    assert B.search(binned, draws, "v", patience=2, together=1).trials.orderBy("trial").collect() == rows


def test_curve_is_that_of_single_fits(data):
    _, _, df, binned = data
    p = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.5, "subsample": 1.0}
    cells = B.learning_curve(binned, ["id"], p, steps=2, folds=2, patience=2, cells=True).collect()
    assert [r["size"] for r in cells] == [50, 50, 300, 300]
    flagged = B.assign_folds(binned.rows, ["id"], 2, "f", salt="fold42")
    flagged = B.validation_flag(flagged, ["id"], 15, "e", salt="validation42")
    one = flagged.filter("f <> 0")
    alone = B.fit(B.Binned(one, binned.features, binned.cuts), p, "e", patience=2)
    full = [c for c in cells if c["size"] == 300 and c["fold"] == 0][0]
    assert math.isclose(full["train_rmse"], alone.rmse(B.FIT, B.STOP), rel_tol=1e-9) and full["trees"] == alone.kept


def test_saved_model_predicts_the_same(spark, data, tmp_path):
    _, _, df, binned = data
    model = B.fit(binned, {"n_estimators": 5, "max_depth": 4}, "v", patience=2)
    again = B.load(spark, model.save(spark, f"{tmp_path}/m"))
    both = again.transform(model.transform(df, "before"))
    assert both.filter("before <> prediction").isEmpty() and again.kept == model.kept


def test_importance(spark, data):
    _, _, _, binned = data
    model = B.fit(binned, {**PLAIN, "n_estimators": 4, "max_depth": 2})
    nodes = model.node_table(spark)
    splits = [r for r in nodes.collect() if r["feature"]]
    for kind, of in (("gain", lambda r: r["gain"]), ("cover", lambda r: r["cover"]), ("weight", None)):
        got = {r["feature"]: r["importance"] for r in B.importance(nodes, model.features, kind).collect()}
        for f in got:
            mine = [r for r in splits if r["feature"] == f]
            assert math.isclose(got[f], len(mine) if of is None else np.mean([of(r) for r in mine]))
    none = B.fit(binned, {**PLAIN, "n_estimators": 2, "gamma": 1e9})
    assert {r["importance"] for r in B.importance(none.node_table(spark), none.features).collect()} == {0.0}


def test_missing_values_and_empty_tables(spark):
    rows = [(i, None if i % 3 == 0 else float(i % 7), 5.0 if i % 3 == 0 else float(i % 7)) for i in range(90)]
    rows += [(90, float("nan"), 5.0), (91, float("inf"), 9.0), (92, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, y double")
    binned = B.bin_features(df, ["a"], "y", ["id"])
    assert binned.rows.agg(F.min(F.get("bins", F.lit(0)))).first()[0] == -1
    model = B.fit(binned, {**PLAIN, "n_estimators": 3, "max_depth": 3, "reg_lambda": 0.0, "learning_rate": 1.0})
    got = model.transform(df.filter("a is null or isnan(a)")).agg(F.min("prediction"), F.max("prediction")).first()
    assert all(abs(v - 5.0) < 0.01 for v in got)
    nothing = B.fit(B.Binned(binned.rows.limit(0), binned.features, binned.cuts))
    assert nothing.kept == 0 and nothing.transform(df).filter("prediction <> 0").isEmpty()
    constant = spark.createDataFrame([(1, 2.0, 7.5)] * 4, "id long, a double, y double")
    flat = B.fit(B.bin_features(constant, ["a"], "y"), {"n_estimators": 2})
    assert flat.transform(constant).first()["prediction"] == 7.5


def test_binned_rows_are_spread_and_losses_do_not_follow_the_layout(spark, data):
    _, _, df, _ = data
    tasks = spark.sparkContext.defaultParallelism
    seen = set()
    for rows in (df.coalesce(1), df.orderBy("y").repartition(7)):
        binned = B.bin_features(rows, ["a", "b"], "y", ["id"], keep=["id", "v"])
        assert binned.rows.rdd.getNumPartitions() == tasks  # one file in, work for all cores out
        for at in (1, 5):
            laid = B.Binned(binned.rows.repartition(at), binned.features, binned.cuts)
            seen.add(tuple(B.fit(laid, {"n_estimators": 4, "max_depth": 2}, "v", patience=4).losses))
    assert len(seen) == 1


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_shallow_trees_as_cases_find_the_same_nodes(spark, data, monkeypatch, depth):
    _, _, _, binned = data
    tree = B.fit(binned, {**PLAIN, "n_estimators": 1, "max_depth": depth}).trees[0]
    cases = B.node_of(tree)
    monkeypatch.setattr(B, "_SHALLOW", 0)
    assert binned.rows.filter(cases != B.node_of(tree)).isEmpty() and tree.depth() == depth


def test_hash_is_that_of_spark(spark):
    keys = [0, 1, -7, 2**59 + 12345, -(2**63)]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    for seed, round_ in ((42, 0), (-3, 1199), (2**40, 5)):
        want = [r[0] for r in df.select(F.xxhash64("key", F.lit(seed), F.lit(round_))).collect()]
        seeded = B._hashed(seed, B._hashed(np.array(keys), np.uint64(42), 8), 8 if seed > 2**31 else 4)
        assert B._hashed(round_, seeded, 4).astype(np.int64).tolist() == want


def test_draws_apart_and_side_by_side_grow_the_same_trees(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [
        (i, float(rng.integers(0, 400)), None if i % 11 == 0 else float(rng.normal()), float(i % 2), float(i % 3 == 0),
         None if i == 5 else float(rng.normal() + i % 7), i % 6 == 0)
        for i in range(700)
    ]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, v boolean")
    binned = B.bin_features(df, ["a", "b", "c", "d"], "y", ["id"], keep=["v"], bins=64)
    draws = [
        {"n_estimators": 4, "max_depth": 7, "learning_rate": 0.6, "subsample": 0.7, "colsample_bytree": 0.5, "reg_lambda": 0.0},
        {"n_estimators": 9, "max_depth": 5, "learning_rate": 0.4, "reg_alpha": 2.0, "gamma": 3.0, "min_child_weight": 7},
        {"n_estimators": 3, "max_depth": 0}, {"n_estimators": 2, "max_depth": 2, "gamma": 1e9},
        {"n_estimators": 5, "max_depth": 4, "learning_rate": 0.9, "subsample": 1.0, "colsample_bytree": 1.0},
    ]
    found = []
    for most, together in ((1 << 28, 3), (1 << 28, 20), (0, 20)):  # all rows in one task, none
        monkeypatch.setattr(B, "_ALONE", most)
        some = B.search(binned, draws, "v", patience=2, together=together)
        trials = [repr(r) for r in some.trials.orderBy("trial").collect()]
        nodes = sorted(map(repr, some.model.node_table(spark).collect()))
        found.append((some.best, trials, nodes, some.model.losses, some.model.rates[: some.model.kept]))
    assert found[0] == found[1] == found[2] and len(found[0][2]) > 50


def test_a_deep_tree_alone_is_the_plain_one(spark, data):
    x, y, _, binned = data
    p = {**PLAIN, "n_estimators": 3, "max_depth": 6, "reg_alpha": 1.0}
    marked = np.arange(len(y)) % 4 == 0
    want = plain_boost(x, y, p, ~marked, 3)
    found = B.search(binned, [p], "v", patience=3)
    losses = [math.sqrt(np.mean((w - y)[marked] ** 2)) for w in want]
    assert np.allclose([math.sqrt(loss[B.STOP - 1]) for loss in found.model.losses], losses, rtol=1e-9)
    assert math.isclose(found.trials.first()["rmse"], min(losses), rel_tol=1e-9)


@pytest.mark.parametrize("name", ["gbt_search", "gbt_best_params"])
def test_registered_searches_are_the_published_ones(spark, monkeypatch, name):
    seen = []

    def search(binned, draws, validation, patience=B.PATIENCE, seed=42):
        seen.append((binned.features, [dict(d) for d in draws], patience, binned.rows.count()))
        return B.Draws(lambda: None, dict(draws[0]), spark.createDataFrame([{**draws[0], "trial": 0, "trees": 1, "rmse": 1.0}]))

    monkeypatch.setattr(Q.B, "search", search)
    Q.QUERIES[name](spark, SMALL).collect()
    features, draws, patience, n = seen[0]
    assert draws == M.draw_params(20, 42) and patience == 50
    assert min(d["n_estimators"] for d in draws) >= 200 and max(d["max_depth"] for d in draws) == 12
    assert n == Q.parts(spark, SMALL)[0].count() and len(features) == 18 and "DEW_C" in features
