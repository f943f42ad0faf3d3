import json
import os

import pytest

from skyledger.operators.sampling import keyed_split
from skyledger.plans import explore as X, modelling as J
from skyledger.plans.cleanse import cleanse
from skyledger.sources import tables as T
from skyledger.streaming.ingest import cleanse_stream


@pytest.fixture(scope="module")
def split(clean):
    train, test = keyed_split(clean.drop("RH"), ["event_id"])
    return train.drop("event_id").persist(), test.drop("event_id").persist()


def test_explore(clean, tmp_path):
    tables = X.explore(clean)
    assert sorted(X.write_explored(clean, str(tmp_path))) == sorted(tables)
    assert sorted(os.listdir(tmp_path)) == sorted(tables)
    assert tables["avg_tmp_by_hour"].count() == 24
    assert tables["correlation"].count() == 36 and tables["histogram"].count() == 180


def test_linear_family(split, tmp_path):
    base = J.linear_baseline(*split)
    row = base.tables["metrics"].first()
    assert row["model"] == "Baseline Linear Regression" and row["r2"] > 0.8
    assert base.tables["coefficients"].count() == 8
    base.write(f"{tmp_path}/base")
    with open(f"{tmp_path}/base/result/" + next(f for f in os.listdir(f"{tmp_path}/base/result") if f.startswith("part"))) as f:
        nested = json.load(f)
    assert len(nested["coefficients"]) == 8 and nested["coef_diag"]["nonzero"] == 8
    assert nested["metrics"]["r2"] == row["r2"] and "timestamp" not in nested["metrics"]
    grids = {0.0: [0.003, 0.1], 1.0: [0.003]}
    reports, summary = J.regularized_family(
        *split, alphas=[0.0, 1.0], grids=grids, folder=f"{tmp_path}/l"
    )
    assert sorted(os.listdir(f"{tmp_path}/l")) == ["lasso_a1", "regularized_summary", "ridge_a0"]
    assert [r["model"] for r in summary.collect()] == ["Ridge (alpha=0.0)", "Lasso (alpha=1.0)"]
    assert reports[0.0].tables["coefficient_diagnostics"].first()["nonzero"] == 8


def test_forest_report(spark, split, tmp_path):
    J.forest(*split, f"{tmp_path}/rf", num_trees=4, max_depth=4)
    made = set(os.listdir(f"{tmp_path}/rf"))
    assert made == {
        "model", "predictions", "metrics", "rmse_by_hour", "rmse_by_month", "calibration",
        "residual_histogram", "residual_qq", "axis_limits", "feature_importance", "top_features",
    }
    assert T.read_table(spark, f"{tmp_path}/rf/predictions").count() == split[1].count()
    again = J.rescore(f"{tmp_path}/rf/model", split[1], keep=("DATE", "TMP_C"))
    before = T.read_table(spark, f"{tmp_path}/rf/predictions")
    assert again.exceptAll(before).isEmpty()
    with pytest.raises(ValueError, match="fitted on"):
        J.rescore(f"{tmp_path}/rf/model", split[1], ["DEW_C"])
    with pytest.raises(ValueError, match="DEW_C"):
        J.rescore(f"{tmp_path}/rf/model", split[1].drop("DEW_C"))
    with pytest.raises(ValueError, match="SLP_hPa"):
        J.forest(split[0], split[1].drop("SLP_hPa"), f"{tmp_path}/no")


def test_boosting_report(spark, split, tmp_path):
    small = {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.5}
    table = J.boosting(
        *split, f"{tmp_path}/gbt", keys=("DATE", "LATITUDE"),
        base=small, draws=[small], curve={"steps": 1, "folds": 2}, patience=2,
    )
    assert [r["model"] for r in table.collect()] == ["base", "optimised", "patient"]
    assert {
        "base", "optimised", "patient", "trials", "best_params", "learning_curve", "base_learning_curve",
    } <= set(os.listdir(f"{tmp_path}/gbt"))


def test_stream_equals_batch(spark, feed, tmp_path):
    raw = feed.drop("event_id", "RH")
    source, target, state = (f"{tmp_path}/{n}" for n in ("raw", "clean", "state"))

    def run():
        cleanse_stream(spark, source, target, state).awaitTermination()
        return T.read_table(spark, target).count()

    raw.filter("TMP LIKE '-%'").write.mode("append").parquet(source)
    first = run()
    raw.filter("TMP NOT LIKE '-%'").write.mode("append").parquet(source)
    assert 0 < first < run() == 496
    assert run() == 496
    assert T.read_table(spark, target).exceptAll(cleanse(raw)).isEmpty()
