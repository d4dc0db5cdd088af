"""Registered model queries: linear ones by closed forms, trees by what they are asked for."""
import datetime as dt
import os
from types import SimpleNamespace

import pytest

from check_oracle import compare, duck
from fareforge.operators import modeling
from fareforge.plans import ORACLES, QUERIES
from fareforge.plans import modeling as plans

SF = "/root/testdata/sf0.01"
DAY = dt.date(2000, 1, 1)
WINDOWS = [SimpleNamespace(name=f"fold_{k}", split_type="cv", number=k) for k in (1, 2, 3, 4)]
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def row(**more):
    return {"CategoryID": "ECONOMY", "FoldName": "fold_1", "TrainStart": DAY, "TrainEnd": DAY, "EvaluationStart": DAY,
            "EvaluationEnd": DAY, "ModelName": "GradientBoosting", "TrainRows": 1, "EvaluationRows": 1, "FeatureCount": 1,
            "MAE": 1.0, "RMSE": 1.0, "MAPE": 1.0, "R2": 1.0, **more}


@pytest.mark.parametrize("name,model,settings", [("fit_random_forest", "RandomForest", (100, 30)), ("fit_gbt", "GradientBoosting", (100, 5))])
def test_trees_use_the_library_defaults_on_every_fold(spark, monkeypatch, name, model, settings):
    found = []
    monkeypatch.setattr(plans, "_setup", lambda *_: ({"ECONOMY": None}, WINDOWS, {"ECONOMY": None}))

    def run_folds(frames, windows, features, estimators, scale=True, min_rows=5, parallel=4):
        found.append(estimators[model](None, "Price"))
        return [row(ModelName=model, FoldName=w.name, MAE=float("nan") if w.number == 4 else 1.0) for w in windows]
    monkeypatch.setattr(modeling, "run_folds", run_folds)
    got = QUERIES[name](spark, "").collect()
    tree = found[0]
    assert (tree.getNumTrees() if model == "RandomForest" else tree.getMaxIter(), tree.getMaxDepth()) == settings
    assert {r.FoldName: r.UsableMetrics for r in got} == {"fold_1": True, "fold_2": True, "fold_3": True, "fold_4": False}


def test_tree_search_asks_for_all_trials(spark, monkeypatch):
    asked = []

    def run_folds(frames, windows, features, estimators, scale=True, min_rows=5, parallel=4):
        asked.append(estimators)
        return [row(ModelName=m, FoldName=w.name) for m in estimators for w in windows]
    monkeypatch.setattr(modeling, "run_folds", run_folds)
    found = modeling.temporal_search({}, WINDOWS, {}, modeling.sample_trials())
    assert len(found) == 16 * 4
    assert [b(None, "Price").getMaxIter() for b in asked[0].values()] == [100, *[t["rounds"] for t in modeling.sample_trials()]]


@needs_tables
@pytest.mark.parametrize("name", ["fit_linear", "fit_ridge", "fit_lasso", "tscv_run", "temporal_search", "fit_final", "model_roundtrip", "batch_predict",
                                  "impute_train_only", "standardize", "one_hot", "fit_preprocessing"])
def test_query_agrees_with_sql(spark, name):
    message, *_ = compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert message is None, message


def test_every_model_query_has_sql():
    assert [k for k in QUERIES if k not in ORACLES] == []
