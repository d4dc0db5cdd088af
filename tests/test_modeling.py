import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fareforge.operators import modeling
from fareforge.session import scratch_path


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        x1, x2, p = float(rng.normal()), float(rng.normal(3, 2)), str(rng.choice(list("ABC")))
        rows.append((i, i, None if i % 10 == 0 else x1, x2, bool(i % 2), p, 10 + 3 * x1 - x2 + (p == "A") * 4 + float(rng.normal(0, 0.1))))
    df = spark.createDataFrame(rows, "RideEstimativeID int, RideID int, x1 double, x2 double, flag boolean, ProductID string, Price double")
    df = df.withColumn("CreateDate", F.expr("date_add(date'2021-11-01', RideID % 200)"))
    features = modeling.FeatureSet(["x1", "x2"], ["flag"])
    return modeling.feature_matrix(df, features), features


def test_unseen_category_is_all_zero(spark, data):
    df, features = data
    model = modeling.fit_preprocessing(df.where("ProductID <> 'C'"), features)
    width = {
        r.ProductID: sum(r.v[3:]) for r in model.transform(df).select("ProductID", vector_to_array("features").alias("v")).collect()}
    assert width == {"A": 1.0, "B": 1.0, "C": 0.0}


def test_median_is_exact_and_from_training_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None), (9.0, None)], "a double, b double")
    assert modeling.median_row(df, ["a", "b"]) == {"a": 3.0}


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert modeling.scale_row(df, {"a": 2.0, "b": 5.0}) == {"a": (2.0, 1.0), "b": (5.0, 1.0)}


def test_vocabulary_and_mode(spark):
    train = spark.createDataFrame([("A",)] * 6 + [("B",)] * 4 + [("C",)] * 5, "p string")
    held = spark.createDataFrame([("A",), ("B",), ("D",)], "p string")
    out = modeling.encode_labels(held, modeling.vocabulary(train, "p", 5), "p")
    assert sorted(r.p or "" for r in out.collect()) == ["", "A", "infrequent"]
    tie = spark.createDataFrame([("b",), ("a",), (None,)], "p string")
    assert modeling.most_frequent(tie, "p").first().p == "a"


def test_ridge_matches_closed_form(spark, data):
    df, features = data
    prepared = modeling.fit_preprocessing(df, features).transform(df)
    fitted = modeling.ridge(prepared, alpha=7.0).fit(prepared)
    pdf = prepared.select("Price", vector_to_array("features").alias("v")).toPandas()
    x, y = np.vstack(pdf["v"]), pdf["Price"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(x.shape[1]), xc.T @ yc)
    np.testing.assert_allclose(fitted.coefficients.toArray(), want, atol=1e-4)


def test_fold_run_and_final_model(spark, data):
    from fareforge.operators import folds
    df, features = data
    windows = folds.split_windows(df)
    found = modeling.run_folds({"A": df}, windows[:1] + windows[3:4], {"A": features}, modeling.BASELINES)
    assert len(found) == 6 and all(r["R2"] > 0.6 for r in found)
    model = modeling.fit_final(df, features, modeling.boosted_trees, rounds=2)
    row = modeling.save_and_check(model, df, features, scratch_path(spark, "m")).first()
    assert row.PredictionIsFinite and np.isfinite(row.ExamplePrediction)
    with pytest.raises(ValueError):
        modeling.predict(model, df.drop("x1"), features)


def test_search_space_is_seeded():
    a, b = modeling.sample_trials(15), modeling.sample_trials(15)
    assert a == b and len({t["stepSize"] for t in a}) == 15
    assert all(0.02 <= t["stepSize"] <= 0.2 and t["rounds"] in range(100, 401, 50) and t["minInstancesPerNode"] % 10 == 0 for t in a)
