"""Sparse assembly with the vocabulary on storage, and medians from two passes."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fareforge.functions import quantiles
from fareforge.operators import modeling, sparse


@pytest.fixture(scope="module")
def wide(spark):
    """3,000 rows, 1,500 labels that occur 1 to 3 times, one of them with a quote, and a null label."""
    labels = [f"p{i % 1500}" if i % 1500 or i else "o'ne" for i in range(2250)] + [f"p{i}" for i in range(749)] + [None]
    df = spark.createDataFrame([(i, float(i % 7), i % 2, labels[i]) for i in range(3000)], "RideEstimativeID int, x double, flag int, ProductID string")
    return df, modeling.FeatureSet(["x"], ["flag"])


def test_schema_and_model_hold_no_labels(spark, wide):
    df, features = wide
    model = modeling.fit_preprocessing(df, features, scale=False)
    out = model.transform(df)
    assert modeling.feature_count(out) == 2 + 1501
    about = out.schema["features"].json()
    assert len(about) < 2000 and "p1499" not in out._jdf.queryExecution().analyzed().toString()
    assert not any(hasattr(s, "labels") for s in model.stages)
    v = F.unwrap_udt("features")
    row = out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.filter(v["indices"], lambda i: i >= 2)[0]).alias("slots"),
                  F.max(v["size"]).alias("width"), F.max(F.array_max(v["indices"])).alias("last"), F.max(F.size(v["indices"])).alias("set")).first()
    assert tuple(row) == (3000, 1501, 1503, 1502, 3)


def test_slots_are_by_frequency_then_label(spark):
    df = spark.createDataFrame([(p,) for p in "bbaaadcc"], "p string")
    path, starts = sparse.ordered_labels(df, "p")
    model = sparse.SparseAssemblerModel()._set(inputCols=[], labelCols=["p"], outputCol="v", tables=[path], starts=[starts])
    out = model.transform(spark.createDataFrame([(p,) for p in "abcdz"], "p string")).select("p", F.unwrap_udt("v")["indices"].alias("i"))
    assert {r.p: list(r.i) for r in out.collect()} == {"a": [0], "b": [1], "c": [2], "d": [3], "z": []}


def test_a_missing_number_stops_the_run(spark):
    df = spark.createDataFrame([(float("nan"), "a")], "x double, p string")
    model = sparse.SparseAssembler(inputCols=["x"], labelCols=["p"]).fit(df)
    with pytest.raises(Exception, match="missing number"):
        model.transform(df).select("features").collect()


@pytest.mark.parametrize("n", [1, 2, 5001, 40_000])
def test_medians_are_exact(spark, n):
    rng = np.random.default_rng(n)
    d = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3000, n).astype(float), "c": np.where(rng.random(n) < 0.3, np.nan, rng.lognormal(0, 3, n)),
                      "d": rng.integers(0, 3, n).astype(float), "e": np.full(n, np.nan), "f": np.where(rng.random(n) < 0.9, 1.0, rng.random(n))})
    want = {k: v for k, v in d.median().to_dict().items() if not np.isnan(v)}
    assert quantiles.exact_medians(spark.createDataFrame(d).repartition(5), list(d.columns)) == want
