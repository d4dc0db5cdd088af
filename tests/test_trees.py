"""Trees over sparse vectors: every split against all candidates, boosting against its rule, and wide vocabularies."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel

from fareforge.operators import modeling, trees
from fareforge.session import scratch_path

RNG = np.random.default_rng(3)
N = 300
X = np.array([RNG.integers(0, 20, N), RNG.integers(0, 3, N)])
LABELS = RNG.integers(2, 12, (1, N)).astype(np.int32)
Y = RNG.normal(size=N) + (LABELS[0] == 5) * 3 + (X[0] > 12)
CUTS = [np.arange(19) + 0.5, np.arange(2) + 0.5]


def gain(y, w, right):
    one, two = w * right, w * ~right
    return (one * y).sum() ** 2 / one.sum() + (two * y).sum() ** 2 / two.sum() - (w * y).sum() ** 2 / w.sum()


def candidates(w):
    for right in [X[f] > c for f in (0, 1) for c in CUTS[f]] + [LABELS[0] == s for s in range(2, 12)]:
        if (w * right).sum() and (w * ~right).sum():
            yield right


@pytest.mark.parametrize("cells", [1 << 20, 0])
def test_every_node_takes_the_best_split(monkeypatch, cells):
    monkeypatch.setattr(trees, "CELLS", cells)
    w = np.bincount(RNG.integers(0, N, N), minlength=N)
    tree = trees.grow(Y, w, X.astype(np.uint8), LABELS, CUTS, [10], 30)
    y = Y - np.average(Y, weights=w)

    def walk(node, held):
        f = tree["feature"][node]
        best = max((gain(y, held, r) for r in candidates(held)), default=0.0)
        if f < 0:
            assert best < 1e-8
            assert tree["value"][node] == pytest.approx(np.average(Y, weights=held))
            return 1
        right = X[f] > tree["cut"][node] if f < 2 else LABELS[0] == f
        assert gain(y, held, right) == pytest.approx(best)
        return walk(tree["left"][node], held * ~right) + walk(tree["left"][node] + 1, held * right)
    assert 2 * walk(0, w) - 1 == len(tree["value"]) > 100


def test_limits_of_a_tree():
    one = np.ones(N)
    small = trees.grow(Y, one, X.astype(np.uint8), LABELS, CUTS, [10], 3, least=20)
    leaf = trees.values_at({**small, "value": np.arange(len(small["value"]))}, X.astype(float), LABELS)
    assert len(small["value"]) <= 15 and np.bincount(leaf)[np.unique(leaf)].min() >= 20
    some = trees.grow(Y, one, X.astype(np.uint8), LABELS, CUTS, [10], 4, share=0.5, rng=np.random.default_rng(1))
    assert len(some["value"]) > 3
    assert len(trees.grow(np.ones(N), one, X.astype(np.uint8), LABELS, CUTS, [10], 4)["value"]) == 1


def test_subsets_of_slots_have_the_asked_size():
    rng = np.random.default_rng(2)
    which, rest = trees.drawn(rng, 50, 4, 100, 0.3)
    assert (which.sum(axis=1) + rest == 30).all()
    node = np.repeat(np.arange(50), 96)  # every label slot occurs in every node
    assert (np.bincount(node, trees.drawn_labels(rng, node, 96, rest)) == rest).all()


@pytest.fixture(scope="module")
def prepared(spark):
    """2,000 rows over 1,000 products, of which two move the price."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(2000):
        x, p = float(rng.normal()), int(rng.integers(0, 1000)) if i % 4 else int(rng.integers(0, 2))
        rows.append((i, x, int(rng.integers(0, 2)), f"p{p}", 5 + 2 * x + 10 * (p == 0) - 6 * (p == 1)))
    df = spark.createDataFrame(rows, "RideEstimativeID int, x double, flag int, ProductID string, Price double").repartition(3)
    return modeling.fit_preprocessing(df, modeling.FeatureSet(["x"], ["flag"]), scale=False).transform(df).select("RideEstimativeID", "Price", "features").cache()


@pytest.mark.parametrize("build,most", [(lambda d: modeling.random_forest(d, trees=10), 1.0), (lambda d: modeling.boosted_trees(d, rounds=40), 1.0)])
def test_fits_cost_tasks_not_width(spark, prepared, build, most):
    """A wide vocabulary is learnt, the model saved and loaded, and no Spark job is run per level or round."""
    track = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("trees", "fit")
    try:
        model = build(prepared).fit(prepared)
        jobs = len(track.getJobIdsForGroup("trees"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20
    path = scratch_path(spark, "model")
    PipelineModel([model]).write().save(path)
    rows = PipelineModel.load(path).transform(prepared).orderBy("RideEstimativeID").select("Price", "prediction").collect()
    assert rows == model.transform(prepared).orderBy("RideEstimativeID").select("Price", "prediction").collect()
    assert np.sqrt(np.mean([(r.Price - r.prediction) ** 2 for r in rows])) < most


def test_boosting_follows_spark(spark, prepared):
    """One round is a tree on the target; each further round adds a tenth of a tree on twice the residuals."""
    one = modeling.boosted_trees(prepared, rounds=1).fit(prepared)
    two = modeling.boosted_trees(prepared, rounds=2).fit(prepared)
    first, both = (list(trees.stored_trees(m.getOrDefault(m.path))) for m in (one, two))
    assert [w for w, _ in both] == [1.0, 0.1]
    assert all((first[0][1][c] == both[0][1][c]).all() for c in trees.NODES)
    error = {r.RideEstimativeID: r.Price - r.prediction for r in one.transform(prepared).collect()}
    step = {r.RideEstimativeID: r.prediction for r in two.transform(prepared).collect()}
    before = {r.RideEstimativeID: r.prediction for r in one.transform(prepared).collect()}
    added = np.array([(step[i] - before[i]) for i in sorted(error)])
    left = np.array([error[i] for i in sorted(error)])
    for value in np.unique(added.round(9)):  # a leaf holds the mean of twice its residuals
        here = added.round(9) == value
        assert value == pytest.approx(0.1 * 2 * left[here].mean(), abs=1e-8)
