"""Feature matrices, train-only preprocessing, regressors, fold runs, search and final models with Spark ML.

Statistics that a model needs (medians, means, vocabularies) come from the training rows of a fold and are
stored in the stages of an ordinary PipelineModel, so a fitted model is one object that scores any frame.
"""
import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.bounded import lookup_join
from ..functions.quantiles import exact_medians
from ..functions.scalar import rows
from . import folds as fold_ops
from .checks import require_columns
from .evaluate import METRICS, fold_metrics
from .sparse import SparseAssembler
from .trees import SparseBoosting, SparseForest

INFREQUENT = "infrequent"


@dataclass(frozen=True)
class FeatureSet:
    numeric: list[str]
    boolean: list[str]
    categorical: list[str] = field(default_factory=lambda: list(fixed.CATEGORICAL_FEATURES))
    target: str = "Price"

    @property
    def numbers(self) -> list[str]:
        return [*self.numeric, *self.boolean]

    @property
    def columns(self) -> list[str]:
        return [*self.numbers, *self.categorical]


def full_feature_set(auxiliary: list[str]) -> FeatureSet:
    """The reference feature list: numbers, flags and the two prices of the other products."""
    return FeatureSet([*fixed.NUMERIC_FEATURES, *auxiliary], list(fixed.BOOLEAN_FEATURES))


def feature_matrix(df: DataFrame, features: FeatureSet, keep=("RideEstimativeID", "RideID", "CreateDate")) -> DataFrame:
    """Model columns with model types: numbers as double, flags as 0/1, categories as text."""
    require_columns(df, [*features.columns, features.target, *keep])
    return df.select(
        *keep, F.col(features.target).cast("double").alias(features.target),
        *[F.col(c).cast("double").alias(c) for c in features.numeric],
        *[F.col(c).cast("int").alias(c) for c in features.boolean],
        *[F.col(c).cast("string").alias(c) for c in features.categorical])


# ---- statistics fitted on training rows ---------------------------------------------------------

def median_row(train: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact median per column; a column without any value is absent."""
    return exact_medians(train, columns)


def most_frequent(train: DataFrame, column: str) -> DataFrame:
    """The most frequent value, ties to the smallest, as one row."""
    return (train.where(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("rows"))
            .orderBy(F.desc("rows"), column).limit(1))


def scale_row(train: DataFrame, medians: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation after imputation; a constant column is divided by 1."""
    filled = {c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items()}
    row = train.agg(*[F.struct(F.avg(e).alias("mean"), F.stddev_pop(e).alias("std")).alias(c)
                      for c, e in filled.items()]).first()
    return {c: (row[c]["mean"], row[c]["std"] or 1.0) for c in medians}


def standardized(df: DataFrame, column: str, median: float, mean: float, std: float) -> DataFrame:
    return df.withColumn(column, (F.coalesce(F.col(column), F.lit(median)) - mean) / std)


def vocabulary(train: DataFrame, column: str, min_rows: int = 1) -> DataFrame:
    """(value, label): values below `min_rows` training rows share one label."""
    counts = train.where(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("train_rows"))
    label = F.when(F.col("train_rows") < min_rows, F.lit(INFREQUENT)).otherwise(F.col(column).cast("string"))
    return counts.withColumn("label", label)


def encode_labels(df: DataFrame, vocab: DataFrame, column: str) -> DataFrame:
    """Replace a category by its label; a value never seen in training becomes null."""
    labels = vocab.select(column, F.col("label").alias("_label"))
    return lookup_join(df, labels, column).drop(column).withColumnRenamed("_label", column)


# ---- preprocessing as a fitted pipeline ---------------------------------------------------------

def preprocessing_stages(train: DataFrame, features: FeatureSet, scale: bool) -> list:
    """Stages for the training rows: literal imputation (and scaling), then numbers and one-hot labels in one sparse vector.

    An unseen category has no slot, so it encodes as zeros.
    """
    medians = median_row(train, features.numbers)
    used = [c for c in features.numbers if c in medians]
    scales = scale_row(train, {c: medians[c] for c in used}) if scale else {}

    def number(c):
        filled = f"coalesce(CAST({c} AS DOUBLE), {medians[c]!r}D)"
        if not scale:
            return f"{filled} AS {c}_f"
        mean, std = scales[c]
        return f"({filled} - ({mean!r}D)) / {std!r}D AS {c}_f"
    modes = {}
    for c in features.categorical:
        top = most_frequent(train, c).first()
        if top is not None:
            modes[c] = str(top[0]).replace("\\", "\\\\").replace("'", "\\'")
    texts = [f"coalesce(CAST({c} AS STRING), '{m}') AS {c}_f" for c, m in modes.items()]
    project = SQLTransformer(statement="SELECT *, " + ", ".join([*map(number, used), *texts]) + " FROM __THIS__")
    return [project, SparseAssembler(inputCols=[f"{c}_f" for c in used], labelCols=[f"{c}_f" for c in modes], outputCol="features")]


def fit_preprocessing(train: DataFrame, features: FeatureSet, scale: bool = True) -> PipelineModel:
    return Pipeline(stages=preprocessing_stages(train, features, scale)).fit(train)


def feature_count(prepared: DataFrame) -> int:
    return prepared.schema["features"].metadata["ml_attr"]["num_attrs"]


# ---- regressors ---------------------------------------------------------------------------------

def linear(prepared: DataFrame, target: str = "Price") -> LinearRegression:
    return LinearRegression(labelCol=target, regParam=0.0, solver="l-bfgs", maxIter=1000, tol=1e-9)


def ridge(prepared: DataFrame, target: str = "Price", alpha: float = 1.0) -> LinearRegression:
    """Penalty alpha on the sum of squares. The solver scales the label and averages the loss, hence the factor."""
    row = prepared.agg(rows().alias("n"), F.stddev_samp(target).alias("sd")).first()
    return LinearRegression(labelCol=target, elasticNetParam=0.0, regParam=alpha / row.n * (row.sd or 1.0),
                            standardization=False, solver="l-bfgs", maxIter=1000, tol=1e-9)


def lasso(prepared: DataFrame, target: str = "Price", alpha: float = 0.001) -> LinearRegression:
    return LinearRegression(labelCol=target, elasticNetParam=1.0, regParam=alpha, standardization=False,
                            solver="l-bfgs", maxIter=20000, tol=1e-6)


def random_forest(prepared: DataFrame, target: str = "Price", trees: int = 100, depth: int = 30) -> SparseForest:
    """All features at every split. Depth 30 is the deepest the library allows."""
    return SparseForest(labelCol=target, numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=fixed.SEED)


def boosted_trees(prepared: DataFrame, target: str = "Price", rounds: int = 100, **params) -> SparseBoosting:
    return SparseBoosting(labelCol=target, maxIter=rounds, seed=fixed.SEED, **params)


BASELINES = {"LinearRegression": linear, "Ridge": ridge, "Lasso": lasso}
ADVANCED = {"GradientBoosting": boosted_trees, "RandomForest": random_forest}


# ---- runs over time folds -----------------------------------------------------------------------

def prepare_fold(frame: DataFrame, window, features: FeatureSet, scale: bool, min_rows: int) -> tuple[DataFrame, DataFrame]:
    """Train and evaluation rows of a window, transformed by statistics of the training rows only.

    Kept in memory and on disk while its models are fitted; a lost block is rebuilt from the stored frame.
    """
    train, held = fold_ops.train_rows(frame, window), fold_ops.evaluation_rows(frame, window)
    if min_rows > 1:
        for c in features.categorical:
            vocab = vocabulary(train, c, min_rows)
            train, held = encode_labels(train, vocab, c), encode_labels(held, vocab, c)
    prepare = fit_preprocessing(train, features, scale)
    pick = [features.target, "features"]
    store = StorageLevel.MEMORY_AND_DISK
    return prepare.transform(train).select(*pick).persist(store), prepare.transform(held).select(*pick).persist(store)


def score_fold(labels: dict, train: DataFrame, held: DataFrame, estimators: dict, target: str) -> list[dict]:
    n_train = train.count()
    width = feature_count(train)
    out = []
    for name, build in estimators.items():
        predicted = build(train, target).fit(train).transform(held)
        m = fold_metrics(predicted.withColumn("_one", F.lit(1)), ["_one"], target).first()
        out.append({**labels, "ModelName": name, "TrainRows": n_train, "EvaluationRows": m.EvaluationRows,
                    "FeatureCount": width, **{k: m[k] for k in METRICS}})
    return out


def run_folds(frames: dict, windows: list, features: dict, estimators: dict, scale: bool = True,
              min_rows: int = fixed.ONE_HOT_MIN_ROWS, parallel: int = 4) -> list[dict]:
    """Fit every estimator on every category and window. Fits are distributed; a few run at the same time."""
    def one(job):
        category, w = job
        train, held = prepare_fold(frames[category], w, features[category], scale, min_rows)
        try:
            labels = {"CategoryID": category, "FoldName": w.name, "TrainStart": w.train_start, "TrainEnd": w.train_end,
                      "EvaluationStart": w.evaluation_start, "EvaluationEnd": w.evaluation_end}
            return score_fold(labels, train, held, estimators, features[category].target)
        finally:
            train.unpersist()
            held.unpersist()
    cv = [w for w in windows if w.split_type == "cv"]
    for frame in frames.values():  # before any fit: rides on both sides and empty sides
        fold_ops.guarded(fold_ops.split_summary(frame.select("RideID", "CreateDate", F.col("CreateDate").alias("Create")), cv)).agg(
            F.sum("ride_overlap")).collect()
    jobs = [(c, w) for c in frames for w in cv]
    with ThreadPoolExecutor(parallel) as pool:
        return [row for found in pool.map(one, jobs) for row in found]


FOLD_SCHEMA = ("CategoryID string, FoldName string, TrainStart date, TrainEnd date, EvaluationStart date, EvaluationEnd date, "
               "ModelName string, TrainRows bigint, EvaluationRows bigint, FeatureCount int, "
               "MAE double, RMSE double, MAPE double, R2 double")


# ---- search -------------------------------------------------------------------------------------

# Search space of the boosted trees.
SEARCH_SPACE = {
    "stepSize": (0.02, 0.2), "maxDepth": [4, 6, 8, 10, 12], "minInstancesPerNode": (20, 200, 10),
    "subsamplingRate": (0.6, 1.0, 0.05), "featureSubsetStrategy": (0.6, 1.0, 0.05), "minInfoGain": (0.0, 1.0),
    "rounds": (100, 400, 50),
}


def sample_trials(trials: int = fixed.SEARCH_TRIALS, seed: int = fixed.SEED, rounds=SEARCH_SPACE["rounds"]) -> list[dict]:
    """Seeded random parameter sets, the learning rate on a log scale."""
    rng = random.Random(seed)
    steps = lambda lo, hi, step: lo + step * rng.randint(0, round((hi - lo) / step))
    out = []
    for _ in range(trials):
        lo, hi = SEARCH_SPACE["stepSize"]
        out.append({
            "stepSize": math.exp(rng.uniform(math.log(lo), math.log(hi))),
            "maxDepth": rng.choice(SEARCH_SPACE["maxDepth"]),
            "minInstancesPerNode": int(steps(*SEARCH_SPACE["minInstancesPerNode"])),
            "subsamplingRate": round(steps(*SEARCH_SPACE["subsamplingRate"]), 2),
            "featureSubsetStrategy": str(round(steps(*SEARCH_SPACE["featureSubsetStrategy"]), 2)),
            "minInfoGain": rng.uniform(*SEARCH_SPACE["minInfoGain"]),
            "rounds": int(steps(*rounds)),
        })
    return out


def temporal_search(frames: dict, windows: list, features: dict, trials: list[dict], default_rounds: int = 100,
                    parallel: int = 4) -> list[dict]:
    """Every parameter set on every fold, next to the default; one row per (category, phase, trial, fold).

    A fold is prepared once and shared by all trials.
    """
    def with_params(params):
        return lambda prepared, target: boosted_trees(prepared, target, **params)
    estimators = {"default": with_params({"rounds": default_rounds})}
    estimators |= {f"trial-{i}": with_params(p) for i, p in enumerate(trials)}
    found = run_folds(frames, windows, features, estimators, scale=False, min_rows=1, parallel=parallel)
    for row in found:
        phase, _, number = row.pop("ModelName").partition("-")
        row.update(ModelName="GradientBoosting", Phase=phase, TrialNumber=int(number) if number else None,
                   ParamsJSON=json.dumps(trials[int(number)] if number else {"rounds": default_rounds}, sort_keys=True))
    return found


SEARCH_SCHEMA = FOLD_SCHEMA + ", Phase string, TrialNumber bigint, ParamsJSON string"


# ---- final models -------------------------------------------------------------------------------

def fit_final(frame: DataFrame, features: FeatureSet, build=boosted_trees, **params) -> PipelineModel:
    """Fit on all rows of the regime, holdout included."""
    stages = preprocessing_stages(frame, features, scale=False)
    return Pipeline(stages=[*stages, build(frame, features.target, **params)]).fit(frame)


def predict(model: PipelineModel, frame: DataFrame, features: FeatureSet) -> DataFrame:
    """Batch scoring under the feature contract."""
    require_columns(frame, features.columns)
    return model.transform(frame)


def save_and_check(model: PipelineModel, frame: DataFrame, features: FeatureSet, path: str) -> DataFrame:
    """Save, reload and score the first row; the prediction must be finite."""
    model.write().overwrite().save(path)
    first = frame.orderBy("CreateDate", "RideEstimativeID").limit(1)
    scored = predict(PipelineModel.load(path), first, features)
    p = F.col("prediction")
    finite = ~F.isnan(p) & (F.abs(p) < float("inf"))
    checked = F.when(finite, p).otherwise(F.raise_error(F.lit("prediction is not finite")).cast("double"))
    return scored.select(F.col(features.target).alias("ExampleTargetPrice"), checked.alias("ExamplePrediction"),
                         F.lit(True).alias("PredictionIsFinite"), F.lit(type(model).__name__).alias("LoadedArtifactClass"))
