"""Model preparation, training and scoring."""
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..functions.scalar import count_if, rounded
from ..operators import evaluate, folds, history, modeling, moments
from ..operators.model_store import ModelStore
from ..operators.moments import Penalty
from ..session import materialize
from . import views as v
from .registry import query, rnd
from .temporal import calendar_sql

CALENDAR = [t + p for t in ("Schedule", "Create") for p in ("Hour", "DayOfWeek", "Month", "Quarter")]
NUMERIC = ["WaitingTime", "Fee", "OriginLat", "DestinationLat", *CALENDAR, "UserPriorRideCount", "UserPriorPaidPriceMean",
           "UserPriorCategoryRideCount", "UserPriorCategoryPriceMean"]
BOOLEAN = ["ScheduleIsHolidayBR", "CreateIsHolidayBR", "FareIDWasImputed", "WaitingTimeWasCapped"]


def feature_set(category):
    """The feature list of the reference over the columns that exist here, without the own price."""
    return modeling.FeatureSet([*NUMERIC, *[f"Price_{p}" for p in v.TARGETS if p != category]], BOOLEAN)


def _frame(spark, sf_dir):
    """The feature layer of the regime, stored once per plan."""
    layer = history.build_features(v.curated_layer(spark, sf_dir), v.TARGETS, "CategoryID", ("Schedule", "Create"), *v.YEARS)
    regime = layer.where(F.col("Create") >= F.lit(v.REGIME).cast("timestamp_ntz")).withColumn("CreateDate", F.to_date("Create"))
    return materialize(regime, "model-frame")


def _setup(spark, sf_dir):
    frame = _frame(spark, sf_dir)
    windows = folds.split_windows(frame, v.CONFIG)
    features = {c: feature_set(c) for c in v.TARGETS}
    frames = {c: modeling.feature_matrix(frame.where(F.col("CategoryID") == c), features[c]) for c in v.TARGETS}
    return frames, windows, features


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


REGIME_ROWS = """"Create" >= TIMESTAMP '1999-01-01'"""
CAL = f"{calendar_sql('Schedule')}, {calendar_sql('Create')}"


@query("feature_matrix", f""", fxm AS (SELECT *, CAST("Create" AS DATE) AS CreateDate, {CAL} FROM vx WHERE CategoryID = 'ECONOMY' AND {REGIME_ROWS})
SELECT RideEstimativeID, RideID, CreateDate, {', '.join(f"{rnd(c)} AS {c}" for c in ['Price', *NUMERIC, 'Price_STANDARD', 'Price_PROMO'])},
       {', '.join(f'CAST({c} AS INTEGER) AS {c}' for c in BOOLEAN)}, CAST(ProductID AS VARCHAR) AS ProductID FROM fxm""")
def feature_matrix(spark, sf_dir):
    frame = _frame(spark, sf_dir).where("CategoryID = 'ECONOMY'")
    out = modeling.feature_matrix(frame, feature_set("ECONOMY"))
    return out.withColumns({c: rounded(F.col(c)) for c in ["Price", *NUMERIC, "Price_STANDARD", "Price_PROMO"]})


HIST = "UserPriorCategoryPriceMean"


FOLDS = """, wc AS (SELECT * FROM fw WHERE split_type = 'cv'),
bc AS (SELECT vx.*, CAST("Create" AS DATE) AS d FROM vx),
tc AS (SELECT bc.*, wc.number AS FoldNumber FROM bc, wc WHERE d BETWEEN train_start AND train_end),
ec AS (SELECT bc.*, wc.number AS FoldNumber FROM bc, wc WHERE d BETWEEN evaluation_start AND evaluation_end)"""


def _fold_sides(spark, sf_dir):
    """(number, training rows, evaluation rows) of every cv window."""
    source = ["RideEstimativeID", "RideID", "CategoryID", "ProductID", "UserID", "Price", "Create"]
    rows_ = v.with_category_history(spark, sf_dir, source)
    frame = materialize(folds.temporal_frame(rows_, ["RideEstimativeID", "ProductID", HIST, "Create"], v.REGIME), "folds")
    return [(w.number, folds.train_rows(frame, w), folds.evaluation_rows(frame, w))
            for w in folds.split_windows(frame, v.CONFIG) if w.split_type == "cv"]


def _over_folds(spark, sf_dir, one):
    return _union([one(train, held).withColumn("FoldNumber", F.lit(number)) for number, train, held in _fold_sides(spark, sf_dir)])


def _imputed(train, held):
    median = modeling.median_row(train, [HIST])[HIST]
    return held.select("RideEstimativeID", rounded(F.coalesce(F.col(HIST), F.lit(median))).alias(HIST))


def _standardized(train, held):
    medians = modeling.median_row(train, [HIST])
    mean, std = modeling.scale_row(train, medians)[HIST]
    out = modeling.standardized(held.select("RideEstimativeID", HIST), HIST, medians[HIST], mean, std)
    return out.withColumn(HIST, rounded(F.col(HIST)))


def _one_hot(train, held):
    vocab = modeling.vocabulary(train, "ProductID", 5)
    return modeling.encode_labels(held.select("RideEstimativeID", "ProductID"), vocab, "ProductID")


IMPUTE_TRAIN_ONLY_SQL = f"""{FOLDS}, md AS (SELECT FoldNumber, quantile_cont({HIST}, 0.5) AS m FROM tc GROUP BY 1)
SELECT ec.FoldNumber, RideEstimativeID, {rnd(f'coalesce({HIST}, m)')} AS {HIST} FROM ec LEFT JOIN md ON md.FoldNumber = ec.FoldNumber"""


@query("impute_train_only", IMPUTE_TRAIN_ONLY_SQL)
@query("impute_train_only_folds", IMPUTE_TRAIN_ONLY_SQL)
def impute_train_only_folds(spark, sf_dir):
    return _over_folds(spark, sf_dir, _imputed)


STANDARDIZE_SQL = f"""{FOLDS}, md AS (SELECT FoldNumber, quantile_cont({HIST}, 0.5) AS m FROM tc GROUP BY 1),
st AS (SELECT tc.FoldNumber, any_value(m) AS m, avg(coalesce({HIST}, m)) AS mean, stddev_pop(coalesce({HIST}, m)) AS sd
       FROM tc JOIN md ON md.FoldNumber = tc.FoldNumber GROUP BY 1)
SELECT ec.FoldNumber, RideEstimativeID, {rnd(f'(coalesce({HIST}, m) - mean) / sd')} AS {HIST}
FROM ec LEFT JOIN st ON st.FoldNumber = ec.FoldNumber"""


@query("standardize", STANDARDIZE_SQL)
@query("standardize_folds", STANDARDIZE_SQL)
def standardize_folds(spark, sf_dir):
    return _over_folds(spark, sf_dir, _standardized)


@query("mode_impute", """
, md AS (SELECT FareID FROM ve WHERE FareID IS NOT NULL AND trim(FareID) <> '' GROUP BY 1 ORDER BY count(*) DESC, FareID LIMIT 1)
SELECT RideEstimativeID, coalesce(CASE WHEN trim(FareID) <> '' THEN FareID END, (SELECT FareID FROM md)) AS FareID FROM ve""")
def mode_impute(spark, sf_dir):
    fare = F.when(F.trim("FareID") != "", F.col("FareID"))
    df = v.estimates(spark, sf_dir).select("RideEstimativeID", fare.alias("FareID"))
    mode = modeling.most_frequent(df, "FareID").select("FareID").scalar()
    return df.withColumn("FareID", F.coalesce(F.col("FareID"), mode))


ONE_HOT_SQL = f"""{FOLDS}, vo AS (SELECT FoldNumber, ProductID, count(*) AS n FROM tc GROUP BY 1, 2)
SELECT ec.FoldNumber, RideEstimativeID, CASE WHEN n < 5 THEN 'infrequent' WHEN n >= 5 THEN CAST(ec.ProductID AS VARCHAR) END AS ProductID
FROM ec LEFT JOIN vo ON vo.FoldNumber = ec.FoldNumber AND vo.ProductID = ec.ProductID"""


@query("one_hot", ONE_HOT_SQL)
@query("one_hot_folds", ONE_HOT_SQL)
def one_hot_folds(spark, sf_dir):
    return _over_folds(spark, sf_dir, _one_hot)


MODELLED = "CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO')"
WIDTH_SQL = " + ".join(f"CAST(count({c}) > 0 AS BIGINT)" for c in [*NUMERIC, *BOOLEAN])
#: Columns in use and vocabulary of every fold, and the scale of the history mean.
PREPARED_SQL = f"""{FOLDS}, md AS (SELECT CategoryID, FoldNumber, quantile_cont({HIST}, 0.5) AS med FROM tc WHERE {MODELLED} GROUP BY 1, 2),
wd AS (SELECT CategoryID, FoldNumber, count(*) AS train_rows, {WIDTH_SQL}
         + {" + ".join(f"CAST(CategoryID <> '{p}' AND count(Price_{p}) > 0 AS BIGINT)" for p in v.TARGETS)} AS numbers,
         count(DISTINCT ProductID) AS labels FROM (SELECT *, {calendar_sql('Schedule')}, {calendar_sql('Create')} FROM tc) WHERE {MODELLED} GROUP BY 1, 2),
sc AS (SELECT tc.CategoryID, tc.FoldNumber, any_value(med) AS med, avg(coalesce({HIST}, med)) AS mean, stddev_pop(coalesce({HIST}, med)) AS sd,
         covar_pop(coalesce({HIST}, med), Price) AS c, avg(Price) AS ybar, count(*) AS n, min("CreateDate") AS first_day, max("CreateDate") AS last_day
       FROM (SELECT *, d AS "CreateDate" FROM tc) tc JOIN md ON md.CategoryID = tc.CategoryID AND md.FoldNumber = tc.FoldNumber GROUP BY 1, 2)"""


@query("fit_preprocessing", f"""{PREPARED_SQL}, vo AS (SELECT DISTINCT CategoryID, FoldNumber, ProductID FROM tc WHERE {MODELLED})
SELECT 'fold_' || ec.FoldNumber AS FoldName, ec.RideEstimativeID, ec.CategoryID, CAST(numbers + labels AS INTEGER) AS width,
  {rnd(f'(coalesce({HIST}, med) - mean) / sd')} AS scaled, CAST(vo.ProductID IS NOT NULL AS INTEGER) AS labels_set
FROM ec JOIN wd ON wd.CategoryID = ec.CategoryID AND wd.FoldNumber = ec.FoldNumber
JOIN sc ON sc.CategoryID = ec.CategoryID AND sc.FoldNumber = ec.FoldNumber
LEFT JOIN vo ON vo.CategoryID = ec.CategoryID AND vo.FoldNumber = ec.FoldNumber AND vo.ProductID = ec.ProductID""")
def fit_preprocessing(spark, sf_dir):
    """Prepared evaluation rows of every fold: width of the assembled vector, a scaled number, and how many labels are set."""
    frames, windows, features = _setup(spark, sf_dir)

    def one(job):
        c, window = job
        train, held = folds.train_rows(frames[c], window), folds.evaluation_rows(frames[c], window)
        model = modeling.fit_preprocessing(train, features[c])
        used = [name[:-2] for name in model.stages[-1].getInputCols()]
        x = F.unwrap_udt("features")  # only what is not zero is stored
        at = F.array_position(x["indices"], used.index(HIST)).cast("int")
        return model.transform(held).select(
            F.lit(window.name).alias("FoldName"), "RideEstimativeID", F.lit(c).alias("CategoryID"), x["size"].alias("width"),
            rounded(F.coalesce(F.get(x["values"], at - 1), F.lit(0.0))).alias("scaled"),
            F.size(F.filter(x["indices"], lambda i: i >= len(used))).alias("labels_set"))
    jobs = [(c, w) for c in frames for w in windows if w.split_type == "cv"]
    with ThreadPoolExecutor(4) as pool:
        return _union(list(pool.map(one, jobs)))


def _modelled(spark, sf_dir):
    """Rows of the modelled categories and the windows, for models of the history mean alone."""
    frame = _frame(spark, sf_dir)
    windows = folds.split_windows(frame, v.CONFIG)
    kept = frame.where(F.col("CategoryID").isin(v.TARGETS)).select("RideEstimativeID", "RideID", "CategoryID", "Create", "CreateDate", HIST, "Price")
    return kept, windows


FOLD_COLUMNS = [c.split()[0] for c in modeling.FOLD_SCHEMA.split(", ")]
NO_PENALTY = {"LinearRegression": Penalty("LinearRegression"), "Ridge": Penalty("Ridge", 1.0), "Lasso": Penalty("Lasso", 0.001)}


def _as_frame(spark, found, schema=modeling.FOLD_SCHEMA):
    table = spark.createDataFrame([[r[c.split()[0]] for c in schema.split(", ")] for r in found], schema)
    return table.withColumns({m: rounded(F.col(m)) for m in evaluate.METRICS})


def _weight_sql(kind: str, alpha: str) -> str:
    """Closed form of one standardised column."""
    return f"""CASE {kind} WHEN 'Ridge' THEN c / sd * n / (n + {alpha})
      WHEN 'Lasso' THEN sign(c) * greatest(abs(c / sd) - {alpha}, 0) ELSE c / sd END"""


def _folds_sql(penalties: dict) -> str:
    """Fold metrics of each named penalty on the history mean, by closed form."""
    values = ", ".join(f"('{name}', '{p.kind}', CAST({p.alpha} AS DOUBLE))" for name, p in penalties.items())
    return f"""{PREPARED_SQL}, pn(name, kind, alpha) AS (VALUES {values}),
wt AS (SELECT sc.*, name, kind, alpha, {_weight_sql('kind', 'alpha')} AS w FROM sc, pn),
er AS (SELECT wt.CategoryID, wt.FoldNumber, name, kind, alpha, n, Price AS y, Price - (ybar + w * (coalesce({HIST}, med) - mean) / sd) AS e
       FROM ec JOIN wt ON wt.CategoryID = ec.CategoryID AND wt.FoldNumber = ec.FoldNumber),
fm AS (SELECT CategoryID, FoldNumber, name, kind, alpha, CAST(any_value(n) AS BIGINT) AS TrainRows, count(*) AS EvaluationRows,
         {rnd('avg(abs(e))')} AS MAE, {rnd('sqrt(avg(e * e))')} AS RMSE, {rnd('100 * avg(abs(e) / greatest(abs(y), 2.220446049250313e-16))')} AS MAPE,
         {rnd('1 - sum(e * e) / (var_pop(y) * count(*))')} AS R2 FROM er GROUP BY ALL)"""


FOLD_ROWS_SQL = """SELECT CategoryID, 'fold_' || FoldNumber AS FoldName, train_start AS TrainStart, train_end AS TrainEnd,
  evaluation_start AS EvaluationStart, evaluation_end AS EvaluationEnd, name AS ModelName, TrainRows, EvaluationRows, 1::INTEGER AS FeatureCount,
  MAE, RMSE, MAPE, R2 FROM fm JOIN wc ON wc.number = fm.FoldNumber"""


def _fit_query(name: str, model: str):
    @query(name, _folds_sql({model: NO_PENALTY[model]}) + FOLD_ROWS_SQL)
    def fit(spark, sf_dir):
        frame, windows = _modelled(spark, sf_dir)
        return _as_frame(spark, moments.fold_rows(frame, [HIST], None, windows, {model: NO_PENALTY[model]}))
    return fit


fit_linear = _fit_query("fit_linear", "LinearRegression")
fit_ridge = _fit_query("fit_ridge", "Ridge")
fit_lasso = _fit_query("fit_lasso", "Lasso")


def _tree_sql(model: str) -> str:
    return f"""{PREPARED_SQL}, ev AS (SELECT CategoryID, FoldNumber, count(*) AS n, max(Price) - min(Price) AS spread FROM ec WHERE {MODELLED} GROUP BY 1, 2)
SELECT wd.CategoryID, 'fold_' || wd.FoldNumber AS FoldName, train_start AS TrainStart, train_end AS TrainEnd, evaluation_start AS EvaluationStart,
  evaluation_end AS EvaluationEnd, '{model}' AS ModelName, train_rows AS TrainRows, ev.n AS EvaluationRows, CAST(numbers + labels AS INTEGER) AS FeatureCount,
  spread > 0 AS UsableMetrics
FROM wd JOIN ev ON ev.CategoryID = wd.CategoryID AND ev.FoldNumber = wd.FoldNumber JOIN wc ON wc.number = wd.FoldNumber"""


def _tree_rows(spark, sf_dir, estimators):
    """Fold rows of tree models; metrics are usable if they are finite and MAE is not above RMSE."""
    frames, windows, features = _setup(spark, sf_dir)
    found = modeling.run_folds(frames, windows, features, estimators, False, 1)
    table = spark.createDataFrame([[r[c] for c in FOLD_COLUMNS] for r in found], modeling.FOLD_SCHEMA)
    whole = [F.col(m).isNotNull() & ~F.isnan(m) & (F.abs(m) < float("inf")) for m in ("MAE", "RMSE", "MAPE")]
    usable = whole[0] & whole[1] & whole[2] & (F.col("MAE") <= F.col("RMSE") + 1e-9) & (F.col("R2") <= 1)
    return table.withColumn("UsableMetrics", usable).drop(*evaluate.METRICS)


@query("fit_random_forest", _tree_sql("RandomForest"))
def fit_random_forest(spark, sf_dir):
    return _tree_rows(spark, sf_dir, {"RandomForest": modeling.random_forest})


@query("fit_gbt", _tree_sql("GradientBoosting"))
def fit_gbt(spark, sf_dir):
    return _tree_rows(spark, sf_dir, {"GradientBoosting": modeling.boosted_trees})


MEANS_SQL = ", ".join(f"{rnd(f'avg({m})')} AS Mean{m}, {rnd(f'stddev_samp({m})')} AS Std{m}" for m in evaluate.METRICS)


def _rounded_summary(table, groups):
    summary = evaluate.metric_summary(table, groups)
    return summary.withColumns({f"{k}{m}": rounded(F.col(f"{k}{m}")) for m in evaluate.METRICS for k in ("Mean", "Std")})


@query("tscv_run", _folds_sql(NO_PENALTY) + f"SELECT CategoryID, name AS ModelName, count(*) AS Folds, {MEANS_SQL} FROM fm GROUP BY 1, 2")
def tscv_run(spark, sf_dir):
    """Mean and deviation over folds per category and linear model; all folds and models from one pass of sums."""
    frame, windows = _modelled(spark, sf_dir)
    return _rounded_summary(_as_frame(spark, moments.fold_rows(frame, [HIST], None, windows, NO_PENALTY)), ["CategoryID", "ModelName"])


TRIALS = moments.sample_penalties()
NAMED = {"default": Penalty("Ridge", 1.0), **{f"trial-{i}": p for i, p in enumerate(TRIALS)}}
SEARCH_SQL = _folds_sql(NAMED) + f""", sm AS (SELECT CategoryID, split_part(name, '-', 1) AS Phase, TRY_CAST(split_part(name, '-', 2) AS BIGINT) AS TrialNumber,
  kind AS ModelName, alpha AS Alpha, count(*) AS Folds, {MEANS_SQL} FROM fm GROUP BY name, kind, alpha, CategoryID),
rk AS (SELECT *, CASE WHEN Phase = 'trial' THEN row_number() OVER (PARTITION BY CategoryID, Phase ORDER BY MeanRMSE, TrialNumber) = 1 END AS IsBestTrial FROM sm)"""


def _summary(spark, frame, windows):
    found = moments.search(frame, [HIST], None, windows, TRIALS)
    table = _as_frame(spark, found, modeling.SEARCH_SCHEMA)
    alpha = F.get_json_object("ParamsJSON", "$.alpha").cast("double").alias("Alpha")
    return _rounded_summary(table.select("*", alpha), ["CategoryID", "Phase", "TrialNumber", "ModelName", "Alpha"])


@query("temporal_search", SEARCH_SQL + """ SELECT * FROM rk""")
def temporal_search(spark, sf_dir):
    """All penalties next to the default on all folds, from one pass of sums, with the best one flagged."""
    summary = _summary(spark, *_modelled(spark, sf_dir))
    best = evaluate.trial_ranking(summary.where("Phase = 'trial'"))
    return best.unionByName(summary.where("Phase = 'default'"), allowMissingColumns=True)


def _final(spark, sf_dir):
    """(models, record, rows): per category the best penalty fitted on the whole regime, fitted once and then loaded."""
    frame, windows = _modelled(spark, sf_dir)
    frame = materialize(frame, "modelled")

    def fit():
        ranked = evaluate.trial_ranking(_summary(spark, frame, windows).where("Phase = 'trial'"))
        best = {r.CategoryID: Penalty(r.ModelName, r.Alpha) for r in ranked.where("IsBestTrial").collect()}
        models = moments.fit_all(frame, [HIST], None, best)
        parts = spark.createDataFrame([(c, p.kind, p.alpha, models[c].width) for c, p in best.items()],
                                      "CategoryID string, ModelName string, Alpha double, FeatureCount int")
        return models, moments.training_record(frame).join(parts, "CategoryID")

    settings = {"numbers": [HIST], "label": None, "trials": [(p.kind, p.alpha) for p in TRIALS], "windows": [str(w) for w in windows]}
    models, record, _ = ModelStore(spark).get(frame, settings, fit)
    return models, record, frame


REGIME_SQL = f""", ar AS (SELECT *, CAST("Create" AS DATE) AS d FROM vx WHERE {MODELLED} AND {REGIME_ROWS}),
am AS (SELECT CategoryID, quantile_cont({HIST}, 0.5) AS med FROM ar GROUP BY 1),
fs AS (SELECT ar.CategoryID, any_value(med) AS med, avg(coalesce({HIST}, med)) AS mean, stddev_pop(coalesce({HIST}, med)) AS sd,
         covar_pop(coalesce({HIST}, med), Price) AS c, avg(Price) AS ybar, count(*) AS n, min(d) AS first_day, max(d) AS last_day
       FROM ar JOIN am ON am.CategoryID = ar.CategoryID GROUP BY 1),
fw1 AS (SELECT fs.*, rk.ModelName, rk.Alpha, {_weight_sql('rk.ModelName', 'rk.Alpha')} AS w FROM fs JOIN rk ON rk.CategoryID = fs.CategoryID AND rk.IsBestTrial),
pr AS (SELECT ar.RideEstimativeID, ar.CategoryID, ar.d, Price, ybar + w * (coalesce({HIST}, med) - mean) / sd AS p
       FROM ar JOIN fw1 ON fw1.CategoryID = ar.CategoryID)"""


@query("fit_final", SEARCH_SQL + REGIME_SQL + f"""
SELECT CategoryID, ModelName, Alpha, n AS TrainingRows, first_day AS TrainingStartDate, last_day AS TrainingEndDate, 1::INTEGER AS FeatureCount,
  {rnd('w')} AS Weight, {rnd('ybar')} AS Intercept FROM fw1""")
def fit_final(spark, sf_dir):
    """One model per category on the whole regime, with the record of what it was trained on and its weights."""
    models, record, _ = _final(spark, sf_dir)
    weights = spark.createDataFrame([(c, m.weights[0], m.intercept) for c, m in models.items()], "CategoryID string, Weight double, Intercept double")
    return record.join(weights.withColumns({c: rounded(F.col(c)) for c in ("Weight", "Intercept")}), "CategoryID")


@query("model_roundtrip", SEARCH_SQL + REGIME_SQL + f""", ex AS (SELECT *, row_number() OVER (PARTITION BY CategoryID ORDER BY d, RideEstimativeID) AS k FROM pr)
SELECT CategoryID, {rnd('max(Price) FILTER (WHERE k = 1)')} AS ExampleTargetPrice, {rnd('max(p) FILTER (WHERE k = 1)')} AS ExamplePrediction,
  count(*) AS RowsScored, CAST(count(*) FILTER (WHERE isfinite(p)) AS BIGINT) AS FinitePredictions FROM ex GROUP BY 1""")
def model_roundtrip(spark, sf_dir):
    """Loaded models score every row; the example is the earliest one, and a prediction that is not finite is not counted."""
    models, _, frame = _final(spark, sf_dir)
    scored = moments.predict(models, frame)
    first = F.struct("CreateDate", "RideEstimativeID")
    return scored.groupBy("CategoryID").agg(
        rounded(F.min_by("Price", first)).alias("ExampleTargetPrice"), rounded(F.min_by("prediction", first)).alias("ExamplePrediction"),
        F.count(F.lit(1)).alias("RowsScored"),
        count_if(~F.isnan("prediction") & (F.abs("prediction") < float("inf"))).alias("FinitePredictions"))


@query("batch_predict", SEARCH_SQL + REGIME_SQL + f" SELECT RideEstimativeID, CategoryID, {rnd('Price')} AS Price, {rnd('p')} AS prediction FROM pr")
def batch_predict(spark, sf_dir):
    models, _, frame = _final(spark, sf_dir)
    scored = moments.predict(models, frame)
    return scored.select("RideEstimativeID", "CategoryID", *[rounded(F.col(c)).alias(c) for c in ("Price", "prediction")])
