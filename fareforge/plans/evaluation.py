"""Metrics, fold summaries, model comparison and selection, on mean predictors with an exact answer."""
from pyspark.sql import functions as F

from ..functions.bounded import lookup_join, settle
from ..functions.scalar import rounded, rows
from ..operators import evaluate, folds, means
from ..operators.evaluate import METRICS
from . import views as v
from .registry import big, query, rnd

SHRINK = {0: 1.0, 1: 5.0, 2: 25.0, 3: 125.0}
MODELS = [("CategoryMean", "baseline", 0), ("WaitingMean", "baseline", 1),
          ("ProductMean", "advanced", 1), ("UserHistory", "advanced", 1)]
COLUMNS = ["RideEstimativeID", "CategoryID", "ProductID", "WaitingTime", "Price", "UserPriorCategoryPriceMean", "Create"]

SOURCE_COLUMNS = ["RideEstimativeID", "RideID", "CategoryID", "ProductID", "UserID", "WaitingTime", "Price", "Create"]


def _marked(spark, sf_dir):
    """Rows of the target categories with fold numbers, and the windows (from the dates of all categories)."""
    rows = v.with_category_history(spark, sf_dir, SOURCE_COLUMNS)
    frame = v.materialize(folds.temporal_frame(rows, COLUMNS, v.REGIME), "evaluation")
    windows = folds.split_windows(frame, v.CONFIG)
    return folds.mark_folds(frame.where(F.col("CategoryID").isin(v.TARGETS)), windows), windows


def _scored(spark, sf_dir):
    marked, windows = _marked(spark, sf_dir)
    return means.score_means(marked, v.CONFIG.n_splits), windows


def _labels(name, group, features, variant="default", trial=None, phase=None):
    return {"ModelName": name, "AlgorithmGroup": group, "FeatureCount": features, "ModelVariant": variant,
            "TrialNumber": trial, "Phase": phase}


LABELS = ["ModelName", "AlgorithmGroup", "FeatureCount", "ModelVariant", "TrialNumber", "Phase"]


def _with_windows(df, windows):
    """Window dates next to the fold number: a literal table of as many rows as there are windows."""
    table = df.sparkSession.createDataFrame(
        [(w.number, w.name, w.train_start, w.train_end, w.evaluation_start, w.evaluation_end) for w in windows],
        "number int, FoldName string, TrainStart date, TrainEnd date, EvaluationStart date, EvaluationEnd date")
    return df.join(F.broadcast(table), "number")


def _folds(spark, sf_dir, plain=True, trials=False):
    """Fold metrics of the plain models, the search trials, or both: few rows, computed in one pass."""
    scored, windows = _scored(spark, sf_dir)
    mean = F.col("category_mean")
    of = {"CategoryMean": mean, "WaitingMean": F.coalesce("waiting_mean", mean), "ProductMean": means.shrunk_mean(0),
          "UserHistory": F.coalesce("UserPriorCategoryPriceMean", mean)}
    models = [(_labels(n, g, k), of[n]) for n, g, k in MODELS] if plain else []
    if trials:
        models += [(_labels("ProductMean", "tuning", 1, "default", None, "default"), means.shrunk_mean(0))]
        models += [(_labels("ProductMean", "tuning", 1, "trial", t, "trial"), means.shrunk_mean(s)) for t, s in SHRINK.items()]
    models = [({**labels, "TrialNumber": -1 if labels["TrialNumber"] is None else labels["TrialNumber"],
                "Phase": labels["Phase"] or ""}, p) for labels, p in models]
    long = means.predictions(scored, models, ["CategoryID", "number", "Price", "TrainRows"])
    metrics = evaluate.fold_metrics(long, ["CategoryID", "number", "TrainRows", *LABELS])
    out = _with_windows(metrics, windows).withColumn("TrialNumber", F.nullif("TrialNumber", F.lit(-1)).cast("bigint"))
    return settle(out, "fold-metrics")


def _clean(df, reals):
    return df.withColumns({c: rounded(F.col(c)) for c in reals})


EV = f""", er AS (
  SELECT RideEstimativeID, CategoryID, ProductID, WaitingTime, Price, UserPriorCategoryPriceMean AS upm,
         CAST("Create" AS DATE) AS d
  FROM vx WHERE "Create" >= TIMESTAMP '1999-01-01' AND CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO')),
tr AS (SELECT number, er.* FROM er JOIN fw ON split_type = 'cv' AND d BETWEEN train_start AND train_end),
ev AS (SELECT number, er.* FROM er JOIN fw ON split_type = 'cv' AND d BETWEEN evaluation_start AND evaluation_end),
cmn AS (SELECT number, CategoryID, avg(Price) AS m, count(*) AS train_n FROM tr GROUP BY 1, 2),
pmn AS (SELECT number, ProductID, sum(Price) AS s, count(*) AS n FROM tr GROUP BY 1, 2),
wmn AS (SELECT number, CategoryID, WaitingTime, avg(Price) AS wm FROM tr GROUP BY 1, 2, 3),
sc AS (SELECT ev.*, m, train_n, wm, s, n FROM ev JOIN cmn USING (number, CategoryID)
       LEFT JOIN pmn USING (number, ProductID) LEFT JOIN wmn USING (number, CategoryID, WaitingTime)),
lg AS (
  SELECT number, CategoryID, Price, train_n, 'CategoryMean' AS ModelName, 'baseline' AS AlgorithmGroup, 0 AS FeatureCount, m AS p FROM sc
  UNION ALL SELECT number, CategoryID, Price, train_n, 'WaitingMean', 'baseline', 1, coalesce(wm, m) FROM sc
  UNION ALL SELECT number, CategoryID, Price, train_n, 'ProductMean', 'advanced', 1, coalesce(s / n, m) FROM sc
  UNION ALL SELECT number, CategoryID, Price, train_n, 'UserHistory', 'advanced', 1, coalesce(upm, m) FROM sc),
tl AS (
  SELECT number, CategoryID, Price, CAST(NULL AS BIGINT) AS TrialNumber, 'default' AS Phase, coalesce(s / n, m) AS p FROM sc
  UNION ALL SELECT number, CategoryID, Price, t, 'trial', (coalesce(s, 0) + m * k) / (coalesce(n, 0) + k)
  FROM sc, (SELECT unnest([0, 1, 2, 3]) AS t, unnest([1.0::DOUBLE, 5.0, 25.0, 125.0]) AS k))"""


METRIC_SQL = """avg(abs(Price - p)) AS MAE, sqrt(avg((Price - p) * (Price - p))) AS RMSE,
  avg(abs(Price - p) / greatest(abs(Price), 2.220446049250313e-16)) * 100 AS MAPE,
  CASE WHEN var_pop(Price) > 0 THEN 1 - sum((Price - p) * (Price - p)) / (var_pop(Price) * count(*)) END AS R2"""
FM = f"""{EV}, fm AS (SELECT CategoryID, number, ModelName, AlgorithmGroup, FeatureCount, train_n AS TrainRows,
  count(*) AS EvaluationRows, {METRIC_SQL} FROM lg GROUP BY ALL),
fx AS (SELECT fm.*, split_name AS FoldName, train_start AS TrainStart, train_end AS TrainEnd,
       evaluation_start AS EvaluationStart, evaluation_end AS EvaluationEnd FROM fm JOIN fw USING (number)),
sm AS (SELECT CategoryID, ModelName, AlgorithmGroup, count(*) AS Folds,
  {', '.join(f'avg({m}) AS Mean{m}' for m in METRICS)}, {', '.join(f'stddev_samp({m}) AS Std{m}' for m in METRICS)} FROM fm GROUP BY 1, 2, 3),
rk AS (SELECT *, row_number() OVER (PARTITION BY CategoryID ORDER BY MeanRMSE, MeanMAE, ModelName) AS k FROM sm)"""
ROUND = ", ".join(f"{rnd(m)} AS {m}" for m in METRICS)
ROUND_MEANS = ", ".join(f"{rnd(f'Mean{m}')} AS Mean{m}" for m in METRICS)


@query("regression_metrics", f"""{EV}
SELECT ModelName, EvaluationRows, {ROUND} FROM (SELECT ModelName, count(*) AS EvaluationRows, {METRIC_SQL} FROM lg GROUP BY 1)""")
def regression_metrics(spark, sf_dir):
    scored, _ = _scored(spark, sf_dir)
    mean = F.col("category_mean")
    models = [({"ModelName": "CategoryMean"}, mean), ({"ModelName": "WaitingMean"}, F.coalesce("waiting_mean", mean)),
              ({"ModelName": "ProductMean"}, means.shrunk_mean(0)),
              ({"ModelName": "UserHistory"}, F.coalesce("UserPriorCategoryPriceMean", mean))]
    long = means.predictions(scored, models, ["Price"])
    return _clean(evaluate.fold_metrics(long, ["ModelName"]), METRICS)


@query("fold_metrics", f"""{FM}
SELECT CategoryID, ModelName, FoldName, TrainRows, EvaluationRows, TrainStart, TrainEnd, EvaluationStart, EvaluationEnd,
       CAST(FeatureCount AS INTEGER) AS FeatureCount, {ROUND} FROM fx""")
def fold_metrics(spark, sf_dir):
    out = _folds(spark, sf_dir).select("CategoryID", "ModelName", "FoldName", "TrainRows", "EvaluationRows", "TrainStart", "TrainEnd",
                                       "EvaluationStart", "EvaluationEnd", "FeatureCount", *METRICS)
    return _clean(out, METRICS)


def _summary(spark, sf_dir):
    return settle(evaluate.metric_summary(_folds(spark, sf_dir), ["CategoryID", "ModelName", "AlgorithmGroup"]), "summary")


MEANS = [f"Mean{m}" for m in METRICS]
STDS = [f"Std{m}" for m in METRICS]


@query("fold_metric_summary", f"""{FM}
SELECT CategoryID, ModelName, AlgorithmGroup, Folds, {ROUND_MEANS}, {', '.join(f"{rnd(c)} AS {c}" for c in STDS)} FROM sm""")
def fold_metric_summary(spark, sf_dir):
    return _clean(_summary(spark, sf_dir), MEANS + STDS)


@query("rank_models", f"""{FM}
SELECT CategoryID, ModelName, {rnd('MeanRMSE')} AS MeanRMSE, k AS RMSECategoryRank FROM rk""")
def rank_models(spark, sf_dir):
    out = evaluate.rank_models(_summary(spark, sf_dir))
    return out.select("CategoryID", "ModelName", rounded(F.col("MeanRMSE")).alias("MeanRMSE"), "RMSECategoryRank")


@query("model_comparison", f"""{FM}
SELECT CategoryID, lower(CategoryID) AS CategoryName, ModelName, AlgorithmGroup,
       AlgorithmGroup || '_summary' AS SourceFile, {ROUND_MEANS}, k AS RMSECategoryRank FROM rk""")
def model_comparison(spark, sf_dir):
    """Summaries per group, tagged with where they came from, in one ranked table."""
    summary = _summary(spark, sf_dir)
    parts = [summary.where(F.col("AlgorithmGroup") == g).withColumn("SourceFile", F.lit(f"{g}_summary"))
             for g in ("baseline", "advanced")]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    out = evaluate.rank_models(both).withColumn("CategoryName", F.lower("CategoryID"))
    return _clean(out.select("CategoryID", "CategoryName", "ModelName", "AlgorithmGroup", "SourceFile", *MEANS, "RMSECategoryRank"), MEANS)


SELECTED = f"""{FM}, b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CategoryID ORDER BY MeanRMSE, MeanMAE, ModelName) AS j
  FROM sm WHERE AlgorithmGroup = 'baseline') WHERE j = 1),
w AS (SELECT *,
  first_value(ModelName) OVER (PARTITION BY CategoryID ORDER BY MeanMAE, MeanRMSE, ModelName) AS mae_m,
  min(MeanMAE) OVER (PARTITION BY CategoryID) AS mae_v,
  first_value(ModelName) OVER (PARTITION BY CategoryID ORDER BY MeanMAPE, MeanRMSE, MeanMAE, ModelName) AS mape_m,
  min(MeanMAPE) OVER (PARTITION BY CategoryID) AS mape_v,
  first_value(ModelName) OVER (PARTITION BY CategoryID ORDER BY MeanR2 DESC, MeanRMSE, MeanMAE, ModelName) AS r2_m,
  max(MeanR2) OVER (PARTITION BY CategoryID) AS r2_v FROM rk),
r2nd AS (SELECT CategoryID, ModelName AS second_m, MeanRMSE AS second_v FROM rk WHERE k = 2)
SELECT w.CategoryID, w.ModelName AS SelectedModel, w.AlgorithmGroup AS SelectedModelGroup,
  {', '.join(f"{rnd(f'w.Mean{m}')} AS SelectedMean{m}" for m in METRICS)},
  mae_m AS BestMAEModel, {rnd('mae_v')} AS BestMAE, mape_m AS BestMAPEModel, {rnd('mape_v')} AS BestMAPE,
  r2_m AS BestR2Model, {rnd('r2_v')} AS BestR2, second_m AS RunnerUpModel, b.ModelName AS BestBaselineRMSEModel,
  {rnd('b.MeanRMSE')} AS BestBaselineRMSE, {rnd('w.MeanRMSE - b.MeanRMSE')} AS DeltaRMSEvsBestBaseline,
  {rnd('w.MeanMAE - b.MeanMAE')} AS DeltaMAEvsBestBaseline,
  coalesce(nullif(concat_ws('; ', CASE WHEN mae_m <> w.ModelName THEN 'MAE: ' || mae_m END,
    CASE WHEN mape_m <> w.ModelName THEN 'MAPE: ' || mape_m END,
    CASE WHEN r2_m <> w.ModelName THEN 'R2: ' || r2_m END), ''), 'leads every metric') AS OtherLeaders
FROM w JOIN b USING (CategoryID) JOIN r2nd USING (CategoryID) WHERE w.k = 1"""


@query("select_best_model", SELECTED)
def select_best_model(spark, sf_dir):
    reals = [f"SelectedMean{m}" for m in METRICS] + ["BestMAE", "BestMAPE", "BestR2", "BestBaselineRMSE",
                                                    "DeltaRMSEvsBestBaseline", "DeltaMAEvsBestBaseline"]
    return _clean(evaluate.select_best(_summary(spark, sf_dir)), reals)


@query("best_per_group", f"""{FM}
SELECT CategoryID, ModelName, {rnd('MeanMAE')} AS MeanMAE FROM (SELECT *, row_number() OVER (
  PARTITION BY CategoryID ORDER BY MeanMAE, MeanRMSE, ModelName) AS j FROM sm) WHERE j = 1""")
def best_per_group(spark, sf_dir):
    out = evaluate.best_per_group(_summary(spark, sf_dir), ["CategoryID"], ["MeanMAE", "MeanRMSE", "ModelName"])
    return out.select("CategoryID", "ModelName", rounded(F.col("MeanMAE")).alias("MeanMAE"))


BEST_REALS = [f"BestBaseline{m}" for m in METRICS] + [f"Delta{m}vsBestBaseline" for m in METRICS]


@query("compare_to_baseline", f"""{FM}, b AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY CategoryID ORDER BY MeanMAE, MeanRMSE, ModelName) AS j FROM sm WHERE AlgorithmGroup = 'baseline') WHERE j = 1)
SELECT s.CategoryID, s.ModelName, {', '.join(f"{rnd(f's.Mean{m}')} AS Mean{m}" for m in METRICS)}, b.ModelName AS BestBaselineModel,
  {', '.join(f"{rnd(f'b.Mean{m}')} AS BestBaseline{m}" for m in METRICS)},
  {', '.join(f"{rnd(f's.Mean{m} - b.Mean{m}')} AS Delta{m}vsBestBaseline" for m in METRICS)},
  s.MeanMAE < b.MeanMAE AS BeatsBestBaselineMAE
FROM sm s JOIN b USING (CategoryID) WHERE s.AlgorithmGroup <> 'baseline'""")
def compare_to_baseline(spark, sf_dir):
    out = evaluate.compare_to_baseline(_summary(spark, sf_dir))
    return _clean(out.select("CategoryID", "ModelName", *MEANS, "BestBaselineModel", *BEST_REALS, "BeatsBestBaselineMAE"),
                  MEANS + BEST_REALS)


TM = f"""{EV}, tf AS (SELECT CategoryID, number, TrialNumber, Phase, count(*) AS EvaluationRows, {METRIC_SQL} FROM tl GROUP BY 1, 2, 3, 4),
ts AS (SELECT CategoryID, TrialNumber, Phase, {', '.join(f'avg({m}) AS Mean{m}' for m in METRICS)} FROM tf GROUP BY 1, 2, 3),
tk AS (SELECT *, row_number() OVER (PARTITION BY CategoryID ORDER BY MeanRMSE, TrialNumber) AS k FROM ts WHERE Phase = 'trial')"""


def _trials(spark, sf_dir):
    out = evaluate.metric_summary(_folds(spark, sf_dir, plain=False, trials=True), ["CategoryID", "TrialNumber", "Phase"])
    return settle(out, "trials")


@query("trial_ranking", f"""{TM}
SELECT CategoryID, TrialNumber, {ROUND_MEANS}, k = 1 AS IsBestTrial FROM tk""")
def trial_ranking(spark, sf_dir):
    out = evaluate.trial_ranking(_trials(spark, sf_dir).where("Phase = 'trial'"))
    return _clean(out.select("CategoryID", "TrialNumber", *MEANS, "IsBestTrial"), MEANS)


DELTA_REALS = [c for m in METRICS for c in (f"DefaultMean{m}", f"TunedMean{m}", f"Delta{m}")]


@query("tuning_deltas", f"""{TM}
SELECT d.CategoryID, t.TrialNumber AS BestTrialNumber, """ + ", ".join(
    f"{rnd(f'd.Mean{m}')} AS DefaultMean{m}, {rnd(f't.Mean{m}')} AS TunedMean{m}, {rnd(f't.Mean{m} - d.Mean{m}')} AS Delta{m}"
    for m in METRICS) + " FROM ts d JOIN tk t ON d.CategoryID = t.CategoryID AND t.k = 1 WHERE d.Phase = 'default'")
def tuning_deltas(spark, sf_dir):
    trials = _trials(spark, sf_dir)
    best = evaluate.trial_ranking(trials.where("Phase = 'trial'")).where("IsBestTrial").drop("IsBestTrial")
    phases = trials.where("Phase = 'default'").unionByName(best.withColumn("Phase", F.lit("tuned")))
    return _clean(evaluate.tuning_deltas(phases), DELTA_REALS)


# every model's folds under one layout; the best trial enters as a variant of its model
RESULTS = f"""{FM}, tf AS (SELECT CategoryID, number, TrialNumber, Phase, count(*) AS EvaluationRows, {METRIC_SQL} FROM tl GROUP BY 1, 2, 3, 4),
tb AS (SELECT CategoryID, TrialNumber FROM (SELECT CategoryID, TrialNumber, row_number() OVER (
  PARTITION BY CategoryID ORDER BY avg(RMSE), TrialNumber) AS k FROM tf WHERE Phase = 'trial' GROUP BY 1, 2) WHERE k = 1),
rf AS (
  SELECT CategoryID, 'final_features_' || lower(CategoryID) AS DatasetName, ModelName AS Algorithm, AlgorithmGroup, 'default' AS ModelVariant,
         CAST(FeatureCount AS INTEGER) AS FeatureCount, CAST(NULL AS INTEGER) AS NumBoostRound, CAST(NULL AS BIGINT) AS TrialNumber,
         'fold_metrics.csv' AS SourceFile, FoldName, TrainRows, EvaluationRows, TrainStart, TrainEnd, EvaluationStart, EvaluationEnd,
         MAE, RMSE, MAPE, R2 FROM fx
  UNION ALL
  SELECT tf.CategoryID, 'final_features_' || lower(tf.CategoryID), 'ProductMean_Tuned', 'tuning', 'tuned', 1, CAST(100 AS INTEGER), tf.TrialNumber,
         'tuning_fold_metrics.csv', split_name, train_n, EvaluationRows, train_start, train_end,
         evaluation_start, evaluation_end, MAE, RMSE, MAPE, R2
  FROM tf JOIN tb ON tf.CategoryID = tb.CategoryID AND tf.TrialNumber = tb.TrialNumber AND tf.Phase = 'trial'
  JOIN fw ON fw.number = tf.number JOIN cmn ON cmn.number = tf.number AND cmn.CategoryID = tf.CategoryID),
rm AS (
  SELECT CategoryID, DatasetName, Algorithm, AlgorithmGroup, ModelVariant, FeatureCount, NumBoostRound, TrialNumber, SourceFile, count(DISTINCT FoldName) AS FoldsAveraged,
         avg(TrainRows) AS TrainRows, avg(EvaluationRows) AS EvaluationRows, min(TrainStart) AS TrainStart, max(TrainEnd) AS TrainEnd,
         min(EvaluationStart) AS EvaluationStart, max(EvaluationEnd) AS EvaluationEnd,
         {', '.join(f'avg({m}) AS {m}' for m in METRICS)}, {', '.join(f'stddev_samp({m}) AS {m}Std' for m in METRICS)}
  FROM rf GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9)"""


def _result_folds(spark, sf_dir):
    every = _folds(spark, sf_dir, trials=True)
    plain, trials = every.where("Phase = ''"), every.where("Phase = 'trial'")
    best = evaluate.trial_ranking(evaluate.metric_summary(trials, ["CategoryID", "TrialNumber"])).where("IsBestTrial")
    tuned = trials.join(best.select("CategoryID", "TrialNumber"), ["CategoryID", "TrialNumber"], "left_semi")
    tuned = tuned.withColumns({"ModelName": F.concat("ModelName", F.lit("_Tuned")), "ModelVariant": F.lit("tuned")})
    told = F.col("ModelVariant") == "tuned"
    both = plain.unionByName(tuned).withColumnRenamed("ModelName", "Algorithm").withColumns({
        "DatasetName": F.concat(F.lit("final_features_"), F.lower("CategoryID")), "NumBoostRound": F.when(told, F.lit(100)),
        "SourceFile": F.when(told, "tuning_fold_metrics.csv").otherwise("fold_metrics.csv")})
    return settle(both.select(*evaluate.RESULT_GROUPS, "FoldName", "TrainRows", "EvaluationRows", "TrainStart", "TrainEnd",
                              "EvaluationStart", "EvaluationEnd", *METRICS), "results")


GROUPS = ", ".join(evaluate.RESULT_GROUPS)
DATES = "TrainStart, TrainEnd, EvaluationStart, EvaluationEnd"
ROUND_STDS = ", ".join(f"{rnd(f'{m}Std')} AS {m}Std" for m in METRICS)
RESULT_REALS = ["TrainRows", "EvaluationRows", *METRICS, *[f"{m}Std" for m in METRICS]]


@query("results_mean_rows", f"""{RESULTS}
SELECT {GROUPS}, FoldsAveraged, {rnd('TrainRows')} AS TrainRows, {rnd('EvaluationRows')} AS EvaluationRows, {DATES}, {ROUND}, {ROUND_STDS}
FROM rm""")
def results_mean_rows(spark, sf_dir):
    return _clean(evaluate.mean_rows(_result_folds(spark, sf_dir)).drop("RowType", "FoldName"), RESULT_REALS)


@query("results_comparison", f"""{RESULTS}
SELECT {GROUPS}, 'mean' AS RowType, 'mean' AS FoldName, FoldsAveraged, {rnd('TrainRows')} AS TrainRows,
       {rnd('EvaluationRows')} AS EvaluationRows, {DATES}, {ROUND}, {ROUND_STDS} FROM rm
UNION ALL
SELECT {GROUPS}, 'fold', FoldName, NULL, {rnd('TrainRows')}, {rnd('EvaluationRows')}, {DATES}, {', '.join(rnd(m) for m in METRICS)},
       NULL, NULL, NULL, NULL FROM rf""")
def results_comparison(spark, sf_dir):
    return _clean(evaluate.results_table(_result_folds(spark, sf_dir)), RESULT_REALS)


@query("results_counts", f"""{RESULTS}, c AS (
  SELECT CategoryID, count(*) AS means, count(DISTINCT Algorithm) AS algorithms FROM rm GROUP BY 1)
SELECT (SELECT count(*) FROM rf) AS fold_rows, {big('sum(means)')} AS mean_rows, count(*) AS categories,
       min(algorithms) AS min_algorithms, max(algorithms) AS max_algorithms FROM c""")
def results_counts(spark, sf_dir):
    return evaluate.results_counts(evaluate.results_table(_result_folds(spark, sf_dir)))


@query("select_category_model", f"""{FM}, sel AS (SELECT CategoryID, ModelName FROM rk WHERE k = 1),
wanted AS (SELECT CategoryID FROM sel WHERE ModelName = 'CategoryMean' OR NOT EXISTS (SELECT 1 FROM sel WHERE ModelName = 'CategoryMean'))
SELECT CategoryID, count(*) AS rows FROM va WHERE CategoryID IN (SELECT CategoryID FROM wanted) GROUP BY 1""")
def select_category_model(spark, sf_dir):
    """Estimates of the categories whose selected model is the wanted one; of all categories when none is."""
    selection = settle(evaluate.select_best(_summary(spark, sf_dir)).select("CategoryID", "SelectedModel"), "selection")
    wanted = evaluate.categories_with_model(selection, "CategoryMean")
    chosen = lookup_join(v.priced(spark, sf_dir), wanted, "CategoryID", "left_semi")
    return chosen.groupBy("CategoryID").agg(rows().alias("rows"))
