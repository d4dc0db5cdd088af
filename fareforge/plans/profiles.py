"""Profiling, target analysis and correlation."""
from pyspark.sql import functions as F

from ..functions.scalar import pct as pct_col
from ..functions.scalar import rounded, rows, seconds_between
from ..operators import correlation, profiling, target
from . import views as v
from .registry import big, pct, query, rnd

PROFILED = ["ProductID", "Price", "WaitingTime", "FareID", "Fee", "OriginLat", "LineNo", "SupplierID"]
KEYED = ["RideEstimativeID", *PROFILED]


def _profiled(spark, sf_dir):
    return v.estimates(spark, sf_dir).select(*KEYED)


def _stack(line, names, extra=""):
    return "SELECT * FROM (" + "\nUNION ALL ".join(line(c) for c in names) + ")" + extra


NULLS = _stack(lambda c: f"""SELECT '{c}' AS "column", {big(f'count(*) - count("{c}")')} AS null_count,
  {pct(f'count(*) - count("{c}")', 'count(*)', 2)} AS null_pct FROM ve""", PROFILED)


@query("null_profile", NULLS)
def null_profile(spark, sf_dir):
    return profiling.null_profile(_profiled(spark, sf_dir), PROFILED)


@query("high_null_columns", f"""
SELECT *, CASE WHEN null_pct >= 90 THEN 'critical' ELSE 'moderate' END AS level FROM ({NULLS}) WHERE null_pct >= 30""")
def high_null_columns(spark, sf_dir):
    return profiling.high_null_columns(profiling.null_profile(_profiled(spark, sf_dir), PROFILED))


@query("reconstruct_table", f"""
SELECT (SELECT count(*) FROM va) AS rows_scanned, count(*) AS distinct_rows, count(DISTINCT CategoryID) AS logical_rows,
       {big('(SELECT count(*) FROM (SELECT CategoryID FROM (SELECT DISTINCT CategoryID, ProductID FROM va) GROUP BY 1 HAVING count(*) > 1))')}
         AS conflicting_keys, (SELECT count(*) FROM va) - count(*) AS exact_duplicate_rows
FROM (SELECT DISTINCT CategoryID, ProductID FROM va)""")
def reconstruct_table(spark, sf_dir):
    return profiling.reconstruction_stats(v.analytical(spark, sf_dir).select("CategoryID", "ProductID"),
                                          ["CategoryID", "ProductID"], ["CategoryID"])


@query("duplicate_summary", f"""
SELECT (SELECT count(*) FROM ve) - (SELECT count(*) FROM (SELECT DISTINCT RideID, LineNo FROM ve)) AS duplicate_key_rows,
       (SELECT count(*) FROM ve) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ve)) AS duplicate_full_rows,
       {big('(SELECT count(*) FROM (SELECT RideID, LineNo FROM (SELECT DISTINCT * FROM ve) GROUP BY 1, 2 HAVING count(*) > 1))')}
         AS conflicting_keys""")
def duplicate_summary(spark, sf_dir):
    return profiling.duplicate_summary(v.estimates(spark, sf_dir), v.DEDUP_KEY)


@query("dtype_summary", """
SELECT * FROM (VALUES ('RideID', 'bigint'), ('UserID', 'bigint'), ('Schedule', 'timestamp_ntz'),
  ('Create', 'timestamp_ntz'), ('RidePrice', 'double'), ('RideStatus', 'string'), ('ScheduledRide', 'bigint')) t("column", dtype),
  (SELECT count(*) AS rows FROM vr)""")
def dtype_summary(spark, sf_dir):
    return profiling.dtype_summary(v.rides(spark, sf_dir))


TEXTS = {"FareID"}
UNIQUES = _stack(lambda c: f"""SELECT '{c}' AS "column", {big(f'count("{c}")')} AS non_null,
  {big(f'count(DISTINCT "{c}")')} AS uniques,
  coalesce({rnd(f'count(DISTINCT "{c}") * 1.0 / nullif(count("{c}"), 0)')}, 0.0) AS unique_ratio,
  {'true' if c in TEXTS else 'false'} AS is_text FROM ve""", PROFILED)


@query("cardinality_classes", f"""
SELECT "column", non_null, uniques, unique_ratio,
       CASE WHEN is_text AND (uniques > 1000 OR unique_ratio > 0.20) THEN 'high_cardinality'
            WHEN is_text OR uniques <= 50 THEN 'categorical' ELSE 'other' END AS class
FROM ({UNIQUES})""")
def cardinality_classes(spark, sf_dir):
    return profiling.cardinality_classes(_profiled(spark, sf_dir), "RideEstimativeID")


TOPPED = ["FareID", "LineNo", "SupplierID", "ProductID"]


@query("topk_values", f"""
SELECT "column", value, count, rank, unique_count, unique_ratio FROM (
  SELECT *, count(*) OVER (PARTITION BY "column") AS unique_count,
         """ + rnd('count(*) OVER (PARTITION BY "column") / sum(count) OVER (PARTITION BY "column")') + f""" AS unique_ratio, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS INTEGER) AS rank FROM (
    {_stack(lambda c: f'SELECT {chr(39)}{c}{chr(39)} AS "column", CAST("{c}" AS VARCHAR) AS value, count(*) AS count FROM ve WHERE "{c}" IS NOT NULL GROUP BY 2', TOPPED)}))
WHERE rank <= 10""")
def topk_values(spark, sf_dir):
    return profiling.top_values(v.estimates(spark, sf_dir).select(*TOPPED), TOPPED)


@query("constant_columns", """
SELECT 'ScheduledFlag' AS "column" FROM (SELECT count(*) AS n FROM vr) WHERE n > 0""")
def constant_columns(spark, sf_dir):
    """ScheduledRide holds ones and nulls and is not constant; the added flag is."""
    return profiling.constant_columns(v.rides(spark, sf_dir).withColumn("ScheduledFlag", F.lit(0)))


OUTLIER_COLUMNS = ["Price", "Hour", "Weekday", "Lead"]


def _iqr_sql(c):
    return f"""SELECT '{c}' AS "column", {rnd(f'min("{c}")')} AS min, {rnd('any_value(q1)')} AS q1,
  {rnd('any_value(q2)')} AS median, {rnd('any_value(q3)')} AS q3, {rnd(f'max("{c}")')} AS max,
  {rnd('any_value(q3 - q1)')} AS iqr,
  {rnd('any_value(q1 - CASE WHEN q3 = q1 THEN 0 ELSE 1.5 * (q3 - q1) END)')} AS lower_bound,
  {rnd('any_value(q3 + CASE WHEN q3 = q1 THEN 0 ELSE 1.5 * (q3 - q1) END)')} AS upper_bound,
  {big(f'count(*) FILTER (WHERE q3 <> q1 AND ("{c}" < q1 - 1.5 * (q3 - q1) OR "{c}" > q3 + 1.5 * (q3 - q1)))')} AS outlier_count,
  {pct(f'count(*) FILTER (WHERE q3 <> q1 AND ("{c}" < q1 - 1.5 * (q3 - q1) OR "{c}" > q3 + 1.5 * (q3 - q1)))', f'count("{c}")', 2)} AS outlier_pct,
  count(DISTINCT "{c}") AS u
FROM oc, (SELECT quantile_cont("{c}", 0.25) AS q1, quantile_cont("{c}", 0.5) AS q2, quantile_cont("{c}", 0.75) AS q3 FROM oc)"""


OC = """, oc AS (SELECT Price, hour("Create") AS Hour, isodow("Create") - 1 AS Weekday,
  (epoch_us("Create") - epoch_us("Schedule")) / 1e6 AS Lead FROM vk) """
IQR = f"SELECT * EXCLUDE (u) FROM ({_stack(_iqr_sql, OUTLIER_COLUMNS)}) WHERE u > 10"


def _outlier_frame(spark, sf_dir):
    ts = F.col("Create")
    return v.clock(spark, sf_dir).select(
        "RideID", "UserID", "Price", F.hour(ts).alias("Hour"), F.weekday(ts).alias("Weekday"),
        seconds_between(F.col("Schedule"), ts).alias("Lead"))


@query("iqr_outliers", OC + IQR)
def iqr_outliers(spark, sf_dir):
    df = _outlier_frame(spark, sf_dir)
    return profiling.iqr_outliers(df, profiling.outlier_candidates(df, "RideID"))


@query("high_outlier_columns", f'{OC} SELECT "column", outlier_count, outlier_pct FROM ({IQR}) WHERE outlier_pct >= 1.0')
def high_outlier_columns(spark, sf_dir):
    df = _outlier_frame(spark, sf_dir)
    return profiling.high_outlier_columns(profiling.iqr_outliers(df, profiling.outlier_candidates(df, "RideID")))


QUARTILES = """tq AS (SELECT CategoryID, quantile_cont(Price, 0.25) AS q1, quantile_cont(Price, 0.5) AS q2,
  quantile_cont(Price, 0.75) AS q3 FROM vk GROUP BY 1)"""


def _outside(k):
    return f"(Price < q1 - {k} * (q3 - q1) OR Price > q3 + {k} * (q3 - q1))"


STATS = f"""SELECT CategoryID, count(*) AS rows, {rnd('avg(Price)')} AS mean, {rnd('any_value(q2)')} AS median,
  {rnd('stddev_samp(Price)')} AS std, {rnd('min(Price)')} AS min, {rnd('max(Price)')} AS max,
  {rnd('skewness(Price)')} AS skewness, {rnd('any_value(q3 - q1)')} AS iqr,
  {rnd('any_value(q1 - 1.5 * (q3 - q1))')} AS mild_lower, {rnd('any_value(q3 + 1.5 * (q3 - q1))')} AS mild_upper,
  {rnd('any_value(q1 - 3.0 * (q3 - q1))')} AS extreme_lower, {rnd('any_value(q3 + 3.0 * (q3 - q1))')} AS extreme_upper,
  {big(f'count(*) FILTER (WHERE {_outside(1.5)})')} AS mild_count,
  {big(f'count(*) FILTER (WHERE {_outside(3.0)})')} AS extreme_count,
  {big('count(*) FILTER (WHERE Price = 0)')} AS zero_count,
  {pct(f'count(*) FILTER (WHERE {_outside(1.5)})', 'count(*)', 2)} AS mild_pct,
  {pct(f'count(*) FILTER (WHERE {_outside(3.0)})', 'count(*)', 2)} AS extreme_pct,
  {pct('count(*) FILTER (WHERE Price = 0)', 'count(*)', 2)} AS zero_pct
FROM vk JOIN tq USING (CategoryID) GROUP BY 1"""


@query("target_stats", f", {QUARTILES} {STATS}")
def target_stats(spark, sf_dir):
    return target.target_stats(v.clock(spark, sf_dir))


@query("shape_class", f""", {QUARTILES}
SELECT CategoryID, CASE WHEN skewness < 0.5 THEN 'near_symmetric' WHEN skewness < 1 THEN 'moderate'
                        ELSE 'strong' END AS shape,
       CASE WHEN extreme_pct < 0.5 AND skewness < 1 THEN 'light' ELSE 'robust' END AS treatment FROM ({STATS})""")
def shape_class(spark, sf_dir):
    stats = target.target_stats(v.clock(spark, sf_dir))
    skew = F.col("skewness")
    return stats.select("CategoryID", target.shape_class(skew).alias("shape"),
                        target.treatment_note(F.col("extreme_pct"), skew).alias("treatment"))


LEVELS = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95,
          "p99": 0.99, "p99_5": 0.995, "p99_9": 0.999}


@query("target_percentiles", "SELECT CategoryID, " + ", ".join(
    f"{rnd(f'quantile_cont(Price, {p})')} AS {n}" for n, p in LEVELS.items()) + " FROM vk GROUP BY 1")
def target_percentiles(spark, sf_dir):
    return target.target_percentiles(v.clock(spark, sf_dir))


@query("target_histogram", f"""
SELECT CategoryID, bin, {rnd('lo + (bin - 1) * width')} AS bin_start, {rnd('lo + bin * width')} AS bin_end, count FROM (
  SELECT CategoryID, lo, width, CAST(CASE WHEN width = 0 THEN 1 ELSE least(floor((Price - lo) / width) + 1, 80) END AS BIGINT) AS bin,
         count(*) AS count
  FROM vk JOIN (SELECT CategoryID, min(Price) AS lo, (max(Price) - min(Price)) / 80 AS width FROM vk GROUP BY 1) USING (CategoryID)
  GROUP BY ALL)""")
def target_histogram(spark, sf_dir):
    return target.target_histogram(v.clock(spark, sf_dir))


@query("axis_limits", f"SELECT CategoryID, {rnd('quantile_cont(Price, 0.995)')} AS axis_limit FROM vk GROUP BY 1")
def axis_limits(spark, sf_dir):
    return target.axis_limits(v.clock(spark, sf_dir)).select("CategoryID", rounded(F.col("axis_limit")).alias("axis_limit"))


@query("target_boxplot", f""", {QUARTILES}
SELECT CategoryID, {rnd(f'min(Price) FILTER (WHERE NOT {_outside(1.5)})')} AS whisker_low, {rnd('any_value(q1)')} AS q1,
       {rnd('any_value(q2)')} AS median, {rnd('any_value(q3)')} AS q3,
       {rnd(f'max(Price) FILTER (WHERE NOT {_outside(1.5)})')} AS whisker_high
FROM vk JOIN tq USING (CategoryID) GROUP BY 1""")
def target_boxplot(spark, sf_dir):
    return target.target_boxplot(v.clock(spark, sf_dir))


NUMBERS = ["Price", "WaitingTime", "Fee", "OriginLat", "DestinationLat", "RidePrice", "LineNo"]
PAIRS = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]]
LEAKAGE = ["RidePrice"]
FAMILIES = {"WaitingTime": "continuous", "Fee": "monetary_component", "OriginLat": "spatial_coordinate",
            "DestinationLat": "spatial_coordinate", "RidePrice": "monetary_component", "LineNo": "categorical_code",
            "Price": "monetary_component"}
EXCLUDED = {"RideID": "identifier"}


def _numbers(spark, sf_dir):
    return v.analytical(spark, sf_dir).select("RideID", *NUMBERS)


CORR = _stack(lambda p: f"""SELECT '{p[0]}' AS feature, '{p[1]}' AS other, corr("{p[0]}", "{p[1]}") AS r FROM va""", PAIRS)


@query("correlation_matrix", f""", cm AS ({CORR})
SELECT feature, other, {rnd('r', 6)} AS corr FROM cm UNION ALL SELECT other, feature, {rnd('r', 6)} FROM cm
UNION ALL SELECT unnest({NUMBERS}), unnest({NUMBERS}), 1.0::DOUBLE""")
def correlation_matrix(spark, sf_dir):
    return correlation.correlation_matrix(_numbers(spark, sf_dir), NUMBERS)


def _family(c):
    return FAMILIES.get(c, "other")


META = _stack(lambda c: f"""SELECT '{c}' AS feature,
  '{'bigint' if c in ('LineNo', 'RideID') else 'double'}' AS dtype, {big(f'count(*) - count("{c}")')} AS null_count,
  {pct(f'count(*) - count("{c}")', 'count(*)', 2)} AS null_pct, {big(f'count(DISTINCT "{c}")')} AS nunique,
  coalesce({rnd(f'stddev_samp("{c}")', 6)}, 0.0) AS std, {'false' if c in EXCLUDED else 'true'} AS included_in_matrix,
  '{EXCLUDED.get(c, '')}' AS exclusion_reason,
  '{'leakage_or_post_event' if c in LEAKAGE else 'candidate'}' AS feature_status, '{_family(c)}' AS feature_family FROM va""",
              ["RideID", *NUMBERS])


def _metadata(df):
    return correlation.column_metadata(df, ["RideID", *NUMBERS], EXCLUDED, LEAKAGE, FAMILIES)


@query("column_metadata", META)
def column_metadata(spark, sf_dir):
    return _metadata(_numbers(spark, sf_dir))


RANKING = f"""
SELECT feature, {rnd('r', 6)} AS corr_to_target, {rnd('abs(r)', 6)} AS abs_corr_to_target, null_pct, feature_status,
       feature_family, CASE WHEN feature = 'RidePrice' THEN 'exclude' ELSE 'candidate' END AS modeling_role
FROM (SELECT other AS feature, r FROM ({CORR}) WHERE feature = 'Price') JOIN ({META}) USING (feature)"""


def _ranking(spark, sf_dir):
    df = _numbers(spark, sf_dir)
    return correlation.target_correlation(df, NUMBERS, "Price", _metadata(df), LEAKAGE)


@query("target_correlation", RANKING)
def target_correlation(spark, sf_dir):
    return _ranking(spark, sf_dir)


@query("multicollinearity", f"""
SELECT feature AS feature_left, other AS feature_right, {rnd('r', 6)} AS corr, {rnd('abs(r)', 6)} AS abs_corr
FROM ({CORR}) WHERE abs(r) >= 0.85 AND feature <> 'Price'""")
def multicollinearity(spark, sf_dir):
    return correlation.multicollinear_pairs(_numbers(spark, sf_dir), NUMBERS, "Price")


@query("low_signal", f"""
SELECT *, CASE feature_family WHEN 'categorical_code' THEN 'keep_as_categorical_test_not_by_pearson_alone'
  WHEN 'spatial_coordinate' THEN 'transform_into_distance_or_zone_features'
  WHEN 'continuous' THEN 'keep_for_baseline_due_business_plausibility'
  WHEN 'monetary_component' THEN 'deprioritize_raw_feature_or_validate_semantics'
  ELSE 'deprioritize_or_exclude_after_model_baseline' END AS possible_action
FROM ({RANKING}) WHERE modeling_role = 'candidate' AND abs_corr_to_target < 0.05""")
def low_signal(spark, sf_dir):
    return correlation.low_signal(_ranking(spark, sf_dir))


@query("top5_correlated", f"""
SELECT feature, abs_corr_to_target FROM ({RANKING}) WHERE modeling_role = 'candidate'
ORDER BY abs_corr_to_target DESC, feature LIMIT 5""")
def top5_correlated(spark, sf_dir):
    return (_ranking(spark, sf_dir).where("modeling_role = 'candidate'").select("feature", "abs_corr_to_target")
            .orderBy(F.desc("abs_corr_to_target"), "feature").limit(5))


@query("eda_summary", f"""
SELECT CategoryID, count(*) AS rows, {rnd('avg(Price)')} AS mean_price, {rnd('quantile_cont(Price, 0.5)')} AS median_price,
       {rnd('max(Price)')} AS max_price, {rnd('skewness(Price)')} AS skew_price, {rnd('quantile_cont(Price, 0.95)')} AS p95_price,
       {rnd('quantile_cont(Price, 0.99)')} AS p99_price, {rnd('quantile_cont(WaitingTime, 0.95)')} AS waiting_p95,
       {pct("count(*) FILTER (WHERE FareID IS NULL OR trim(FareID) = '')", 'count(*)', 2)} AS fare_missing_pct,
       min("Create") AS date_min, max("Create") AS date_max
FROM va GROUP BY 1""")
def eda_summary(spark, sf_dir):
    from ..functions.quantiles import group_quantiles
    from ..functions.scalar import adjusted_skewness, count_if, is_blank
    df = v.analytical(spark, sf_dir).select("CategoryID", "Price", "WaitingTime", "FareID", "Create")
    main = df.groupBy("CategoryID").agg(
        rows().alias("rows"), rounded(F.avg("Price")).alias("mean_price"), rounded(F.max("Price")).alias("max_price"),
        rounded(adjusted_skewness(F.col("Price"))).alias("skew_price"),
        pct_col(count_if(is_blank(F.col("FareID"))), rows(), 2).alias("fare_missing_pct"),
        F.min("Create").alias("date_min"), F.max("Create").alias("date_max"))
    price = group_quantiles(df, ["CategoryID"], "Price", {"median_price": 0.5, "p95_price": 0.95, "p99_price": 0.99})
    waiting = group_quantiles(df, ["CategoryID"], "WaitingTime", {"waiting_p95": 0.95})
    levels = price.join(waiting, "CategoryID")
    names = [c for c in levels.columns if c != "CategoryID"]
    return main.join(levels.select("CategoryID", *[rounded(F.col(c)).alias(c) for c in names]), "CategoryID")
