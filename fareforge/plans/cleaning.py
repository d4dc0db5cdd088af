"""Projections, casts, filters and cleaning."""
from pyspark.sql import functions as F

from ..fixed import WEEKDAY_EN
from ..functions import calendar
from ..functions.scalar import abs_seconds, count_if, is_blank, label, normalize_key, rounded, rows
from ..operators import clean, joins, leakage
from ..operators.checks import missing_columns
from ..session import materialize
from . import views as v
from .registry import big, pct, query, rnd

RENAMES = {"ProductDescription": "Description", "CategoryID": "ProductCategoryID"}


@query("rename_map", """
SELECT ProductID, CategoryID AS ProductCategoryID, ProductDescription AS Description FROM vp""")
def rename_map(spark, sf_dir):
    return v.products(spark, sf_dir).withColumnsRenamed(RENAMES)


@query("prefix_columns", """
SELECT ProductID, CategoryID AS Dim_CategoryID, ProductDescription AS Dim_ProductDescription FROM vp""")
def prefix_columns(spark, sf_dir):
    return joins.prefix_columns(v.products(spark, sf_dir), "Dim_", ["ProductID"])


@query("normalize_key", """
SELECT RideID, CAST(UserID AS VARCHAR) AS UserKey, RideStatus AS StatusKey FROM vr""")
def normalized(spark, sf_dir):
    padded = v.rides(spark, sf_dir).withColumn("RideStatus", F.concat(F.lit("  "), "RideStatus", F.lit(" ")))
    return padded.select("RideID", normalize_key(F.col("UserID")).alias("UserKey"),
                         normalize_key(F.col("RideStatus")).alias("StatusKey"))


@query("cast_to_string", """
SELECT RideEstimativeID, CAST(ProductID AS VARCHAR) AS ProductID, CAST(LineNo AS VARCHAR) AS LineNo FROM ve""")
def cast_to_string(spark, sf_dir):
    df = v.estimates(spark, sf_dir).select("RideEstimativeID", "ProductID", "LineNo")
    return clean.text_columns_to_string(df, ["ProductID", "LineNo"])


@query("coerce_numeric", """
SELECT RideID, CASE WHEN RideID % 5 = 0 OR RideID % 7 = 0 THEN NULL ELSE RidePrice END AS RidePrice FROM vr""")
def coerce_numeric(spark, sf_dir):
    key = F.col("RideID")
    text = (F.when(key % 5 == 0, "abc").when(key % 7 == 0, "nan").otherwise(F.col("RidePrice").cast("string")))
    return clean.coerce_numeric(v.rides(spark, sf_dir).select("RideID", text.alias("RidePrice")), ["RidePrice"])


@query("coerce_timestamp", """
SELECT RideID, CASE WHEN RideID % 5 = 0 THEN NULL ELSE "Create" END AS "Create" FROM vk""")
def coerce_timestamp(spark, sf_dir):
    text = F.when(F.col("RideID") % 5 == 0, "not a time").otherwise(F.col("Create").cast("string"))
    return clean.coerce_timestamps(v.clock(spark, sf_dir).select("RideID", text.alias("Create")), ["Create"])


@query("blank_flag", """
SELECT RideEstimativeID, FareID IS NULL OR trim(FareID) = '' AS FareIDMissing FROM ve""")
def blank_flag(spark, sf_dir):
    return v.estimates(spark, sf_dir).select("RideEstimativeID", is_blank(F.col("FareID")).alias("FareIDMissing"))


@query("sentinel_impute", """
SELECT RideEstimativeID, CASE WHEN FareID IS NULL OR trim(FareID) = '' THEN 'MISSING_FAREID' ELSE FareID END AS FareID,
       FareID IS NULL OR trim(FareID) = '' AS FareIDWasImputed FROM ve""")
def sentinel_impute(spark, sf_dir):
    return clean.impute_sentinel(v.estimates(spark, sf_dir).select("RideEstimativeID", "FareID"))


@query("median_impute", f"""
SELECT RideEstimativeID, {rnd('coalesce(WaitingTime, wmed)')} AS WaitingTime, {rnd('coalesce(Fee, fmed)')} AS Fee,
       WaitingTime IS NULL AS WaitingTimeWasImputed FROM va CROSS JOIN vm""")
def median_impute(spark, sf_dir):
    df = v.priced(spark, sf_dir)
    overall = clean.thresholds(df, v.MEDIANS).overall
    median = lambda c: overall.select(f"{c}_median").scalar()
    return df.select("RideEstimativeID", *[
        rounded(F.coalesce(F.col(c), median(c))).alias(c) for c in v.MEDIANS],
        F.col("WaitingTime").isNull().alias("WaitingTimeWasImputed"))


@query("fill_missing_label", """
SELECT RideEstimativeID, coalesce(FareID, 'MISSING') AS FareID FROM ve""")
def fill_missing_label(spark, sf_dir):
    return clean.fill_labels(v.estimates(spark, sf_dir).select("RideEstimativeID", "FareID"), ["FareID"])


@query("cap_global", f"""
SELECT RideEstimativeID, {rnd('CASE WHEN WaitingTime > wcap THEN wcap ELSE WaitingTime END')} AS WaitingTime,
       coalesce(WaitingTime > wcap, false) AS WaitingTimeWasCapped FROM va CROSS JOIN vm""")
def cap_global(spark, sf_dir):
    df = v.priced(spark, sf_dir)
    cap = clean.thresholds(df, v.MEDIANS).overall.select("WaitingTime_cap").scalar()
    w = F.col("WaitingTime")
    return df.select("RideEstimativeID", rounded(clean.cap_upper(w, cap)).alias("WaitingTime"),
                     clean.above(w, cap).alias("WaitingTimeWasCapped"))


@query("cap_by_group", f"""
SELECT RideEstimativeID, CategoryID, {rnd('CASE WHEN Price > Price_cap THEN Price_cap ELSE Price END')} AS Price,
       coalesce(Price > Price_cap, false) AS PriceWasCapped FROM va LEFT JOIN vcap USING (CategoryID)""")
def cap_by_group(spark, sf_dir):
    df = v.priced(spark, sf_dir)
    caps = clean.thresholds(df, v.MEDIANS).by_group
    out = clean.cap_by_group(df.select("RideEstimativeID", "CategoryID", "Price"), caps)
    return out.withColumn("Price", rounded(F.col("Price")))


@query("filter_positive", "SELECT RideEstimativeID, Price FROM ve WHERE Price > 0 OR Price IS NULL")
def filter_positive(spark, sf_dir):
    return v.estimates(spark, sf_dir).where(clean.not_nonpositive("Price")).select("RideEstimativeID", "Price")


@query("drop_missing_any", """
SELECT RideEstimativeID, OriginLat, DestinationLat FROM ve
WHERE OriginLat IS NOT NULL AND DestinationLat IS NOT NULL""")
def drop_missing_any(spark, sf_dir):
    df = v.estimates(spark, sf_dir).select("RideEstimativeID", *v.COORDINATES)
    return clean.drop_missing_any(df, v.COORDINATES)


@query("temporal_rules", f"""
SELECT {big('count(*) FILTER (WHERE bad_time)')} AS invalid_create_or_schedule,
       {big('count(*) FILTER (WHERE bad_updated)')} AS updated_before_create,
       {big('count(*) FILTER (WHERE bad_gap)')} AS schedule_create_gap_gt_5m,
       {big('count(*) FILTER (WHERE bad_time OR bad_updated OR bad_gap)')} AS rows_dropped
FROM vs0""")
def temporal_rules(spark, sf_dir):
    df = v.staged(spark, sf_dir)
    return df.agg(*[count_if(F.col(c)).alias(c) for c in clean.chronology_flags()],
                  count_if(F.col("removed_by") == "chronology").alias("rows_dropped"))


CURATED_COLUMNS = ["RideEstimativeID", "RideID", "CategoryID", "UserID", "Create", "Price", "WaitingTime", "Fee",
                   "FareID", "FareIDWasImputed", "WaitingTimeWasImputed", "FeeWasImputed", "WaitingTimeWasCapped",
                   "PriceWasCapped"]


@query("curate", f"""
SELECT RideEstimativeID, RideID, CategoryID, UserID, "Create", {rnd('Price')} AS Price,
       {rnd('WaitingTime')} AS WaitingTime, {rnd('Fee')} AS Fee, FareID, FareIDWasImputed, WaitingTimeWasImputed,
       FeeWasImputed, WaitingTimeWasCapped, PriceWasCapped FROM vc""")
def curate(spark, sf_dir):
    """The whole sequence: coercion first, the rules, imputation and caps, and the columns that leak or are sparse last."""
    out = clean.curate(v.analytical(spark, sf_dir), v.COORDINATES, v.DEDUP_KEY, v.DEDUP_ORDER, v.MEDIANS, v.priced(spark, sf_dir)).select(*CURATED_COLUMNS)
    return out.withColumns({c: rounded(F.col(c)) for c in ("Price", "WaitingTime", "Fee")})


@query("drop_columns", """
SELECT RideEstimativeID, RideID, CategoryID, "Create", Price FROM va""")
def drop_columns(spark, sf_dir):
    df = v.analytical(spark, sf_dir).select("RideEstimativeID", "RideID", "CategoryID", "Create", "Price",
                                            "RidePrice", "ScheduledRide")
    return clean.drop_unused(df)


ROLES = {"ECONOMY": "entry", "STANDARD": "comfort", "PROMO": "premium"}


@query("label_map", """
SELECT ProductID, CASE CategoryID WHEN 'ECONOMY' THEN 'entry' WHEN 'STANDARD' THEN 'comfort'
                                  WHEN 'PROMO' THEN 'premium' ELSE 'other' END AS CategoryName FROM vp""")
def label_map(spark, sf_dir):
    return v.products(spark, sf_dir).select("ProductID", label(F.col("CategoryID"), ROLES, "other").alias("CategoryName"))


@query("lead_time", f"""
SELECT CategoryID, count(*) AS rows, {rnd('avg(abs(epoch_us("Create") - epoch_us("Schedule")) / 1e6)')} AS mean_lead_seconds,
       {big('count(*) FILTER (WHERE abs(epoch_us("Create") - epoch_us("Schedule")) > 60000000)')} AS over_60s,
       {big('count(*) FILTER (WHERE abs(epoch_us("Create") - epoch_us("Schedule")) > 300000000)')} AS over_300s
FROM vk GROUP BY 1""")
def lead_time(spark, sf_dir):
    lead = abs_seconds(F.col("Create"), F.col("Schedule"))
    return v.clock(spark, sf_dir).groupBy("CategoryID").agg(
        rows().alias("rows"), rounded(F.avg(lead)).alias("mean_lead_seconds"),
        count_if(lead > 60).alias("over_60s"), count_if(lead > 300).alias("over_300s"))


REQUIRED = ["RideID", "ProductID", "Price", "TotalUsers", "CompanyID"]


@query("schema_contract", """
SELECT 'TotalUsers' AS missing_column, count(*) AS rows FROM ve
UNION ALL SELECT 'CompanyID', count(*) FROM ve""")
def schema_contract(spark, sf_dir):
    """Required columns that the estimates lack, next to the rows concerned."""
    df = v.estimates(spark, sf_dir)
    lost = F.array(*[F.lit(c) for c in missing_columns(df, REQUIRED)])
    return df.agg(rows().alias("rows")).select(F.explode(lost).alias("missing_column"), "rows")


@query("leakage_safe_projection", f"""
SELECT RideEstimativeID, CategoryID, {rnd('Price')} AS Price, {rnd('Price_STANDARD')} AS Price_STANDARD,
       {rnd('Price_PROMO')} AS Price_PROMO, {big('UserPriorRideCount')} AS UserPriorRideCount
FROM vx WHERE CategoryID = 'ECONOMY'""")
def leakage_safe_projection(spark, sf_dir):
    df = v.enriched(spark, sf_dir).where("CategoryID = 'ECONOMY'").select(
        "RideEstimativeID", "CategoryID", "Price", "Price_ECONOMY", "Price_STANDARD", "Price_PROMO",
        "Updated", "PriceWasCapped", "UserPriorRideCount")
    safe = df.select(*leakage.leakage_safe_columns(df.columns, "Price_ECONOMY"))
    return safe.withColumns({c: rounded(F.col(c)) for c in ("Price", "Price_STANDARD", "Price_PROMO")})


@query("narrow_casts", """
SELECT RideEstimativeID, CAST(LineNo AS TINYINT) AS LineNo, CAST(WaitingTime AS INTEGER) AS WaitingTime,
       CASE WHEN trim(FareID) = '' THEN 1 WHEN FareID IS NULL THEN 1 ELSE 0 END AS FareIDMissing FROM ve""")
def narrow_casts(spark, sf_dir):
    return v.estimates(spark, sf_dir).select(
        "RideEstimativeID", F.col("LineNo").cast("byte").alias("LineNo"),
        F.col("WaitingTime").cast("int").alias("WaitingTime"),
        is_blank(F.col("FareID")).cast("int").alias("FareIDMissing"))


@query("regime_filter", """SELECT RideID, CAST("Create" AS DATE) AS CreateDate FROM vr
WHERE "Create" >= TIMESTAMP '1999-01-01'""")
def regime_filter(spark, sf_dir):
    from ..operators.folds import temporal_frame
    return temporal_frame(v.rides(spark, sf_dir), ["RideID"], v.REGIME)


@query("export_summary", f"""
SELECT CategoryID, count(*) AS rows, {big('count(*) - count("Create")')} AS null_time,
       {big('count(*) - count(Price)')} AS null_target, {big('count(*) FILTER (WHERE Price > 0)')} AS positive_target,
       min("Create") AS min_time, max("Create") AS max_time
FROM vcr WHERE CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO') GROUP BY 1""")
def export_summary(spark, sf_dir):
    return leakage.export_summary(v.curated_rows(spark, sf_dir).where(F.col("CategoryID").isin(v.TARGETS)))


def _counts():
    c = lambda cond: big(f"count(*) FILTER (WHERE {cond})")
    return {
        "source_rows": "SELECT count(*) FROM va",
        "rows_written": "SELECT count(*) FROM vc",
        "rows_removed_total": "SELECT (SELECT count(*) FROM va) - (SELECT count(*) FROM vc)",
        "retention_pct": "SELECT " + rnd("(SELECT count(*) FROM vc) * 100.0 / (SELECT count(*) FROM va)"),
        "duplicate_key_rows_removed": "SELECT (SELECT count(*) FROM va) - (SELECT count(*) FROM vs)",
        "invalid_create_or_schedule_rows_removed": f"SELECT {c('bad_time')} FROM vs",
        "updated_before_create_rows_removed": f"SELECT {c('bad_updated')} FROM vs",
        "schedule_create_gap_gt_5m_rows_removed": f"SELECT {c('bad_gap')} FROM vs",
        "missing_coordinate_rows_removed": "SELECT " + c("removed_by = 'missing_coordinate'") + " FROM vs",
        "nonpositive_price_rows_removed": "SELECT " + c("removed_by = 'nonpositive_price'") + " FROM vs",
        "WaitingTime_imputations": f"SELECT {c('WaitingTimeWasImputed')} FROM vc",
        "Fee_imputations": f"SELECT {c('FeeWasImputed')} FROM vc",
        "FareID_imputations": f"SELECT {c('FareIDWasImputed')} FROM vc",
        "WaitingTime_rows_capped": f"SELECT {c('WaitingTimeWasCapped')} FROM vc",
        "Price_rows_capped": f"SELECT {c('PriceWasCapped')} FROM vc",
    }


@query("treatment_metrics", "\nUNION ALL ".join(
    f"SELECT '{name}' AS metric, CAST(({sql}) AS DOUBLE) AS value" for name, sql in _counts().items()))
def treatment_metrics(spark, sf_dir):
    source = v.estimates(spark, sf_dir)
    stages = materialize(v.staged(spark, sf_dir), "staged")
    treated = clean.treat(stages.where("removed_by is null"), clean.thresholds(v.priced(spark, sf_dir), v.MEDIANS))
    return clean.as_metric_rows(clean.treatment_counts(source, stages, treated))


@query("treatment_thresholds", f"""
SELECT 'WaitingTime' AS feature, 'ALL' AS group_key, 0.99::DOUBLE AS quantile, {rnd('wcap')} AS upper_cap FROM vm
UNION ALL SELECT 'Price', CategoryID, 0.995::DOUBLE, {rnd('Price_cap')} FROM vcap""")
def treatment_thresholds(spark, sf_dir):
    limits = clean.thresholds(v.priced(spark, sf_dir), v.MEDIANS)
    overall = limits.overall.select(F.lit("WaitingTime").alias("feature"), F.lit("ALL").alias("group_key"),
                                    F.lit(0.99).alias("quantile"), rounded(F.col("WaitingTime_cap")).alias("upper_cap"))
    grouped = limits.by_group.select(F.lit("Price").alias("feature"), F.col("CategoryID").alias("group_key"),
                                     F.lit(0.995).alias("quantile"), rounded(F.col("Price_cap")).alias("upper_cap"))
    return overall.unionByName(grouped)


@query("capped_by_category", f"""
SELECT CategoryID, count(*) AS rows_written, {big('count(*) FILTER (WHERE PriceWasCapped)')} AS rows_capped,
       {pct('count(*) FILTER (WHERE PriceWasCapped)', 'count(*)')} AS capped_pct FROM vc GROUP BY 1""")
def capped_by_category(spark, sf_dir):
    from ..functions.scalar import share
    return v.curated(spark, sf_dir).groupBy("CategoryID").agg(
        rows().alias("rows_written"), count_if(F.col("PriceWasCapped")).alias("rows_capped"),
        share(F.col("PriceWasCapped")).alias("capped_pct"))


@query("dedupe_by_key", f"""
SELECT (SELECT count(*) FROM ve) AS rows_in, (SELECT count(*) FROM vs) AS rows_kept,
       {big('(SELECT count(*) FROM ve) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ve))')} AS exact_duplicates,
       (SELECT min(RideEstimativeID) FROM vs) AS first_id, (SELECT {rnd('sum(Price)', 2)} FROM vs) AS kept_price""")
def dedupe_by_key(spark, sf_dir):
    """First row per key, with the surplus rows and exact copies counted."""
    from ..functions.running import first_per_key
    df = v.estimates(spark, sf_dir)
    kept = first_per_key(df, v.DEDUP_KEY, v.DEDUP_ORDER)
    copies = df.groupBy(*df.columns).agg((rows() - 1).alias("n")).agg(F.sum("n")).scalar()
    return kept.agg(rows().alias("rows_kept"), F.min("RideEstimativeID").alias("first_id"),
                    rounded(F.sum("Price"), 2).alias("kept_price")).withColumns(
        {"rows_in": df.agg(rows()).scalar(), "exact_duplicates": copies})


@query("string_predicates", f"""
SELECT {big("count(*) FILTER (WHERE trim(FareID) = '')")} AS blank_fares,
       {big("count(*) FILTER (WHERE FareID IS NOT NULL AND trim(FareID) <> '')")} AS kept_fares
FROM ve""")
def string_predicates(spark, sf_dir):
    fare = F.trim("FareID")
    return v.estimates(spark, sf_dir).agg(count_if(fare == "").alias("blank_fares"),
                                          count_if(fare != "").alias("kept_fares"))


@query("guarded_ratio", f"""
SELECT RideID, coalesce({rnd('sum(Fee) / nullif(sum(OriginLat), 0)')}, 0.0) AS ratio,
       {rnd('sqrt(sum(Price))')} AS root, {rnd('abs(sum(Fee) - sum(OriginLat))')} AS distance
FROM ve GROUP BY 1""")
def guarded_ratio(spark, sf_dir):
    fee, lat = F.sum("Fee"), F.sum("OriginLat")
    return v.estimates(spark, sf_dir).groupBy("RideID").agg(
        F.coalesce(rounded(F.try_divide(fee, lat)), F.lit(0.0)).alias("ratio"),
        rounded(F.sqrt(F.sum("Price"))).alias("root"), rounded(F.abs(fee - lat)).alias("distance"))


@query("row_completeness", f"""
SELECT {big('count(*) FILTER (WHERE WaitingTime IS NOT NULL AND OriginLat IS NOT NULL)')} AS complete_rows,
       {big('count(*) FILTER (WHERE WaitingTime IS NULL OR OriginLat IS NULL)')} AS incomplete_rows,
       {rnd('sum(coalesce(WaitingTime, 0))', 2)} AS waiting_filled,
       {big('count(CASE WHEN Price > 0 THEN Price END)')} AS positive_prices FROM ve""")
def row_completeness(spark, sf_dir):
    from ..functions.scalar import all_present, any_missing
    pair = ("WaitingTime", "OriginLat")
    return v.estimates(spark, sf_dir).agg(
        count_if(all_present(*pair)).alias("complete_rows"), count_if(any_missing(*pair)).alias("incomplete_rows"),
        rounded(F.sum(F.coalesce("WaitingTime", F.lit(0))), 2).alias("waiting_filled"),
        F.count(F.when(F.col("Price") > 0, F.col("Price"))).alias("positive_prices"))


@query("weekday_names", """
SELECT RideID, (['segunda', 'terca', 'quarta', 'quinta', 'sexta', 'sabado', 'domingo'])[isodow("Create")] AS name_pt,
       dayname("Create") AS name_en FROM vk""")
def weekday_names(spark, sf_dir):
    ts = F.col("Create")
    return v.clock(spark, sf_dir).select("RideID", calendar.weekday_name(ts).alias("name_pt"),
                                         calendar.weekday_name(ts, WEEKDAY_EN).alias("name_en"))
