"""Time folds."""
from pyspark.sql import functions as F

from ..functions.scalar import rows
from ..operators import folds, leakage
from . import views as v
from .registry import big, query


@query("temporal_frame", """
SELECT RideEstimativeID, RideID, CategoryID, "Create", CreateDate FROM vf""")
def temporal_frame(spark, sf_dir):
    return v.fold_frame(spark, sf_dir).orderBy("CreateDate", "Create", "RideID", "RideEstimativeID")


@query("date_positions", """
SELECT day, pos AS position, n - 1 - pos AS from_end FROM fd""")
def date_positions(spark, sf_dir):
    return folds.date_positions(v.fold_frame(spark, sf_dir))


@query("coverage_guard", """
SELECT count(*) AS observed_dates, CAST(155 AS BIGINT) AS required_dates, count(*) >= 155 AS enough FROM fd""")
def coverage_guard(spark, sf_dir):
    return folds.coverage_guard(folds.date_positions(v.fold_frame(spark, sf_dir)), v.CONFIG)


WINDOW = """split_name, split_type, CAST(number AS INTEGER) AS number, train_start, train_end, gap_start, gap_end,
  evaluation_start, evaluation_end"""


@query("holdout_window", f"SELECT {WINDOW} FROM fw WHERE split_type = 'holdout'")
def holdout_window(spark, sf_dir):
    positions = folds.date_positions(v.fold_frame(spark, sf_dir))
    return folds.split_windows_frame(positions, v.CONFIG).where("split_type = 'holdout'").drop("dates")


@query("expanding_folds", f"SELECT {WINDOW} FROM fw WHERE split_type = 'cv'")
def expanding_folds(spark, sf_dir):
    positions = folds.date_positions(v.fold_frame(spark, sf_dir))
    return folds.split_windows_frame(positions, v.CONFIG).where("split_type = 'cv'").drop("dates")


def _windows(frame):
    return folds.split_windows(frame, v.CONFIG)


@query("assign_folds", """
SELECT split_name, role, count(*) AS rows FROM fa WHERE role IS NOT NULL GROUP BY 1, 2""")
def assign_folds(spark, sf_dir):
    frame = v.fold_layer(spark, sf_dir)
    return folds.role_counts(frame, _windows(frame))


def _summary_sql(category):
    return f"""SELECT {category} AS CategoryID, split_name, split_type, train_start, train_end, gap_start, gap_end,
  evaluation_start, evaluation_end,
  {big("count(DISTINCT CreateDate) FILTER (WHERE role = 'train')")} AS train_days, {big('any_value(gap_end - gap_start + 1)')} AS gap_days,
  {big("count(DISTINCT CreateDate) FILTER (WHERE role = 'eval')")} AS evaluation_days,
  {big("count(*) FILTER (WHERE role = 'train')")} AS train_rows, {big("count(*) FILTER (WHERE role = 'eval')")} AS evaluation_rows,
  {big("count(DISTINCT RideID) FILTER (WHERE role = 'train')")} AS train_unique_rides,
  {big("count(DISTINCT RideID) FILTER (WHERE role = 'eval')")} AS evaluation_unique_rides,
  {big('(SELECT count(*) FROM (SELECT RideID FROM fa f WHERE f.split_name = fa.split_name GROUP BY 1 HAVING count(*) FILTER (WHERE role = ' + chr(39) + 'train' + chr(39) + ') > 0 AND count(*) FILTER (WHERE role = ' + chr(39) + 'eval' + chr(39) + ') > 0))')} AS ride_overlap
FROM fa {{where}} GROUP BY ALL"""


SUMMARY = (_summary_sql("'ALL'").replace("{where}", "") + "\nUNION ALL "
           + _summary_sql("CategoryID").replace("{where}", "WHERE CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO')"))


def _both(spark, sf_dir):
    frame = v.fold_layer(spark, sf_dir)
    windows = _windows(frame)
    overall = folds.split_summary(frame, windows).withColumn("CategoryID", F.lit("ALL"))
    return overall.unionByName(folds.split_summary(frame, windows, v.TARGETS))


@query("split_summary", SUMMARY)
def split_summary(spark, sf_dir):
    return folds.guarded(_both(spark, sf_dir)).select("CategoryID", *folds.SUMMARY_COLUMNS)


CHECKS = """SELECT CategoryID, split_name, train_rows, evaluation_rows, ride_overlap, CAST(0 AS BIGINT) AS index_overlap,
  train_end < evaluation_start AS temporal_order_ok, train_end < evaluation_start AS timestamp_order_ok,
  gap_start > train_end AND evaluation_start > gap_end AS gap_order_ok,
  train_end < evaluation_start AND gap_start > train_end AND evaluation_start > gap_end AND ride_overlap = 0 AS fold_valid"""


def _checks(spark, sf_dir):
    return folds.require_valid_folds(folds.fold_checks(_both(spark, sf_dir)))


@query("fold_validity", f"{CHECKS} FROM ({SUMMARY})")
def fold_validity(spark, sf_dir):
    return _checks(spark, sf_dir).select(
        "CategoryID", "split_name", "train_rows", "evaluation_rows", "ride_overlap", "index_overlap",
        "temporal_order_ok", "timestamp_order_ok", "gap_order_ok", "fold_valid")


@query("leakage_totals", f"""
SELECT count(*) AS folds_checked, {big('count(*) FILTER (WHERE NOT fold_valid)')} AS invalid_folds,
       {big('sum(ride_overlap)')} AS ride_overlap_total, {big('sum(index_overlap)')} AS index_overlap_total
FROM ({CHECKS} FROM ({SUMMARY}))""")
def leakage_totals(spark, sf_dir):
    return leakage.fold_totals(_checks(spark, sf_dir))


@query("regime_totals", """
SELECT coalesce(CategoryID, 'ALL') AS CategoryID, count(DISTINCT CreateDate) AS dates, count(*) AS rows,
       count(DISTINCT RideID) AS unique_rides
FROM vf WHERE CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO') GROUP BY GROUPING SETS ((), (CategoryID))""")
def regime_totals(spark, sf_dir):
    """Dates, rows and rides overall and per category, from one aggregate per (category, ride, date)."""
    frame = v.fold_frame(spark, sf_dir).where(F.col("CategoryID").isin(v.TARGETS))
    fine = frame.groupBy("CategoryID", "RideID", "CreateDate").agg(rows().alias("n"))

    def level(group):
        rides = fine.groupBy(*group, "RideID").agg(F.sum("n").alias("n")).groupBy(*group).agg(
            F.sum("n").alias("rows"), rows().alias("unique_rides"))
        dates = fine.select(*group, "CreateDate").distinct().groupBy(*group).agg(rows().alias("dates"))
        if group:
            return rides.join(dates, group)
        return rides.withColumn("dates", dates.scalar()).withColumn("CategoryID", F.lit("ALL"))
    return level(["CategoryID"]).unionByName(level([]))
