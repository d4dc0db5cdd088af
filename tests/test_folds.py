from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fareforge.operators import folds
from fareforge.operators.checks import ContractError

# The five published windows of 226 days from 2021-11-01.
GOLDEN = [
    ("fold_1", "2021-11-01", "2022-01-11", "2022-01-12", "2022-01-18", "2022-01-19", "2022-02-15"),
    ("fold_2", "2021-11-01", "2022-02-08", "2022-02-09", "2022-02-15", "2022-02-16", "2022-03-15"),
    ("fold_3", "2021-11-01", "2022-03-08", "2022-03-09", "2022-03-15", "2022-03-16", "2022-04-12"),
    ("fold_4", "2021-11-01", "2022-04-05", "2022-04-06", "2022-04-12", "2022-04-13", "2022-05-10"),
    ("holdout_test", "2021-11-01", "2022-05-10", "2022-05-11", "2022-05-17", "2022-05-18", "2022-06-14"),
]


def days(spark, n, start=date(2021, 11, 1)):
    rows = [(str(start + timedelta(days=i)),) for i in range(n)]
    df = spark.createDataFrame(rows, "d string").select(F.col("d").cast("timestamp_ntz").alias("Create"))
    return df.withColumns({"RideEstimativeID": F.monotonically_increasing_id(), "RideID": F.monotonically_increasing_id(),
                           "CategoryID": F.lit("A")})


def frame_of(df):
    return folds.temporal_frame(df, ["RideEstimativeID", "RideID", "CategoryID", "Create"])


def test_golden_windows(spark):
    windows = folds.split_windows(frame_of(days(spark, 226)))
    got = [(w.name, *map(str, (w.train_start, w.train_end, w.gap_start, w.gap_end, w.evaluation_start, w.evaluation_end))) for w in windows]
    assert got == GOLDEN


def test_too_few_dates(spark):
    assert folds.SplitConfig().min_dates == 155
    with pytest.raises(ContractError):
        folds.split_windows(frame_of(days(spark, 154)))
    assert len(folds.split_windows(frame_of(days(spark, 155)))) == 5


def test_regime_filter(spark):
    assert frame_of(days(spark, 10, date(2021, 10, 30))).count() == 8


@pytest.mark.parametrize("category", [None, "A"])
def test_order_gap_and_overlap(spark, category):
    """Both sides filled, train before evaluation, gap strictly between, no shared rows or rides."""
    frame = frame_of(days(spark, 226))
    for w in folds.split_windows(frame):
        rows = frame if category is None else frame.where(F.col("CategoryID") == category)
        train, held = folds.train_rows(rows, w), folds.evaluation_rows(rows, w)
        a = train.agg(F.max("CreateDate"), F.count("*")).first()
        b = held.agg(F.min("CreateDate"), F.count("*")).first()
        assert a[1] > 0 and b[1] == 28 and a[0] < w.gap_start <= w.gap_end < b[0]
        assert train.join(held, "RideID", "left_semi").count() == 0
        assert train.join(held, "RideEstimativeID", "left_semi").count() == 0


def test_summary_and_checks(spark):
    frame = frame_of(days(spark, 226))
    windows = folds.split_windows(frame)
    checks = folds.fold_checks(folds.guarded(folds.split_summary(frame, windows, ["A"])))
    assert checks.where("fold_valid").count() == 5
    first = checks.where("split_name = 'fold_1'").first()
    assert (first.train_days, first.gap_days, first.evaluation_days, first.train_rows) == (72, 7, 28, 72)


def test_ride_on_both_sides_is_found(spark):
    df = days(spark, 226).withColumn("RideID", F.lit(1))
    frame = frame_of(df)
    windows = folds.split_windows(frame)
    summary = folds.split_summary(frame, windows)
    assert folds.fold_checks(summary).where("fold_valid").count() == 0
    with pytest.raises(Exception, match="fold cannot be used"):
        folds.guarded(summary).collect()


def test_marks_agree_with_windows(spark):
    frame = frame_of(days(spark, 226))
    windows = folds.split_windows(frame)
    marked = folds.mark_folds(frame, windows)
    for w in windows:
        assert marked.where(F.col("train_from") <= w.number).count() == folds.train_rows(frame, w).count()
        assert marked.where(F.col("evaluated_in") == w.number).count() == folds.evaluation_rows(frame, w).count()
