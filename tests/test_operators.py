import datetime as dt
import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fareforge import fixed
from fareforge.operators import checks, clean, correlation, evaluate, history, joins, leakage, profiling, sampling, target, temporal
from fareforge.operators.checks import ContractError
from fareforge.session import scratch_path
from fareforge.sources import delimited, layers


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_delimited_missing_tokens(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id;v;t;Phone\n1;NULL;a;1\n2;;b;1\n3;nan;c;1\n4;NA;d;1\n5;None;e;1\n6;7.5;f;1\n7;x;"q;z";1\n')
    df = delimited.read_delimited(spark, str(tmp_path / "f.csv"), {"id": "bigint", "v": "double"}, {"t": "text"})
    assert df.columns == ["id", "v", "text"]
    got = {r.id: (r.v, r.text) for r in df.collect()}
    assert [got[i][0] for i in range(1, 8)] == [None] * 5 + [7.5, None] and got[7][1] == "q;z"
    assert delimited.header_columns(spark, str(tmp_path / "f.csv")) == ["id", "v", "t", "Phone"]


def test_source_readers(spark, tmp_path):
    (tmp_path / "ride.csv").write_text("RideID;UserID;Schedule;Create;price;CategoryID;Driver\n"
                                       "1;u;2021-08-17 10:09:45.6425825;bad;12.5;2.0;joe\n")
    row = delimited.read_rides(spark, str(tmp_path / "ride.csv")).first()
    assert str(row.Schedule) == "2021-08-17 10:09:45.642582" and row.Create is None
    assert row.RidePrice == 12.5 and row.RideCategoryID == 2 and "Driver" not in row.asDict()


def test_layer_round_trip_and_reconciliation(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 7).alias("CategoryID"))
    calls = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            calls.add(len(b))
            yield b
    back, seen = layers.write_reconciled(df.mapInPandas(once, df.schema), scratch_path(spark, "t"), observed={"twos": F.count_if(F.col("CategoryID") == 2)})
    assert back.count() == 1000 and calls.value == 1000  # the source is evaluated once
    assert seen == {"rows": 1000, "twos": df.where("CategoryID = 2").count()}
    path = scratch_path(spark, "t")
    layers.write_layer(df, path)
    assert layers.read_layer(spark, path, ["id"], [2]).count() == seen["twos"]
    assert not layers.reconcile(999, back).first().reconciled


def exported(spark, rows):
    schema = "RideID long, CategoryID string, Create timestamp_ntz, Price double, Price_A double, Price_B double"
    return spark.createDataFrame(rows, schema).repartition(4)


def test_final_export_is_sorted_and_observed(spark):
    day = lambda i: dt.datetime(2021, 1, 1) + dt.timedelta(hours=i * 7 % 500)
    rows = [(i, "AB"[i % 2], day(i), float(i % 9), None if i % 2 == 0 else 1.0, None if i % 2 else 2.0) for i in range(700)] + [(9, "C", day(1), 1.0, None, None)]
    path = scratch_path(spark, "final")
    seen = layers.export_final(exported(spark, rows), path, ["A", "B"], ["Create", "RideID"], {"A": "Price_A", "B": "Price_B"})
    assert seen["A"] == {"rows": 350, "positive": sum(r[3] > 0 for r in rows[:700:2]), "first": day(0), "last": max(r[2] for r in rows[:700:2])}
    for c in "AB":
        found = []
        for name in sorted(os.listdir(f"{path}/CategoryID={c}")):
            if name.startswith("part-"):
                found += [(r.Create, r.RideID) for r in spark.read.parquet(f"{path}/CategoryID={c}/{name}").coalesce(1).collect()]
        assert found == sorted((r[2], r[0]) for r in rows if r[1] == c)


@pytest.mark.parametrize("row,message", [
    ((1, "A", None, 1.0, None, 2.0), "null Create"), ((1, "A", dt.datetime(2021, 1, 1), None, None, 2.0), "null Price"),
    ((1, "A", dt.datetime(2021, 1, 1), 1.0, 5.0, 2.0), "own price left")])
def test_final_export_stops_at_a_broken_contract(spark, row, message):
    good = (2, "B", dt.datetime(2021, 1, 1), 1.0, 1.0, None)
    with pytest.raises(Exception, match=message):
        layers.export_final(exported(spark, [row, good]), scratch_path(spark, "final"), ["A", "B"], ["Create", "RideID"], {"A": "Price_A", "B": "Price_B"})


def test_final_export_needs_rows_of_every_category(spark):
    with pytest.raises(ContractError, match="no rows to export"):
        layers.export_final(exported(spark, [(2, "B", dt.datetime(2021, 1, 1), 1.0, 1.0, None)]), scratch_path(spark, "final"), ["A", "B"], ["Create", "RideID"])


def test_caps_and_missing_threshold(spark):
    df = spark.createDataFrame([("A", float(i)) for i in range(1, 201)] + [("B", 5.0), ("A", None)], "CategoryID string, Price double")
    caps = spark.createDataFrame([("A", float(np.quantile(np.arange(1, 201), 0.995)))], "CategoryID string, Price_cap double")
    out = clean.cap_by_group(df.where("CategoryID = 'A'"), caps)
    assert out.where("PriceWasCapped").count() == 1 and out.agg(F.max("Price")).first()[0] == pytest.approx(199.005)
    assert out.where("Price is null").count() == 1
    assert rows_of(clean.uncapped_groups(df, caps, "CategoryID")) == [("B",)]


def test_nonpositive_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(math.nan,), (None,), (-1.0,), (0.0,), (1.0,)], "Price double")
    assert clean.coerce_numeric(df, ["Price"]).where(clean.not_nonpositive("Price")).count() == 3


def test_chronology_rules_are_independent(spark):
    df = spark.sql("""select * from values
      (1, timestamp_ntz'2021-01-01 10:00:00', timestamp_ntz'2021-01-01 10:00:00', timestamp_ntz'2021-01-01 11:00:00', 0),
      (2, timestamp_ntz'2021-01-01 10:00:00', timestamp_ntz'2021-01-01 09:00:00', timestamp_ntz'2021-01-01 08:00:00', null),
      (3, timestamp_ntz'2021-01-01 10:00:00', timestamp_ntz'2021-01-01 09:00:00', null, 1),
      (4, null, timestamp_ntz'2021-01-01 09:00:00', null, 0) as t(id, Create, Schedule, Updated, ScheduledRide)""")
    flags = {r.id: (r.a, r.b, r.c) for r in df.select("id", *[
        e.alias(n) for n, e in zip("abc", clean.chronology_flags().values())]).collect()}
    assert flags == {1: (False, False, False), 2: (False, True, True), 3: (False, False, False), 4: (True, False, False)}


def test_curation_counts(spark):
    base = [(i, i % 5, "A" if i % 2 else "B", float(i), None if i % 4 == 0 else float(i % 9), None if i % 3 == 0 else "f", 1.0)
            for i in range(1, 101)] + [(1, 1, "A", 1.0, 1.0, "f", 1.0), (200, 0, "A", 0.0, 1.0, "f", 1.0), (201, 0, "A", 3.0, 1.0, "f", None)]
    df = spark.createDataFrame(base, "RideEstimativeID int, RideID int, CategoryID string, Price double, WaitingTime double, FareID string, Lat double")
    df = df.withColumns({c: F.lit("2021-01-01").cast("timestamp_ntz") for c in ("Create", "Schedule", "Updated")}).withColumn("ScheduledRide", F.lit(0))
    stages = clean.staged(df, ["Lat"], ["RideEstimativeID"], ["Price"])
    limits = clean.thresholds(df, ["WaitingTime"])
    treated = clean.treat(stages.where("removed_by is null"), limits)
    m = {r.metric: r.value for r in clean.as_metric_rows(clean.treatment_counts(df, stages, treated)).collect()}
    assert m["source_rows"] == 103 and m["duplicate_key_rows_removed"] == 1 and m["rows_written"] == 100
    assert m["missing_coordinate_rows_removed"] == 1 and m["nonpositive_price_rows_removed"] == 1
    assert m["WaitingTime_imputations"] == 25 and m["FareID_imputations"] == 33 and m["Price_rows_capped"] == 2
    whole = clean.curate(df, ["Lat"], ["RideEstimativeID"], ["Price"], ["WaitingTime"])
    assert whole.count() == 100 and "removed_by" not in whole.columns
    safe = clean.curate(df, ["Lat"], ["RideEstimativeID"], ["Price"], ["WaitingTime"], fit_on=df.where("Price < 50"))
    assert safe.agg(F.max("Price")).first()[0] < 50


def test_addresses_and_contracts(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (2, 1, 12), (3, 2, 13)], "RideID bigint, RideAddressTypeID bigint, AddressID bigint")
    wide = joins.split_addresses(joins.require_addresses(df))
    assert rows_of(wide.groupBy("side").count()) == [("both", 1), ("left_only", 1), ("right_only", 1)]
    with pytest.raises(checks.ContractError):
        joins.require_addresses(df.union(spark.createDataFrame([(4, 3, 1)], df.schema)))
    with pytest.raises(checks.ContractError):
        joins.require_addresses(df.union(spark.createDataFrame([(1, 1, 1)], df.schema)))


def test_dimension_contracts(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    good = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, x string")
    assert joins.merge_dimension(fact, good, "k", "dim").count() == 3
    for bad in ([(1, "a")], [(1, "a"), (1, "b"), (2, "c")]):
        with pytest.raises(Exception, match="in dimension"):
            joins.merge_dimension(fact, spark.createDataFrame(bad, good.schema), "k", "dim").collect()
    with pytest.raises(Exception, match="missing in dimension null"):
        joins.merge_dimension(fact.union(spark.createDataFrame([(None,)], "k int")), good, "k", "dim").collect()
    some = joins.merge_dimension(fact, good.where("k = 1"), "k", "dim", required=False)
    assert rows_of(some) == [(1, "a"), (1, "a"), (2, None)]
    with pytest.raises(checks.ContractError, match="missing columns: z"):
        checks.require_columns(good, ["k", "z"])


def test_zero_iqr(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 5.0, 5.0, 5.0, 9.0])], "id int, v double")
    row = profiling.iqr_outliers(df, ["v"], min_uniques=1).first()
    assert (row.iqr, row.lower_bound, row.upper_bound, row.outlier_count) == (0.0, 5.0, 5.0, 0)
    stats = target.target_stats(df.withColumn("CategoryID", F.lit(1)), value="v").first()
    assert (stats.mild_lower, stats.mild_upper, stats.mild_count) == (5.0, 5.0, 1)


def test_constant_and_null_columns(spark):
    df = spark.createDataFrame([(1, 1, None, 1), (2, 1, None, None)], "a int, b int, c int, d int")
    assert rows_of(profiling.constant_columns(df)) == [("b",), ("c",)]
    assert rows_of(profiling.high_null_columns(profiling.null_profile(df)).select("column", "level")) == [("c", "critical"), ("d", "moderate")]


def test_cross_prices_take_the_smallest_id(spark):
    df = spark.createDataFrame([(1, "A", 5, 9.0), (1, "A", 3, 7.0), (1, "B", 4, 8.0), (2, "Z", 1, 1.0)],
                               "RideID int, ProductID string, RideEstimativeID int, Price double")
    got = history.cross_prices(df, ["A", "B", "C"])
    assert got.columns == ["RideID", "Price_A", "Price_B", "Price_C"] and rows_of(got) == [(1, 7.0, 8.0, None)]
    m = history.cross_price_metrics(df, ["A", "B", "C"]).first()
    assert (m.canonical_source_rows, m.canonical_unique_ride_ids, m.canonical_duplicate_rows_collapsed, m.rides_with_all_canonical_prices) == (3, 1, 1, 0)


def test_user_history(spark):
    df = spark.sql("""select * from values (1, 'u', timestamp_ntz'2021-01-01', 10.0D), (2, 'u', timestamp_ntz'2021-01-02', 0.0D),
      (3, 'u', timestamp_ntz'2021-01-03', 30.0D), (4, 'u', timestamp_ntz'2021-01-03', 5.0D) as t(RideID, UserID, Create, RidePrice)""")
    out = history.user_history(df).orderBy("RideID").collect()
    assert [r.UserPriorRideCount for r in out] == [0, 1, 2, 3]
    assert [r.UserPriorPaidPriceMean for r in out] == [None, 10.0, 10.0, 20.0]


def test_gaps(spark):
    days = lambda xs: spark.createDataFrame([(f"2021-01-{x:02d}",) for x in xs], "d string").select(F.col("d").cast("timestamp_ntz").alias("Create"))
    got = [(str(r.gap_start), str(r.gap_end), r.missing_days) for r in temporal.calendar_gaps(days([1, 2, 5, 6, 9])).orderBy("gap_start").collect()]
    assert got == [("2021-01-03", "2021-01-04", 2), ("2021-01-07", "2021-01-08", 2)]
    assert rows_of(temporal.calendar_gaps(days([1, 2, 3]))) == [(None, None, 0)]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (4.0, 3.0)], "y double, p double")
    m = evaluate.regression_metrics(F.col("y"), F.col("p"))
    row = df.agg(*[e.alias(n) for n, e in m.items()]).first()
    assert (row.MAE, row.RMSE, row.MAPE, row.R2) == pytest.approx((2 / 3, math.sqrt(2 / 3), 25.0, 1 - 2 / (14 / 3)))


def test_null_group_keys_survive(spark):
    cols = "CategoryID string, DatasetName string, Algorithm string, AlgorithmGroup string, ModelVariant string, FeatureCount int, " \
           "NumBoostRound int, TrialNumber bigint, SourceFile string, FoldName string, TrainRows bigint, EvaluationRows bigint, TrainStart date, TrainEnd date, EvaluationStart date, EvaluationEnd date, " \
           "MAE double, RMSE double, MAPE double, R2 double"
    line = lambda f, t: ("A", "d", "m", "g", "v", 1, None, t, "s", f, 1, 1, None, None, None, None, 1.0, 1.0, 1.0, 1.0)
    df = spark.createDataFrame([line("f1", None), line("f2", None), line("f1", 3)], cols)
    assert evaluate.results_table(df).where("RowType = 'mean'").count() == 2


def test_stratified_sample_is_exact_and_stable(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"), "id")
    a = sampling.stratified_sample(df, "g", "id", 100)
    b = sampling.stratified_sample(df.repartition(5), "g", "id", 100)
    assert rows_of(a) == rows_of(b)
    assert {r["count"] for r in a.groupBy("g").count().collect()} == {100}
    everything = sampling.stratified_sample(df, "g", "id", 10**6)
    assert everything.count() == 5000


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc"))
    frame.loc[::7, "b"] = None
    frame["c"] = frame["a"] * 2 + 0.01 * frame["c"]
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "a double, b double, c double")
    want = frame.corr()
    got = {(r.feature, r.other): r["corr"] for r in correlation.correlation_matrix(df, list("abc")).collect()}
    assert len(got) == 9
    for (x, y), r in got.items():
        assert r == pytest.approx(want.loc[x, y], abs=1e-5)
    assert [tuple(r)[:2] for r in correlation.multicollinear_pairs(df, list("abc"), "b").collect()] == [("a", "c")]


def test_consistency_counts_catch_errors(spark):
    df = spark.sql("""select * from values (1, 10, 'A', 'u', timestamp_ntz'2021-01-01', 0, 0, null, null),
      (2, 11, 'A', 'u', timestamp_ntz'2021-01-02', 1, 1, 5.0D, null), (3, 11, 'A', 'u', timestamp_ntz'2021-01-02', 7, 1, 5.0D, 5.0D)
      as t(RideEstimativeID, RideID, CategoryID, UserID, Create, UserPriorRideCount, UserPriorCategoryRideCount, UserPriorPaidPriceMean, UserPriorCategoryPriceMean)""")
    got = {r.metric: r.value for r in leakage.history_consistency(df).collect()}
    assert got["ride_level_prior_count_inconsistencies"] == 1 and got["prior_ride_count_mismatch_rows"] == 0
    assert got["rows_with_prior_category_count_and_null_mean"] == 1


def test_leakage_safe_columns():
    cols = ["Price", "UpdatedHour", "PriceWasCapped", "Price_A", "Price_B", "CreateHour"]
    assert leakage.leakage_safe_columns(cols, "Price_A") == ["Price", "Price_B", "CreateHour"]


def test_fixed_values():
    assert len(fixed.NUMERIC_FEATURES) == 22 and len(fixed.BOOLEAN_FEATURES) == 4


def test_contracts_stop_the_run(spark):
    """Each broken contract fails when the plan runs, none needs a job of its own."""
    from fareforge.functions.calendar import add_temporal_features
    from fareforge.operators import folds, leakage
    one = spark.createDataFrame([("A", 5.0), ("B", 7.0)], "CategoryID string, Price double")
    caps = spark.createDataFrame([("A", 4.0)], "CategoryID string, Price_cap double")
    plans = {
        "group without a cap: B": clean.cap_by_group(one, caps),
        "null Create": folds.temporal_frame(spark.sql("select cast(null as timestamp_ntz) as Create, 1 as RideID"), ["RideID"]),
        "null Schedule": add_temporal_features(spark.sql("select cast(null as timestamp_ntz) as Schedule"), ("Schedule",)),
        "invalid fold: fold_2": folds.require_valid_folds(spark.sql("select 'fold_2' as split_name, false as fold_valid")),
        "inconsistent history: x": leakage.require_consistent(spark.sql("select 'x' as metric, 3L as value")),
        "row without user history": history.require_history(
            spark.sql("select cast(null as bigint) as UserPriorRideCount, 1L as UserPriorCategoryRideCount")),
        "product without a category: 9": joins.build_analytical(
            spark.sql("select 1L as RideID, 9L as ProductID, 2.0D as Price"), spark.sql("select 1L as RideID, 4L as UserID"),
            spark.sql("select 9L as ProductID, cast(null as string) as CategoryID"),
            spark.sql("select 1L as RideID, 1L as RideAddressTypeID, 5L as AddressID")),
    }
    for message, plan in plans.items():
        with pytest.raises(Exception, match=message):
            plan.collect()
    fine = leakage.require_consistent(spark.sql(f"select '{leakage.INFORMATIONAL}' as metric, 3L as value"))
    assert fine.first().value == 3
