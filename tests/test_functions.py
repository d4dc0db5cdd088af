from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fareforge.functions import calendar, scalar
from fareforge.functions.bounded import lookup_join
from fareforge.functions.quantiles import group_quantiles
from fareforge.functions.running import first_per_key, prefix_scan, running_before, time_levels


def pdf(df, *order):
    out = df.toPandas()
    return out.sort_values(list(order)).reset_index(drop=True) if order else out


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds a third of the rows; values repeat, are null and NaN here and there."""
    rng = np.random.default_rng(7)
    n = 6000
    g = np.where(np.arange(n) % 3 == 0, "hot", rng.integers(0, 40, n).astype(str))
    v = np.round(rng.exponential(50, n), 2)
    v[rng.integers(0, n, 100)] = 5.0
    frame = pd.DataFrame({"g": g, "v": v, "id": np.arange(n)})
    frame.loc[::50, "v"] = np.nan
    return frame


PROBS = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.995, "f": 1.0}


def test_quantiles_match_pandas(spark, skewed):
    df = spark.createDataFrame(skewed)
    got = pdf(group_quantiles(df, ["g"], "v", PROBS), "g")
    want = skewed.groupby("g")["v"].quantile(list(PROBS.values())).unstack().sort_index()
    assert list(got["g"]) == list(want.index)
    for name, p in PROBS.items():
        np.testing.assert_allclose(got[name], want[p], rtol=1e-12)


def test_quantiles_without_group_and_tiny_groups(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 7.0), (None, 4.0)], "g string, v double")
    one = group_quantiles(df, [], "v", {"m": 0.5, "t": 0.995}).first()
    assert one.m == 3.5 and one.t == pytest.approx(np.quantile([1, 3, 7, 4], 0.995))
    per = {r.g: r.t for r in group_quantiles(df, ["g"], "v", {"t": 0.995}).collect()}
    assert per == pytest.approx({"x": 2.99, "y": 7.0, None: 4.0})


def test_quantiles_of_many_distinct_values(spark):
    df = spark.range(50_000).select(((F.col("id") * 7919) % 50_000).cast("double").alias("v"))
    got = group_quantiles(df, [], "v", {"q": 0.3333, "r": 0.99}).first()
    assert got.q == pytest.approx(np.quantile(np.arange(50_000), 0.3333))
    assert got.r == pytest.approx(np.quantile(np.arange(50_000), 0.99))


@pytest.mark.parametrize("block", [1, 16, 65_536])
def test_running_before_matches_brute_force(spark, block):
    rng = np.random.default_rng(3)
    n = 3000
    # a third of the rows belong to one user, and half of those to one moment
    base = pd.DataFrame({
        "user": np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 50, n)), "id": np.arange(n),
        "ts": pd.Timestamp("2021-08-17") + pd.to_timedelta(rng.integers(0, 4 * 24 * 12, n) * 5, unit="min"),
        "v": np.round(rng.uniform(0, 9, n), 2)})
    base.loc[::6, "ts"] = pd.Timestamp("2021-08-18 12:00")
    df = spark.createDataFrame(base).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = pdf(running_before(df, ["user"], ["ts", "id"], {"n": F.lit(1), "s": F.col("v")}, time_levels("ts", "id", block)), "id")
    want = base.sort_values(["user", "ts", "id"])
    want["n"] = want.groupby("user").cumcount()
    want["s"] = want.groupby("user")["v"].cumsum() - want["v"]
    want = want.sort_values("id")
    assert list(out["n"]) == list(want["n"])
    np.testing.assert_allclose(out["s"], want["s"], atol=1e-9)


def test_running_before_rejects_null_keys(spark):
    df = spark.createDataFrame([(None, 1)], "user int, ts int")
    with pytest.raises(Exception, match="null key user"):
        running_before(df, ["user"], ["ts"], {"n": F.lit(1)}, [F.col("ts")]).collect()


def test_first_per_key_prunes_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 9)], "k int, o int")
    out = first_per_key(df, ["k"], ["o"])
    out.explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2
    assert sorted(map(tuple, out.collect())) == [(1, 2), (2, 9)]


def test_lookup_matches_null_keys_on_request(spark):
    fact, dim = (spark.createDataFrame([(1, "a"), (None, "b")], f"k int, {c} string") for c in ("x", "y"))
    assert lookup_join(fact, dim, "k").where("y is not null").count() == 1
    assert lookup_join(fact, dim, "k", null_safe=True).where("y is not null").count() == 2


def test_rounding_and_percentages(spark):
    row = spark.range(1).select(
        scalar.rounded(F.lit(2.675), 2).alias("a"), scalar.rounded(F.lit(None).cast("double")).alias("b"),
        scalar.pct(F.lit(1), F.lit(0)).alias("c"), scalar.pct(F.lit(1), F.lit(3)).alias("d")).first()
    assert (row.a, row.b, row.c, row.d) == (2.68, None, 0.0, 33.3333)


def test_adjusted_skewness(spark, skewed):
    got = spark.createDataFrame(skewed.dropna()).agg(scalar.adjusted_skewness(F.col("v"))).first()[0]
    assert got == pytest.approx(skewed["v"].skew(), rel=1e-9)


def test_holidays():
    assert calendar.easter_sunday(2021) == date(2021, 4, 4)
    assert calendar.easter_sunday(2024) == date(2024, 3, 31)
    assert calendar.easter_sunday(2038) == date(2038, 4, 25)
    assert calendar.easter_sunday(1954) == date(1954, 4, 18)
    days = calendar.holiday_dates()
    assert date(2022, 4, 15) in days and date(2023, 11, 20) not in days and date(2024, 11, 20) in days
    assert date(2022, 3, 1) not in days and len(days) == 11 * 9 + 7


def test_calendar_columns(spark):
    df = spark.sql("select timestamp_ntz'2021-11-02 18:30:00' as Create")
    row = calendar.add_temporal_features(df, ["Create"]).first()
    assert (row.CreateHour, row.CreateDayOfWeek, row.CreateDayOfWeekName, row.CreateMonth, row.CreateQuarter,
            row.CreateIsHolidayBR, row.CreateDayPeriod) == (18, 1, "terca", 11, 4, True, "noite")


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_prefix_scan_matches_brute_force(spark, parts):
    """One user holds most rows, many of them at one moment, so its rows lie in many ranges."""
    rows = [(i, "hot" if i % 5 else f"u{i % 7}", f"k{i % 2}", 1000 + (i * 37 % 11 if i % 3 else 5), None if i % 6 == 0 else (i % 13) / 10 - 0.35)
            for i in range(900)]
    df = spark.createDataFrame(rows, "id int, user string, kind string, ts int, v double").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        for keys in (["user"], ["user", "kind"]):
            out = prefix_scan(df, keys, ["ts", "id"], {"n": F.lit(1), "s": F.col("v"), "m": F.col("v").isNotNull().cast("int")}).collect()
            assert len(out) == len(rows)
            for r in out:
                earlier = [x for x in rows if (x[3], x[0]) < (r.ts, r.id) and all(x[{"user": 1, "kind": 2}[k]] == r[k] for k in keys)]
                assert (r.n, r.m) == (len(earlier), sum(x[4] is not None for x in earlier))
                assert abs(r.s - sum(x[4] or 0 for x in earlier)) < 1e-9
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_prefix_scan_of_nothing_and_null_keys(spark):
    empty = spark.createDataFrame([], "user string, ts int")
    assert prefix_scan(empty, ["user"], ["ts"], {"n": F.lit(1)}).collect() == []
    with pytest.raises(Exception, match="null key"):
        prefix_scan(spark.createDataFrame([(None, 1)], "user string, ts int"), ["user"], ["ts"], {"n": F.lit(1)}).collect()
