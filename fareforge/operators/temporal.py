"""Time coverage, gaps, daily and seasonal metrics, integrity rules."""
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.calendar import weekday_name
from ..functions.quantiles import group_quantiles
from ..functions.scalar import count_if, pct, rounded, rows, seconds_between


def coverage(df: DataFrame, table: str, fields: list[str]) -> DataFrame:
    """One row per time field: rows, span, nulls, distinct dates. Distinct dates are bounded by the calendar."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("time_field"), F.col(f).cast("timestamp_ntz").alias("ts")) for f in fields
    ])).alias("_r")).select("_r.*")
    by_day = long.groupBy("time_field", F.to_date("ts").alias("_day")).agg(
        rows().alias("_n"), F.min("ts").alias("_min"), F.max("ts").alias("_max"))
    return by_day.groupBy(F.lit(table).alias("table_name"), "time_field").agg(
        F.sum("_n").alias("row_count"), F.min("_min").alias("min_timestamp"), F.max("_max").alias("max_timestamp"),
        F.coalesce(F.sum(F.when(F.col("_day").isNull(), F.col("_n"))), F.lit(0)).alias("null_count"),
        F.count("_day").alias("distinct_dates"))


def timeless_row(df: DataFrame, table: str) -> DataFrame:
    """The coverage row of a table without time fields."""
    return df.agg(rows().alias("row_count")).select(
        F.lit(table).alias("table_name"), F.lit("N/A").alias("time_field"), "row_count",
        F.lit(None).cast("timestamp_ntz").alias("min_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("max_timestamp"),
        F.lit(None).cast("bigint").alias("null_count"), F.lit(None).cast("bigint").alias("distinct_dates"))


def observed_days(df: DataFrame, ts: str = "Create") -> DataFrame:
    return df.select(F.to_date(ts).alias("day")).where("day is not null").distinct()


def calendar_gaps(df: DataFrame, ts: str = "Create") -> DataFrame:
    """Runs of missing days inside the observed range. Works on days, whatever the number of rows."""
    days = observed_days(df, ts)
    span = days.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    missing = span.join(days, "day", "left_anti")
    # days only: the window without a key sees at most one row per calendar day
    run = F.date_sub("day", F.row_number().over(Window.orderBy("day")))
    gaps = missing.withColumn("_run", run).groupBy("_run").agg(
        F.min("day").alias("gap_start"), F.max("day").alias("gap_end"), rows().alias("missing_days")).drop("_run")
    none = missing.agg(rows().alias("n")).where("n = 0").select(
        F.lit(None).cast("date").alias("gap_start"), F.lit(None).cast("date").alias("gap_end"),
        F.lit(0).cast("bigint").alias("missing_days"))
    return gaps.unionByName(none)


def daily_metrics(estimates: DataFrame, ts: str = "Create", ride: str = "RideID", value: str = "Price",
                  estimate: str = "RideEstimativeID") -> DataFrame:
    """Rides, estimates and price level per day, with 7-row and 14-row moving averages.

    Distinct rides and estimates are counted in grouped steps, so one busy day spreads over its estimates. An estimate
    belongs to one ride.
    """
    dated = estimates.withColumn("date", F.to_date(ts))
    rides = (dated.groupBy("date", ride, estimate).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
             .groupBy("date", ride).agg(F.count(estimate).alias("_n"), F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
             .groupBy("date").agg(rows().alias("unique_rides"), F.sum("_n").alias("estimative_rows"),
                                  (F.sum("_s") / F.sum("_c")).alias("mean_price")))
    levels = group_quantiles(dated, ["date"], value, {"median_price": 0.5, "p95_price": 0.95})
    daily = rides.join(levels, "date").withColumns({
        "weekday": weekday_name(F.col("date"), fixed.WEEKDAY_EN),
        "month": F.date_format("date", "yyyy-MM")})
    return moving_averages(daily)


def moving_averages(daily: DataFrame) -> DataFrame:
    by_date = Window.orderBy("date")  # one row per day
    return daily.withColumns({
        "rides_ma_7": F.avg("unique_rides").over(by_date.rowsBetween(-6, 0)),
        "mean_price_ma_14": F.avg("mean_price").over(by_date.rowsBetween(-13, 0))})


def weekday_seasonality(daily: DataFrame) -> DataFrame:
    """All seven weekdays, Monday first; a weekday without data keeps nulls."""
    spark = daily.sparkSession
    week = spark.createDataFrame([(i, n) for i, n in enumerate(fixed.WEEKDAY_EN)], "weekday_no int, weekday string")
    means = daily.groupBy("weekday").agg(
        F.avg("unique_rides").alias("mean_daily_rides"), F.avg("mean_price").alias("mean_daily_price"),
        F.avg("estimative_rows").alias("mean_daily_estimates"), rows().alias("observed_days"))
    return F.broadcast(week).join(means, "weekday", "left").join(_day_medians(daily, "weekday"), "weekday", "left").orderBy("weekday_no")


def _day_medians(daily: DataFrame, by: str) -> DataFrame:
    """Median rides and median price of the days of each group, by one quantile pass over both."""
    values = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("double").alias("value")) for n, c in DAY_MEDIANS.items()])
    found = group_quantiles(daily.select(by, F.inline(values)), [by, "name"], "value", {"median": 0.5})
    return found.groupBy(by).agg(*[F.max(F.when(F.col("name") == n, F.col("median"))).alias(n) for n in DAY_MEDIANS])


DAY_MEDIANS = {"median_daily_rides": "unique_rides", "median_daily_price": "mean_price"}


def monthly_metrics(daily: DataFrame) -> DataFrame:
    sums = daily.groupBy("month").agg(
        rows().alias("active_days"), F.sum("unique_rides").alias("total_rides"),
        F.avg("unique_rides").alias("mean_daily_rides"), F.avg("mean_price").alias("mean_daily_price"),
        F.avg("estimative_rows").alias("mean_daily_estimates"))
    return sums.join(_day_medians(daily, "month"), "month").orderBy("month")


def integrity_checks(rides: DataFrame) -> DataFrame:
    """Eight chronology rules with count and share of all rides; nulls break no rule."""
    create, schedule, updated = F.col("Create"), F.col("Schedule"), F.col("Updated")
    lead = F.abs(seconds_between(create, schedule))
    late = seconds_between(create, updated)
    rules = {
        "schedule_before_create": schedule < create,
        "schedule_create_diff_gt_1m": lead > 60,
        "schedule_create_diff_gt_5m": lead > 300,
        "updated_before_create": updated < create,
        "updated_before_schedule": updated < schedule,
        "updated_after_create_gt_1h": late > 3600,
        "updated_after_create_gt_24h": late > 86400,
        "updated_after_create_gt_7d": late > 604800,
    }
    wide = rides.agg(rows().alias("_n"), *[count_if(rule).alias(name) for name, rule in rules.items()])
    return wide.unpivot(["_n"], list(rules), "rule", "violations").select(
        "rule", "violations", pct(F.col("violations"), F.col("_n")).alias("pct"))


def regime_comparison(daily: DataFrame, cut: str = fixed.REGIME_START) -> DataFrame:
    before = F.col("date") < F.lit(cut).cast("date")
    return daily.agg(
        rounded(F.avg(F.when(before, F.col("unique_rides")))).alias("mean_rides_before"),
        rounded(F.avg(F.when(~before, F.col("unique_rides")))).alias("mean_rides_from"),
        count_if(before).alias("days_before"), count_if(~before).alias("days_from"))
