"""Time coverage, gaps, daily and seasonal metrics, calendar columns."""
from pyspark.sql import functions as F

from ..functions import calendar
from ..functions.bounded import settle
from ..functions.scalar import rounded, rows
from ..operators import history, temporal
from . import views as v
from .registry import big, pct, query, rnd


def _cover(table, field, source):
    return f"""SELECT '{table}' AS table_name, '{field}' AS time_field, count(*) AS row_count,
  min("{field}") AS min_timestamp, max("{field}") AS max_timestamp, {big(f'count(*) - count("{field}")')} AS null_count,
  count(DISTINCT CAST("{field}" AS DATE)) AS distinct_dates FROM {source}"""


@query("temporal_coverage", "\nUNION ALL ".join([
    *[_cover("ride", f, "vru") for f in ("Create", "Schedule", "Updated")],
    *[_cover("rideestimative", f, "va") for f in ("Create", "Schedule", "Updated")],
    "SELECT 'product', 'N/A', count(*), NULL, NULL, NULL, NULL FROM vp"]))
def temporal_coverage(spark, sf_dir):
    times = ["Create", "Schedule", "Updated"]
    return (temporal.coverage(v.updated_rides(spark, sf_dir), "ride", times)
            .unionByName(temporal.coverage(v.analytical(spark, sf_dir), "rideestimative", times))
            .unionByName(temporal.timeless_row(v.products(spark, sf_dir), "product")))


@query("calendar_gaps", """
, od AS (SELECT DISTINCT CAST("Create" AS DATE) AS day FROM vr),
miss AS (SELECT CAST(day AS DATE) AS day FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM od)
         WHERE CAST(day AS DATE) NOT IN (SELECT day FROM od))
SELECT min(day) AS gap_start, max(day) AS gap_end, count(*) AS missing_days
FROM (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS run FROM miss) GROUP BY run
UNION ALL SELECT NULL, NULL, 0 WHERE NOT EXISTS (SELECT 1 FROM miss)""")
def calendar_gaps(spark, sf_dir):
    return temporal.calendar_gaps(v.rides(spark, sf_dir))


DAILY = """, dm0 AS (
  SELECT CAST("Create" AS DATE) AS date, count(DISTINCT RideID) AS unique_rides, count(DISTINCT RideEstimativeID) AS estimative_rows,
         avg(Price) AS mean_price, quantile_cont(Price, 0.5) AS median_price, quantile_cont(Price, 0.95) AS p95_price,
         dayname(min("Create")) AS weekday, strftime(min("Create"), '%Y-%m') AS month FROM va GROUP BY 1),
dm AS (SELECT *, avg(unique_rides) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rides_ma_7,
              avg(mean_price) OVER (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS mean_price_ma_14 FROM dm0)
"""


def _daily(spark, sf_dir):
    # rides carry the date, so neither products nor other ride columns are read
    dated = v.estimates(spark, sf_dir).select("RideEstimativeID", "RideID", "Price").join(
        v.rides(spark, sf_dir).select("RideID", "Create"), "RideID", "left")
    return temporal.daily_metrics(dated)


def _settled_daily(spark, sf_dir):
    """One row per calendar day, computed once for several aggregates."""
    return settle(_daily(spark, sf_dir), "daily")


def _round_all(df, names):
    return df.withColumns({c: rounded(F.col(c)) for c in names})


@query("daily_metrics", f"""{DAILY}
SELECT date, unique_rides, estimative_rows, {rnd('mean_price')} AS mean_price, {rnd('median_price')} AS median_price,
       {rnd('p95_price')} AS p95_price, weekday, month, {rnd('rides_ma_7')} AS rides_ma_7,
       {rnd('mean_price_ma_14')} AS mean_price_ma_14 FROM dm""")
def daily_metrics(spark, sf_dir):
    return _round_all(_daily(spark, sf_dir), ["mean_price", "median_price", "p95_price", "rides_ma_7", "mean_price_ma_14"])


RIDE_DAYS = """, rd AS (SELECT CAST("Create" AS DATE) AS date, count(*) AS unique_rides, avg(RidePrice) AS mean_price
  FROM vr GROUP BY 1)"""


def _ride_days(spark, sf_dir):
    return v.rides(spark, sf_dir).groupBy(F.to_date("Create").alias("date")).agg(
        rows().alias("unique_rides"), F.avg("RidePrice").alias("mean_price"))


@query("rolling_7", f"""{RIDE_DAYS}
SELECT date, {rnd('avg(unique_rides) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS rides_ma_7 FROM rd""")
def rolling_7(spark, sf_dir):
    return temporal.moving_averages(_ride_days(spark, sf_dir)).select("date", rounded(F.col("rides_ma_7")).alias("rides_ma_7"))


@query("rolling_14", f"""{RIDE_DAYS}
SELECT date, {rnd('avg(mean_price) OVER (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)')} AS mean_price_ma_14 FROM rd""")
def rolling_14(spark, sf_dir):
    return temporal.moving_averages(_ride_days(spark, sf_dir)).select(
        "date", rounded(F.col("mean_price_ma_14")).alias("mean_price_ma_14"))


DAY_LEVELS = ["mean_daily_rides", "mean_daily_price", "median_daily_rides", "mean_daily_estimates", "median_daily_price"]


@query("weekday_seasonality", f"""{DAILY}
SELECT CAST(n AS INTEGER) AS weekday_no, w.weekday, {rnd('avg(unique_rides)')} AS mean_daily_rides,
       {rnd('avg(mean_price)')} AS mean_daily_price, CASE WHEN count(date) > 0 THEN count(date) END AS observed_days,
       {rnd('quantile_cont(unique_rides, 0.5)')} AS median_daily_rides, {rnd('avg(estimative_rows)')} AS mean_daily_estimates,
       {rnd('quantile_cont(mean_price, 0.5)')} AS median_daily_price
FROM (SELECT unnest(range(7)) AS n, unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS weekday) w
LEFT JOIN dm d ON d.weekday = w.weekday GROUP BY ALL""")
def weekday_seasonality(spark, sf_dir):
    daily = _settled_daily(spark, sf_dir)
    return _round_all(temporal.weekday_seasonality(daily), DAY_LEVELS)


@query("monthly_metrics", f"""{DAILY}
SELECT month, count(*) AS active_days, {big('sum(unique_rides)')} AS total_rides, {rnd('avg(unique_rides)')} AS mean_daily_rides,
       {rnd('avg(mean_price)')} AS mean_daily_price, {rnd('quantile_cont(unique_rides, 0.5)')} AS median_daily_rides,
       {rnd('avg(estimative_rows)')} AS mean_daily_estimates, {rnd('quantile_cont(mean_price, 0.5)')} AS median_daily_price
FROM dm GROUP BY 1""")
def monthly_metrics(spark, sf_dir):
    return _round_all(temporal.monthly_metrics(_settled_daily(spark, sf_dir)), DAY_LEVELS)


C, S, U = ('epoch_us("Create")', 'epoch_us("Schedule")', 'epoch_us("Updated")')
RULES = {
    "schedule_before_create": f"{S} < {C}", "schedule_create_diff_gt_1m": f"abs({S} - {C}) > 60000000",
    "schedule_create_diff_gt_5m": f"abs({S} - {C}) > 300000000", "updated_before_create": f"{U} < {C}",
    "updated_before_schedule": f"{U} < {S}", "updated_after_create_gt_1h": f"{U} - {C} > 3600000000",
    "updated_after_create_gt_24h": f"{U} - {C} > 86400000000", "updated_after_create_gt_7d": f"{U} - {C} > 604800000000",
}


@query("integrity_checks", "\nUNION ALL ".join(
    f"SELECT '{n}' AS rule, {big(f'count(*) FILTER (WHERE {r})')} AS violations, {pct(f'count(*) FILTER (WHERE {r})', 'count(*)')} AS pct FROM vru"
    for n, r in RULES.items()))
def integrity_checks(spark, sf_dir):
    return temporal.integrity_checks(v.updated_rides(spark, sf_dir))


@query("regime_comparison", f"""{RIDE_DAYS}
SELECT {rnd("avg(unique_rides) FILTER (WHERE date < DATE '1999-01-01')")} AS mean_rides_before,
       {rnd("avg(unique_rides) FILTER (WHERE date >= DATE '1999-01-01')")} AS mean_rides_from,
       {big("count(*) FILTER (WHERE date < DATE '1999-01-01')")} AS days_before,
       {big("count(*) FILTER (WHERE date >= DATE '1999-01-01')")} AS days_from FROM rd""")
def regime_comparison(spark, sf_dir):
    return temporal.regime_comparison(_ride_days(spark, sf_dir), v.REGIME)


def _int(expr):
    return f"CAST({expr} AS INTEGER)"


PT = "['segunda', 'terca', 'quarta', 'quinta', 'sexta', 'sabado', 'domingo']"


def _period(c):
    return f"""CASE WHEN hour({c}) <= 5 THEN 'madrugada' WHEN hour({c}) <= 11 THEN 'manha' WHEN hour({c}) <= 17 THEN 'tarde'
  WHEN hour({c}) <= 23 THEN 'noite' ELSE 'desconhecido' END"""


# Good Fridays of the years in the data; other holidays fall on fixed days
GOOD_FRIDAYS = ["1995-04-14", "1996-04-05", "1997-03-28", "1998-04-10", "1999-04-02", "2000-04-21", "2001-04-13", "2002-03-29",
                "2024-03-29"]


def _holiday(c):
    fridays = ", ".join(f"DATE '{d}'" for d in GOOD_FRIDAYS)
    return f"""(strftime({c}, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02', '11-15', '12-25')
  OR CAST({c} AS DATE) IN ({fridays}) OR (year({c}) >= 2024 AND strftime({c}, '%m-%d') = '11-20'))"""


def calendar_sql(name):
    c = f'"{name}"'
    return f"""{_int(f'hour({c})')} AS {name}Hour, {_int(f'isodow({c}) - 1')} AS {name}DayOfWeek,
  ({PT})[isodow({c})] AS {name}DayOfWeekName, {_int(f'month({c})')} AS {name}Month, {_int(f'quarter({c})')} AS {name}Quarter,
  {_holiday(c)} AS {name}IsHolidayBR, {_period(c)} AS {name}DayPeriod"""


@query("calendar_parts", f"""
SELECT RideID, {_int('hour("Create")')} AS hour, {_int('isodow("Create") - 1')} AS weekday_no, {_int('month("Create")')} AS month,
       {_int('quarter("Create")')} AS quarter, CAST("Create" AS DATE) AS day, strftime("Create", '%Y-%m') AS month_label FROM vk""")
def calendar_parts(spark, sf_dir):
    ts = F.col("Create")
    return v.clock(spark, sf_dir).select(
        "RideID", F.hour(ts).alias("hour"), calendar.weekday_number(ts).alias("weekday_no"), F.month(ts).alias("month"),
        F.quarter(ts).alias("quarter"), F.to_date(ts).alias("day"), calendar.month_label(ts).alias("month_label"))


@query("day_period", f"""
SELECT RideID, {_period('"Create"')} AS period FROM vk""")
def day_period(spark, sf_dir):
    return v.clock(spark, sf_dir).select("RideID", calendar.day_period(F.hour("Create")).alias("period"))


@query("holiday_flag", f"""
SELECT RideID, {_holiday('"Create"')} AS IsHolidayBR FROM vr""")
def holiday_flag(spark, sf_dir):
    return v.rides(spark, sf_dir).select("RideID", calendar.is_holiday(F.col("Create"), *v.YEARS).alias("IsHolidayBR"))


@query("temporal_features", f"""
SELECT RideID, {calendar_sql('Create')}, {calendar_sql('Schedule')} FROM vk""")
def temporal_features(spark, sf_dir):
    out = calendar.add_temporal_features(v.clock(spark, sf_dir), ("Create", "Schedule"))
    return out.drop("UserID", "Create", "CategoryID", "Price", "Schedule")


FEATURES = ["Hour", "DayOfWeekName", "Month", "Quarter", "IsHolidayBR", "DayPeriod"]
STAMPS = ("Create", "Schedule", "Updated")
ALL_FEATURES = [t + f for t in STAMPS for f in FEATURES]
CREATE_FEATURES = ["CreateHour", "CreateDayOfWeekName", "CreateIsHolidayBR", "CreateDayPeriod"]
CAL = f""", vk3 AS (SELECT *, "Create" + to_minutes(CAST(RideID % 3000 AS INTEGER)) AS "Updated" FROM vk),
cal AS (SELECT RideID, CategoryID, {', '.join(map(calendar_sql, STAMPS))} FROM vk3)"""


def _calendar(spark, sf_dir):
    later = F.expr("timestampadd(MINUTE, RideID % 3000, Create)")
    return calendar.add_temporal_features(v.clock(spark, sf_dir).withColumn("Updated", later), STAMPS)


@query("feature_distribution", CAL + """
SELECT feature, value, count, """ + pct("count", "sum(count) OVER (PARTITION BY feature)") + " AS pct FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, count(*) AS count FROM cal GROUP BY 2" for f in ALL_FEATURES) + ")")
def feature_distribution(spark, sf_dir):
    return history.feature_distribution(_calendar(spark, sf_dir), ALL_FEATURES)


@query("feature_distribution_by_category", CAL + """
SELECT CategoryID, feature, value, count, """ + pct("count", "sum(count) OVER (PARTITION BY CategoryID, feature)") + " AS pct FROM (" + " UNION ALL ".join(
    f"SELECT CategoryID, '{f}' AS feature, CAST({f} AS VARCHAR) AS value, count(*) AS count FROM cal WHERE CategoryID IN ('click', 'error', 'purchase') GROUP BY 1, 3"
    for f in CREATE_FEATURES) + ")")
def feature_distribution_by_category(spark, sf_dir):
    return history.feature_distribution_by_category(_calendar(spark, sf_dir), CREATE_FEATURES, ["click", "error", "purchase"])


@query("top5_hours", f"""
SELECT {_int('hour("Create")')} AS hour, count(*) AS count, {pct('count(*)', '(SELECT count(*) FROM vk)')} AS pct
FROM vk GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def top5_hours(spark, sf_dir):
    dist = history.feature_distribution(_calendar(spark, sf_dir), ["CreateHour"])
    return (dist.select(F.col("value").cast("int").alias("hour"), "count", "pct")
            .orderBy(F.desc("count"), "hour").limit(5))


@query("calendar_shares", f"""
SELECT {pct('count(*) FILTER (WHERE isodow("Create") = 7)', 'count(*)')} AS sunday_pct,
       {pct(f"""count(*) FILTER (WHERE {_holiday('"Create"')})""", 'count(*)')} AS holiday_pct FROM vk""")
def calendar_shares(spark, sf_dir):
    """Shares of rides created on Sundays and on holidays, from the distributions."""
    found = history.feature_distribution(_calendar(spark, sf_dir), ["CreateDayOfWeekName", "CreateIsHolidayBR"])
    of = lambda feature, value: F.coalesce(F.max(F.when((F.col("feature") == feature) & (F.col("value") == value), F.col("pct"))), F.lit(0.0))
    return found.agg(of("CreateDayOfWeekName", "domingo").alias("sunday_pct"), of("CreateIsHolidayBR", "true").alias("holiday_pct"))
