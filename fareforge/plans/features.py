"""Cross prices, user history, leakage checks and the feature layer."""
from pyspark.sql import functions as F

from .. import fixed
from ..functions.running import prefix_scan
from ..functions.scalar import rounded
from ..operators import history, leakage
from ..session import materialize
from . import views as v
from .registry import big, pct, query, rnd
from .temporal import calendar_sql

PRICES = [f"Price_{p}" for p in v.TARGETS]
HISTORY_COLUMNS = ["RideEstimativeID", "RideID", "CategoryID", "UserID", "Create", "RidePrice", "Price"]


@query("user_prior_ride_count", f"""
SELECT RideID, UserID, {big('row_number() OVER (PARTITION BY UserID ORDER BY "Create", RideID) - 1')} AS UserPriorRideCount FROM vr""")
def user_prior_ride_count(spark, sf_dir):
    rides = v.rides(spark, sf_dir).select("RideID", "UserID", "Create")
    out = prefix_scan(rides, ["UserID"], ["Create", "RideID"], {"UserPriorRideCount": F.lit(1)})
    return out.select("RideID", "UserID", "UserPriorRideCount")


@query("user_prior_paid_mean", f"""
SELECT RideID, {rnd('''avg(CASE WHEN RidePrice > 0 THEN RidePrice END) OVER (PARTITION BY UserID ORDER BY "Create", RideID
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)''')} AS UserPriorPaidPriceMean FROM vr""")
def user_prior_paid_mean(spark, sf_dir):
    out = history.user_history(v.rides(spark, sf_dir).select("RideID", "UserID", "Create", "RidePrice"))
    return out.select("RideID", rounded(F.col("UserPriorPaidPriceMean")).alias("UserPriorPaidPriceMean"))


def _pairs(spark, sf_dir):
    return history.category_base(v.analytical(spark, sf_dir))


PAIRS = """, pb AS (SELECT * FROM (SELECT RideID, CategoryID, UserID, "Create", RideEstimativeID, Price,
  row_number() OVER (PARTITION BY RideID, CategoryID ORDER BY RideEstimativeID) AS k FROM va) WHERE k = 1)"""
PAIR_ORDER = 'PARTITION BY UserID, CategoryID ORDER BY "Create", RideID, RideEstimativeID'


@query("user_prior_category_count", f"""{PAIRS}
SELECT RideID, CategoryID, {big(f'row_number() OVER ({PAIR_ORDER}) - 1')} AS UserPriorCategoryRideCount FROM pb""")
def user_prior_category_count(spark, sf_dir):
    out = history.user_category_history(_pairs(spark, sf_dir))
    return out.select("RideID", "CategoryID", "UserPriorCategoryRideCount")


@query("user_prior_category_mean", f"""{PAIRS}
SELECT RideID, CategoryID, {rnd(f'avg(Price) OVER ({PAIR_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)')}
  AS UserPriorCategoryPriceMean FROM pb""")
def user_prior_category_mean(spark, sf_dir):
    out = history.user_category_history(_pairs(spark, sf_dir))
    return out.select("RideID", "CategoryID", rounded(F.col("UserPriorCategoryPriceMean")).alias("UserPriorCategoryPriceMean"))


@query("cross_price_pivot", "SELECT RideID, " + ", ".join(f"{rnd(p)} AS {p}" for p in PRICES) + " FROM xp")
def cross_price_pivot(spark, sf_dir):
    out = history.cross_prices(v.curated(spark, sf_dir), v.TARGETS, "CategoryID")
    return out.select("RideID", *[rounded(F.col(p)).alias(p) for p in PRICES])


def _n(p):
    return f"count(*) FILTER (WHERE CategoryID = '{p}')"


@query("cross_price_metrics", f""", pr AS (SELECT RideID, {', '.join(f'{_n(p)} AS {p}' for p in v.TARGETS)}
  FROM vcr WHERE CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO') GROUP BY 1)
SELECT {big('sum(ECONOMY + STANDARD + PROMO)')} AS canonical_source_rows, count(*) AS canonical_unique_ride_ids,
  {big("sum(ECONOMY + STANDARD + PROMO) - sum(CAST(ECONOMY > 0 AS INT) + CAST(STANDARD > 0 AS INT) + CAST(PROMO > 0 AS INT))")}
    AS canonical_duplicate_rows_collapsed,
  {big('count(*) FILTER (WHERE ECONOMY > 0 AND STANDARD > 0 AND PROMO > 0)')} AS rides_with_all_canonical_prices,
  """ + ", ".join(f"""{big(f'sum({p})')} AS {p}_rows, {big(f'count(*) FILTER (WHERE {p} > 0)')} AS {p}_unique_rides,
  {big(f'sum(greatest({p} - 1, 0))')} AS {p}_duplicates_collapsed,
  {pct(f'count(*) FILTER (WHERE {p} > 0)', 'count(*)')} AS Price_{p}_ride_coverage_pct""" for p in v.TARGETS) + " FROM pr")
def cross_price_metrics(spark, sf_dir):
    return history.cross_price_metrics(v.curated_rows(spark, sf_dir), v.TARGETS, "CategoryID")


def _coverage_sql():
    lines = []
    for p in v.TARGETS:
        others = " AND ".join(f"{c} IS NOT NULL" for c in PRICES if c != f"Price_{p}")
        for c in PRICES:
            role = "target_equivalent" if c == f"Price_{p}" else "auxiliary_input"
            lines.append((p, c, role, f"{c} IS NOT NULL"))
        lines.append((p, "Both auxiliary prices", "auxiliary_pair", others))
    return "\nUNION ALL ".join(f"""SELECT '{p}' AS ModelProduct, '{c}' AS FeatureName, '{r}' AS FeatureRole,
      {big(f'count(*) FILTER (WHERE {cond})')} AS available_rows, {pct(f'count(*) FILTER (WHERE {cond})', 'count(*)')} AS available_pct
      FROM cx WHERE CategoryID = '{p}'""" for p, c, r, cond in lines)


@query("cross_price_coverage", f", cx AS (SELECT vc.CategoryID, xp.* FROM vc LEFT JOIN xp USING (RideID)) {_coverage_sql()}")
def cross_price_coverage(spark, sf_dir):
    base = v.curated_layer(spark, sf_dir, ["RideEstimativeID", "RideID", "CategoryID", "Price"])
    enriched = history.attach_cross_prices(base, history.cross_prices(base, v.TARGETS, "CategoryID"))
    return history.cross_price_coverage(enriched, v.TARGETS, "CategoryID")


def _history_sql():
    rules = [("UserPriorRideCount", "history_count", "UserPriorRideCount > 0"),
             ("UserPriorPaidPriceMean", "history_value", "UserPriorPaidPriceMean IS NOT NULL"),
             ("UserPriorCategoryRideCount", "category_count", "UserPriorCategoryRideCount > 0"),
             ("UserPriorCategoryPriceMean", "category_value", "UserPriorCategoryPriceMean IS NOT NULL")]
    scopes = [("ALL", "overall", "true")] + [(p, p.lower(), f"CategoryID = '{p}'") for p in v.TARGETS]
    return "\nUNION ALL ".join(f"""SELECT '{s}' AS CategoryID, '{t}' AS CategoryName, '{f}' AS FeatureName, '{r}' AS FeatureRole,
      {big(f'count(*) FILTER (WHERE {c})')} AS available_rows, {pct(f'count(*) FILTER (WHERE {c})', 'count(*)')} AS available_pct
      FROM vx WHERE {w}""" for s, t, w in scopes for f, r, c in rules)


@query("history_coverage", _history_sql())
def history_coverage(spark, sf_dir):
    names = {p: p.lower() for p in v.TARGETS}
    return history.history_coverage(v.enriched(spark, sf_dir), names)


def _metrics_sql(scope, table, count, mean, valid):
    q = ", ".join(f"{big(f'trunc(quantile_cont({count}, {p}))')} AS prior_count_{n}" for n, p in (("p50", .5), ("p90", .9), ("p99", .99)))
    return f"""SELECT '{scope}' AS scope, (SELECT count(*) FROM vc) AS rows_scanned, count(*) AS unique_rows,
      (SELECT count(*) FROM vc) - count(*) AS collapsed_rows, count(DISTINCT UserID) AS unique_users,
      {big(f'count(*) FILTER (WHERE {count} = 0)')} AS cold_start_rows, {big(f'count({mean})')} AS rows_with_mean,
      {big(f'count(*) FILTER (WHERE {valid})')} AS rows_with_valid_price, {q} FROM {table}"""


@query("history_metrics", _metrics_sql("ride", "rh", "UserPriorRideCount", "UserPriorPaidPriceMean", "RidePrice > 0") + "\nUNION ALL "
       + _metrics_sql("ride_category", "ch", "UserPriorCategoryRideCount", "UserPriorCategoryPriceMean", "Price IS NOT NULL"))
def history_metrics(spark, sf_dir):
    raw = v.curated_layer(spark, sf_dir, HISTORY_COLUMNS)
    by_ride = history.user_history(history.ride_base(raw))
    by_category = history.user_category_history(history.category_base(raw))
    one = history.history_metrics(raw, by_ride, *history.RIDE_HISTORY, F.col("RidePrice") > 0).withColumn("scope", F.lit("ride"))
    two = history.history_metrics(raw, by_category, *history.CATEGORY_HISTORY, F.col("Price").isNotNull()).withColumn("scope", F.lit("ride_category"))
    return one.unionByName(two)


LEAK = {p: (f"Price_{p}", [c for c in PRICES if c != f"Price_{p}"]) for p in v.TARGETS}


def _rate_sql():
    out = [f"{pct('count(*) FILTER (WHERE Updated > ' + chr(34) + 'Create' + chr(34) + ')', 'count(*)')} AS updated_after_create_pct",
           f"{pct('count(*) FILTER (WHERE PriceWasCapped)', 'count(*)')} AS price_was_capped_pct"]
    for p, (own, aux) in LEAK.items():
        size = f"count(*) FILTER (WHERE CategoryID = '{p}')"
        out.append(f"""{pct(f"count(*) FILTER (WHERE CategoryID = '{p}' AND {own} = Price)", size)} AS own_equals_target_pct_{p}""")
        out.append(f"""{pct(f"count(*) FILTER (WHERE CategoryID = '{p}' AND {aux[0]} IS NOT NULL AND {aux[1]} IS NOT NULL)", size)}
          AS both_auxiliary_pct_{p}""")
    return "SELECT " + ", ".join(out) + " FROM cx"


CX = ", cx AS (SELECT vc.*, xp.* EXCLUDE (RideID) FROM vc LEFT JOIN xp USING (RideID))"


def _priced(spark, sf_dir):
    base = v.curated_layer(spark, sf_dir)
    return history.attach_cross_prices(base, history.cross_prices(base, v.TARGETS, "CategoryID"))


@query("leakage_rates", f"{CX} {_rate_sql()}")
def leakage_rates(spark, sf_dir):
    return leakage.leakage_rates(_priced(spark, sf_dir), v.TARGETS, "CategoryID")


def _risk_sql():
    lines = [(*risk, fixed.RISK_RATES.get(risk[0], "NULL")) for risk in fixed.RISKS]
    for (label, risk, decision), rate in zip(fixed.PRODUCT_RISKS, ("own_equals_target_pct", "both_auxiliary_pct")):
        lines += [(label.format(price=f"Price_{p}", product=p), risk, decision, f"{rate}_{p}") for p in v.TARGETS]
    return "\nUNION ALL ".join(f"""SELECT '{a}' AS feature_group, '{b}' AS leakage_risk, '{c}' AS recommended_decision,
      CAST({d} AS DOUBLE) AS rate_pct FROM lr""" for a, b, c, d in lines)


RISKS = f"{CX}, lr AS ({_rate_sql()}) {_risk_sql()}"


def _risks(spark, sf_dir):
    return leakage.feature_risks(leakage.leakage_rates(_priced(spark, sf_dir), v.TARGETS, "CategoryID"), v.TARGETS)


@query("feature_risk", RISKS)
def feature_risk(spark, sf_dir):
    return _risks(spark, sf_dir)


@query("high_risk_features", f"{CX}, lr AS ({_rate_sql()}) SELECT * FROM ({_risk_sql()}) WHERE leakage_risk = 'high'")
def high_risk_features(spark, sf_dir):
    return leakage.high_risk(_risks(spark, sf_dir))


@query("history_consistency", f"""
SELECT 'negative_user_prior_ride_count_rows' AS metric, {big('count(*) FILTER (WHERE UserPriorRideCount < 0)')} AS value FROM vx
UNION ALL SELECT 'negative_user_prior_category_count_rows', {big('count(*) FILTER (WHERE UserPriorCategoryRideCount < 0)')} FROM vx
UNION ALL SELECT 'rows_with_prior_category_count_and_null_mean',
  {big('count(*) FILTER (WHERE UserPriorCategoryRideCount > 0 AND UserPriorCategoryPriceMean IS NULL)')} FROM vx
UNION ALL SELECT 'rows_with_prior_ride_count_and_null_paid_mean',
  {big('count(*) FILTER (WHERE UserPriorRideCount > 0 AND UserPriorPaidPriceMean IS NULL)')} FROM vx
UNION ALL SELECT 'ride_level_prior_count_inconsistencies', count(*) FROM
  (SELECT RideID FROM vx GROUP BY 1 HAVING count(DISTINCT UserPriorRideCount) > 1)
UNION ALL SELECT 'category_level_prior_count_inconsistencies', count(*) FROM
  (SELECT RideID, CategoryID FROM vx GROUP BY 1, 2 HAVING count(DISTINCT UserPriorCategoryRideCount) > 1)
UNION ALL SELECT 'prior_ride_count_mismatch_rows', {big('count(*) FILTER (WHERE UserPriorRideCount <> e)')} FROM
  (SELECT UserPriorRideCount, row_number() OVER (PARTITION BY UserID ORDER BY "Create", RideID) - 1 AS e
   FROM (SELECT DISTINCT RideID, UserID, "Create", UserPriorRideCount FROM vx))
UNION ALL SELECT 'prior_category_count_mismatch_rows', {big('count(*) FILTER (WHERE UserPriorCategoryRideCount <> e)')} FROM
  (SELECT UserPriorCategoryRideCount, row_number() OVER (PARTITION BY UserID, CategoryID ORDER BY "Create", RideID) - 1 AS e
   FROM (SELECT DISTINCT RideID, CategoryID, UserID, "Create", UserPriorCategoryRideCount FROM vx))""")
def history_consistency(spark, sf_dir):
    return leakage.require_consistent(leakage.history_consistency(materialize(v.enriched(spark, sf_dir), "features")))


KEPT = ["RideEstimativeID", "RideID", "CategoryID", "UserID", "Price", "UserPriorRideCount", "UserPriorPaidPriceMean",
        "UserPriorCategoryRideCount", "UserPriorCategoryPriceMean", *PRICES]
REALS = ["Price", "UserPriorPaidPriceMean", "UserPriorCategoryPriceMean", *PRICES]
STAMPS = ("Schedule", "Create", "Updated")


@query("feature_layer", "SELECT " + ", ".join(
    f"{rnd(c)} AS {c}" if c in REALS else f"{big(c)} AS {c}" if c.endswith("Count") else c for c in KEPT)
    + ", " + ", ".join(calendar_sql(t) for t in STAMPS) + " FROM vx")
def feature_layer(spark, sf_dir):
    """Flagship: star join, cleaning, calendar, cross prices and user history in one plan."""
    out = history.build_features(v.curated_layer(spark, sf_dir), v.TARGETS, "CategoryID", STAMPS, *v.YEARS)
    calendar_names = [t + s for t in STAMPS for s in ("Hour", "DayOfWeek", "DayOfWeekName", "Month", "Quarter", "IsHolidayBR", "DayPeriod")]
    return out.select(*[rounded(F.col(c)).alias(c) if c in REALS else F.col(c) for c in KEPT], *calendar_names)
