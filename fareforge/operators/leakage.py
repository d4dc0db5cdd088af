"""Leakage and consistency checks of the feature layer."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.running import prefix_scan
from ..functions.scalar import all_present, count_if, pct, rows
from .checks import broken
from .history import price_column


def leakage_rates(df: DataFrame, products: list, product: str = "ProductID") -> DataFrame:
    """Shares behind the risk table, as one row of one pass."""
    n = rows()
    out = [pct(count_if(F.col("Updated") > F.col("Create")), n).alias("updated_after_create_pct"),
           pct(count_if(F.col("PriceWasCapped")), n).alias("price_was_capped_pct")]
    for p in products:
        here = F.col(product) == p
        aux = all_present(*[price_column(q) for q in products if q != p])
        size = count_if(here)
        out += [pct(count_if(here & (F.col(price_column(p)) == F.col("Price"))), size).alias(f"own_equals_target_pct_{p}"),
                pct(count_if(here & aux), size).alias(f"both_auxiliary_pct_{p}")]
    return df.agg(*out)


def feature_risks(rates: DataFrame, products: list) -> DataFrame:
    """(feature_group, leakage_risk, recommended_decision, rate_pct) from the one-row rates."""
    lines = [(*risk, fixed.RISK_RATES.get(risk[0])) for risk in fixed.RISKS]
    for (label, risk, decision), rate in zip(fixed.PRODUCT_RISKS, ("own_equals_target_pct", "both_auxiliary_pct")):
        lines += [(label.format(price=price_column(p), product=p), risk, decision, f"{rate}_{p}") for p in products]
    table = F.array(*[F.struct(
        F.lit(a).alias("feature_group"), F.lit(b).alias("leakage_risk"), F.lit(c).alias("recommended_decision"),
        (F.col(d) if d else F.lit(None)).cast("double").alias("rate_pct")) for a, b, c, d in lines])
    return rates.select(F.inline(table))


def high_risk(risks: DataFrame) -> DataFrame:
    return risks.where("leakage_risk = 'high'")


def fold_totals(checks: DataFrame) -> DataFrame:
    return checks.agg(
        rows().alias("folds_checked"), count_if(~F.col("fold_valid")).alias("invalid_folds"),
        F.sum("ride_overlap").alias("ride_overlap_total"), F.sum("index_overlap").alias("index_overlap_total"))


def _recounted(df: DataFrame, keys: list[str], user: list[str], order: list, stored: str):
    """(keys whose stored count varies, keys whose count differs from a new one), from one grouping of the rows by key."""
    wanted = dict.fromkeys([*user, "Create", "RideID", "RideEstimativeID", stored])
    first = F.min_by(F.struct(*[c for c in wanted if c not in keys]), F.struct("Create", "RideEstimativeID"))
    base = df.groupBy(*keys).agg(first.alias("_f"), F.min(stored).alias("_lo"), F.max(stored).alias("_hi"))
    flat = base.select(*keys, *[F.col(f"_f.{c}").alias(c) for c in wanted if c not in keys], "_lo", "_hi")
    again = prefix_scan(flat, user, order, {"_again": F.lit(1)})
    return again.agg(F.struct(count_if(F.col("_lo") < F.col("_hi")).alias("varying"), count_if(F.col("_again") != F.col(stored)).alias("wrong"))).scalar()


def history_consistency(df: DataFrame) -> DataFrame:
    """Eight counts as (metric, value); all but the informational rows_with_prior_ride_count_and_null_paid_mean must be zero."""
    n, m = F.col("UserPriorRideCount"), F.col("UserPriorCategoryRideCount")
    one = df.agg(
        count_if(n < 0).alias("negative_user_prior_ride_count_rows"),
        count_if(m < 0).alias("negative_user_prior_category_count_rows"),
        count_if((m > 0) & F.col("UserPriorCategoryPriceMean").isNull())
        .alias("rows_with_prior_category_count_and_null_mean"),
        count_if((n > 0) & F.col("UserPriorPaidPriceMean").isNull())
        .alias("rows_with_prior_ride_count_and_null_paid_mean"))
    rides = _recounted(df, ["RideID"], ["UserID"], ["Create", "RideID"], "UserPriorRideCount")
    pairs = _recounted(df, ["RideID", "CategoryID"], ["UserID", "CategoryID"], ["Create", "RideID", "RideEstimativeID"],
                       "UserPriorCategoryRideCount")
    full = one.withColumns({"_r": rides, "_c": pairs}).withColumns({
        "ride_level_prior_count_inconsistencies": F.col("_r.varying"), "category_level_prior_count_inconsistencies": F.col("_c.varying"),
        "prior_ride_count_mismatch_rows": F.col("_r.wrong"), "prior_category_count_mismatch_rows": F.col("_c.wrong")}).drop("_r", "_c")
    return full.unpivot([], full.columns, "metric", "value")


def leakage_safe_columns(columns: list[str], own_price: str) -> list[str]:
    """Columns without later timestamps, target-derived flags and the product's own price."""
    return [c for c in columns if not c.startswith("Updated") and c not in ("PriceWasCapped", own_price)]


def export_summary(df: DataFrame, group: str = "CategoryID") -> DataFrame:
    """Quality of each export: rows, null time and target, positive targets, time span."""
    return df.groupBy(group).agg(
        rows().alias("rows"), count_if(F.col("Create").isNull()).alias("null_time"),
        count_if(F.col("Price").isNull()).alias("null_target"), count_if(F.col("Price") > 0).alias("positive_target"),
        F.min("Create").alias("min_time"), F.max("Create").alias("max_time"))


INFORMATIONAL = "rows_with_prior_ride_count_and_null_paid_mean"


def require_consistent(metrics: DataFrame) -> DataFrame:
    """The metrics themselves, failing while they are computed where one that must be zero is not."""
    wrong = (F.col("value") != 0) & (F.col("metric") != INFORMATIONAL)
    return metrics.withColumn("value", F.when(~wrong, F.col("value")).otherwise(broken("inconsistent history:", "metric").cast("bigint")))
