"""Joins, keys, ordering, sets."""
from pyspark.sql import functions as F

from ..functions.running import first_per_key, repeated_keys
from ..functions.scalar import count_if, rounded, rows
from ..operators import checks, history, joins
from . import views as v
from .registry import big, query, rnd


@query("join_dim_validated", f"""
SELECT count(*) AS rows, {big('count(r.RideID)')} AS matched, {big('count(*) - count(r.RideID)')} AS unmatched,
       {rnd('sum(RidePrice)', 2)} AS ride_price, (SELECT count(*) FROM (SELECT RideID FROM vr GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys
FROM ve LEFT JOIN vr r ON ve.RideID = r.RideID""")
def join_dim_validated(spark, sf_dir):
    """Many-to-one left join with its violations counted: volume stays, unmatched rows are marked."""
    dim = v.rides(spark, sf_dir).select("RideID", "RidePrice")
    fact = v.estimates(spark, sf_dir).select("RideID", "RideEstimativeID")
    joined = joins.attach_dimension(fact, dim, "RideID")
    return joined.agg(
        rows().alias("rows"), count_if(F.col("_matched")).alias("matched"), count_if(~F.col("_matched")).alias("unmatched"),
        rounded(F.sum("RidePrice"), 2).alias("ride_price")).withColumn(
            "repeated_keys", repeated_keys(dim, ["RideID"]).agg(rows()).scalar())


@query("build_analytical", f"""
SELECT RideEstimativeID, va.RideID, ProductID, CategoryID, UserID, "Create", {rnd('Price')} AS Price,
       o.AddressID AS OriginAddressID, d.AddressID AS DestinationAddressID
FROM va LEFT JOIN (SELECT * FROM vad WHERE RideAddressTypeID = 1) o ON va.RideID = o.RideID
LEFT JOIN (SELECT * FROM vad WHERE RideAddressTypeID = 2) d ON va.RideID = d.RideID""")
def build_analytical(spark, sf_dir):
    """The star join of all estimates, with every contract in the plan."""
    out = joins.build_analytical(v.estimates(spark, sf_dir), v.rides(spark, sf_dir), v.products(spark, sf_dir), v.addresses(spark, sf_dir))
    return out.select("RideEstimativeID", "RideID", "ProductID", "CategoryID", "UserID", "Create",
                      rounded(F.col("Price")).alias("Price"), "OriginAddressID", "DestinationAddressID")


@query("full_outer_indicator", """
SELECT CASE WHEN d.RideID IS NULL THEN 'left_only' WHEN o.RideID IS NULL THEN 'right_only' ELSE 'both' END AS side,
       count(*) AS rides
FROM (SELECT * FROM vad WHERE RideAddressTypeID = 1) o
FULL OUTER JOIN (SELECT * FROM vad WHERE RideAddressTypeID = 2) d ON o.RideID = d.RideID GROUP BY 1""")
def full_outer_indicator(spark, sf_dir):
    wide = joins.split_addresses(v.addresses(spark, sf_dir))
    return wide.groupBy("side").agg(rows().alias("rides"))


@query("address_pivot", """
SELECT coalesce(o.RideID, d.RideID) AS RideID, o.AddressID AS OriginAddressID, d.AddressID AS DestinationAddressID,
       CASE WHEN d.RideID IS NULL THEN 'left_only' WHEN o.RideID IS NULL THEN 'right_only' ELSE 'both' END AS side
FROM (SELECT * FROM vad WHERE RideAddressTypeID = 1) o
FULL OUTER JOIN (SELECT * FROM vad WHERE RideAddressTypeID = 2) d ON o.RideID = d.RideID""")
def address_pivot(spark, sf_dir):
    return joins.split_addresses(joins.require_addresses(v.addresses(spark, sf_dir)))


@query("semi_join_active", """
SELECT RideID, UserID FROM vr WHERE RideID IN (SELECT RideID FROM ve)""")
def semi_join_active(spark, sf_dir):
    return joins.active_only(v.rides(spark, sf_dir), v.estimates(spark, sf_dir), "RideID").select("RideID", "UserID")


@query("anti_join_coverage", """
SELECT RideID FROM vr WHERE RideID NOT IN (SELECT RideID FROM ve)""")
def anti_join_coverage(spark, sf_dir):
    return joins.uncovered_keys(v.rides(spark, sf_dir), v.estimates(spark, sf_dir), "RideID")


@query("unique_key_violations", """
SELECT RideID, LineNo, count(*) AS rows FROM ve GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 5""")
def unique_key_violations(spark, sf_dir):
    return checks.unique_key_violations(v.estimates(spark, sf_dir), v.DEDUP_KEY)


@query("domain_violations", """
SELECT DISTINCT LineNo FROM ve WHERE LineNo NOT IN (1, 2)""")
def domain_violations(spark, sf_dir):
    return checks.domain_violations(v.estimates(spark, sf_dir), "LineNo", [1, 2])


@query("join_cross_price", f"""
SELECT RideEstimativeID, {rnd('Price_ECONOMY')} AS Price_ECONOMY, {rnd('Price_STANDARD')} AS Price_STANDARD,
       {rnd('Price_PROMO')} AS Price_PROMO FROM vc LEFT JOIN xp USING (RideID)""")
def join_cross_price(spark, sf_dir):
    base = v.curated_layer(spark, sf_dir, ["RideEstimativeID", "RideID", "CategoryID", "Price"])
    out = history.attach_cross_prices(base, history.cross_prices(base, v.TARGETS, "CategoryID"))
    return out.select("RideEstimativeID", *[rounded(F.col(f"Price_{p}")).alias(f"Price_{p}") for p in v.TARGETS])


@query("join_user_history", f"""
SELECT RideEstimativeID, {big('UserPriorRideCount')} AS UserPriorRideCount,
       {rnd('UserPriorPaidPriceMean')} AS UserPriorPaidPriceMean,
       {big('UserPriorCategoryRideCount')} AS UserPriorCategoryRideCount,
       {rnd('UserPriorCategoryPriceMean')} AS UserPriorCategoryPriceMean FROM vx""")
def join_user_history(spark, sf_dir):
    base = v.curated_layer(spark, sf_dir, ["RideEstimativeID", "RideID", "CategoryID", "UserID", "Create",
                                           "RidePrice", "Price"])
    out = history.require_history(history.attach_histories(base, base))
    means = ["UserPriorPaidPriceMean", "UserPriorCategoryPriceMean"]
    return out.select("RideEstimativeID", "UserPriorRideCount", "UserPriorCategoryRideCount",
                      *[rounded(F.col(c)).alias(c) for c in means])


@query("first_per_key", """
SELECT RideID, min(RideEstimativeID) AS RideEstimativeID, arg_min(ProductID, RideEstimativeID) AS ProductID
FROM ve GROUP BY 1""")
def first_estimate(spark, sf_dir):
    df = v.estimates(spark, sf_dir).select("RideID", "RideEstimativeID", "ProductID")
    return first_per_key(df, ["RideID"], ["RideEstimativeID"])


@query("canonical_estimate", f"""
SELECT RideID, CategoryID, min(RideEstimativeID) AS RideEstimativeID,
       {rnd('arg_min(Price, RideEstimativeID)')} AS Price, count(*) - 1 AS collapsed
FROM va WHERE CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO') GROUP BY 1, 2""")
def canonical_estimate(spark, sf_dir):
    """The canonical estimate per ride and product, and how many others it stands for: one aggregate."""
    df = v.analytical(spark, sf_dir).where(F.col("CategoryID").isin(v.TARGETS))
    return df.groupBy("RideID", "CategoryID").agg(
        F.min("RideEstimativeID").alias("RideEstimativeID"),
        rounded(F.min_by("Price", "RideEstimativeID")).alias("Price"), (rows() - 1).alias("collapsed"))


@query("total_order_sort", """
SELECT "Create", RideID, RideEstimativeID, ProductID FROM va ORDER BY "Create", RideID, RideEstimativeID""")
def total_order_sort(spark, sf_dir):
    return (v.analytical(spark, sf_dir).select("Create", "RideID", "RideEstimativeID", "ProductID")
            .orderBy("Create", "RideID", "RideEstimativeID"))


@query("union_aligned", """
SELECT RideID, UserID, CAST(NULL AS BIGINT) AS ProductID, 'ride' AS source FROM vr
UNION ALL SELECT RideID, NULL, ProductID, 'estimate' FROM ve""")
def union_aligned(spark, sf_dir):
    left = v.rides(spark, sf_dir).select("RideID", "UserID", F.lit("ride").alias("source"))
    right = v.estimates(spark, sf_dir).select("RideID", "ProductID", F.lit("estimate").alias("source"))
    return left.unionByName(right, allowMissingColumns=True).select("RideID", "UserID", "ProductID", "source")


@query("distinct_rows", "SELECT DISTINCT RideID, LineNo FROM ve")
def distinct_rows(spark, sf_dir):
    return v.estimates(spark, sf_dir).select("RideID", "LineNo").distinct()


@query("key_difference", """
SELECT ProductID FROM vp EXCEPT SELECT ProductID FROM ve WHERE Price > 100000""")
def key_difference(spark, sf_dir):
    dear = v.estimates(spark, sf_dir).where("Price > 100000").select("ProductID").distinct()
    return v.products(spark, sf_dir).select("ProductID").subtract(dear)


@query("ride_overlap", """
SELECT count(*) AS shared_rides FROM (
  SELECT RideID FROM ve WHERE Updated < TIMESTAMP '1998-01-01'
  INTERSECT SELECT RideID FROM ve WHERE Updated >= TIMESTAMP '1998-01-01')""")
def ride_overlap(spark, sf_dir):
    """Rides on both sides of a cut: one aggregate per ride instead of two scans and an intersection."""
    early = F.col("Updated") < F.lit("1998-01-01").cast("timestamp_ntz")
    per_ride = v.estimates(spark, sf_dir).groupBy("RideID").agg(
        count_if(early).alias("early"), count_if(~early).alias("late"))
    return per_ride.agg(count_if((F.col("early") > 0) & (F.col("late") > 0)).alias("shared_rides"))


@query("top3_weekdays", """
SELECT dayname("Create") AS weekday, count(*) AS rides FROM vk GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def top3_weekdays(spark, sf_dir):
    from ..fixed import WEEKDAY_EN
    from ..functions.calendar import weekday_name
    return (v.clock(spark, sf_dir).groupBy(weekday_name(F.col("Create"), WEEKDAY_EN).alias("weekday"))
            .agg(rows().alias("rides")).orderBy(F.desc("rides"), "weekday").limit(3))


SAMPLE = 500


@query("stratified_sample", f"""
SELECT CategoryID, RideID FROM (
  SELECT CategoryID, RideID, row_number() OVER (PARTITION BY CategoryID
         ORDER BY md5(CAST(RideID AS VARCHAR) || '-42'), RideID) AS rn FROM vk) WHERE rn <= {SAMPLE}""")
def stratified(spark, sf_dir):
    from ..operators.sampling import stratified_sample
    return stratified_sample(v.clock(spark, sf_dir).select("CategoryID", "RideID"), "CategoryID", "RideID", SAMPLE)


@query("params_json", """
SELECT DISTINCT CategoryID, '{"category":"' || CategoryID || '","num_boost_round":"100"}' AS ParamsJSON,
       CAST(100 AS BIGINT) AS rounds FROM vp""")
def params_json(spark, sf_dir):
    """Parameters per category written as JSON text and read back."""
    params = F.to_json(F.create_map(F.lit("category"), F.col("CategoryID"),
                                    F.lit("num_boost_round"), F.lit("100")))
    out = v.products(spark, sf_dir).select("CategoryID").distinct().select("CategoryID", params.alias("ParamsJSON"))
    back = F.from_json("ParamsJSON", "map<string,string>")
    return out.withColumn("rounds", back["num_boost_round"].cast("bigint"))
