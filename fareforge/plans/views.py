"""The given tables under ride names, and the layers derived from them."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.running import first_per_key
from ..operators import clean, folds, history
from ..session import materialize, tune

TARGETS = ["ECONOMY", "STANDARD", "PROMO"]
COORDINATES = ["OriginLat", "DestinationLat"]
MEDIANS = ["WaitingTime", "Fee"]
DEDUP_KEY = ["RideID", "LineNo"]
DEDUP_ORDER = ["RideEstimativeID", "Price", "Updated"]
REGIME = "1999-01-01"
CONFIG = folds.SplitConfig(regime_start=REGIME)
YEARS = (1995, 2002)


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once per path, not once per plan."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = tune(spark).read.parquet(path).schema
    return tune(spark).read.schema(_SCHEMAS[path]).parquet(path)


def _padded(name: str, width: int):
    return F.lpad(F.col(name).cast("string"), width, "0")


def estimates(spark, sf_dir) -> DataFrame:
    """Estimate ids are padded text: integer packing would overflow on large key ranges."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        F.concat(_padded("l_orderkey", 12), _padded("l_partkey", 10), _padded("l_suppkey", 8),
                 c("l_linenumber").cast("string")).alias("RideEstimativeID"),
        c("l_orderkey").alias("RideID"), c("l_partkey").alias("ProductID"),
        F.when(c("l_partkey") % 997 == 0, 0.0).otherwise(c("l_extendedprice")).alias("Price"),
        F.when(c("l_linenumber") != 7, c("l_quantity")).alias("WaitingTime"),
        F.when(c("l_returnflag") == "N", " ").when(c("l_returnflag") != "R", c("l_linestatus")).alias("FareID"),
        c("l_tax").alias("Fee"), c("l_shipdate").alias("Updated"),
        c("l_linenumber").cast("bigint").alias("LineNo"), c("l_suppkey").alias("SupplierID"),
        F.when(c("l_suppkey") % 50 != 0, c("l_discount")).alias("OriginLat"), c("l_tax").alias("DestinationLat"))


def rides(spark, sf_dir) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("RideID"), c("o_custkey").alias("UserID"),
        F.expr("timestampadd(SECOND, -(o_orderkey % 400), o_orderdate)").alias("Schedule"),
        c("o_orderdate").alias("Create"),
        F.when(c("o_orderkey") % 10 == 0, 0.0).otherwise(c("o_totalprice")).alias("RidePrice"),
        c("o_orderstatus").alias("RideStatus"),
        F.when(c("o_orderpriority") == "1-URGENT", F.lit(1).cast("bigint")).alias("ScheduledRide"))


def updated_rides(spark, sf_dir) -> DataFrame:
    """Rides with the last update among their estimates."""
    last = estimates(spark, sf_dir).groupBy("RideID").agg(F.max("Updated").alias("Updated"))
    return rides(spark, sf_dir).join(last, "RideID", "left")


def products(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"), F.col("p_type").alias("CategoryID"),
        F.col("p_name").alias("ProductDescription"))


def addresses(spark, sf_dir) -> DataFrame:
    return (table(spark, sf_dir, "lineitem").where("l_linenumber in (1, 2)")
            .groupBy(F.col("l_orderkey").alias("RideID"),
                     F.col("l_linenumber").cast("bigint").alias("RideAddressTypeID"))
            .agg(F.min("l_suppkey").alias("AddressID")))


def clock(spark, sf_dir) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "events").select(
        c("event_id").alias("RideID"), c("user_id").alias("UserID"), c("ts").alias("Create"),
        c("event_type").alias("CategoryID"), c("value").alias("Price"),
        F.expr("timestampadd(SECOND, -(event_id % 400), ts)").alias("Schedule"))


def analytical(spark, sf_dir) -> DataFrame:
    """Estimates with their ride and product. Spark broadcasts a side only below its size threshold."""
    return (estimates(spark, sf_dir).join(rides(spark, sf_dir), "RideID", "left")
            .join(products(spark, sf_dir), "ProductID", "left"))


def staged(spark, sf_dir) -> DataFrame:
    """Deduplicated estimates with ride, product and rule flags.

    The key and its order are estimate columns, so copies go before the joins: a ride with very many
    copies has shrunk to its distinct lines by the time rows are shuffled on the ride.
    """
    kept = first_per_key(estimates(spark, sf_dir), DEDUP_KEY, DEDUP_ORDER)
    joined = kept.join(rides(spark, sf_dir), "RideID", "left").join(products(spark, sf_dir), "ProductID", "left")
    return clean.flag_removals(joined, COORDINATES)


def curated_rows(spark, sf_dir) -> DataFrame:
    """Rows that pass every rule, before imputation and capping."""
    return staged(spark, sf_dir).where("removed_by is null").drop("removed_by", *clean.chronology_flags())


def priced(spark, sf_dir) -> DataFrame:
    """Estimates with their category only: what thresholds and price statistics need."""
    return estimates(spark, sf_dir).join(products(spark, sf_dir).select("ProductID", "CategoryID"), "ProductID", "left")


def curated(spark, sf_dir) -> DataFrame:
    return clean.finish(staged(spark, sf_dir), clean.thresholds(priced(spark, sf_dir), MEDIANS))


def curated_layer(spark, sf_dir, columns=None) -> DataFrame:
    """The curated layer as stored: feature steps read it several times."""
    rows = curated(spark, sf_dir)
    return materialize(rows.select(*columns) if columns else rows, "curated")


def with_category_history(spark, sf_dir, columns) -> DataFrame:
    """Curated rows with the user's history in the category, for evaluation."""
    base = curated_layer(spark, sf_dir, columns)
    past = history.user_category_history(history.category_base(base))
    return base.join(past.select("RideID", "CategoryID", *history.CATEGORY_HISTORY), ["RideID", "CategoryID"], "left")


def enriched(spark, sf_dir) -> DataFrame:
    """Curated rows with cross prices and user history."""
    base = curated_layer(spark, sf_dir)
    with_prices = history.attach_cross_prices(base, history.cross_prices(base, TARGETS, "CategoryID"))
    return history.attach_histories(with_prices, base)


def fold_frame(spark, sf_dir, *extra) -> DataFrame:
    rows = curated_rows(spark, sf_dir)
    return folds.temporal_frame(rows, ["RideEstimativeID", "RideID", "CategoryID", "Create", *extra], REGIME)


def fold_layer(spark, sf_dir, *extra) -> DataFrame:
    """The fold frame as stored: windows and every summary read it."""
    return materialize(fold_frame(spark, sf_dir, *extra), "folds")
