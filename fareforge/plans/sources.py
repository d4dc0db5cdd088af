"""Scans and sinks."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import count_if, rounded, rows
from ..operators import history, joins
from ..operators.profiling import base_profile, null_profile
from ..session import scratch_path
from ..sources import delimited, layers
from . import views as v
from .registry import big, pct, query, rnd

EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "value": "double"}


@query("scan_delimited", """
SELECT event_id AS RideID, ts AS "Create", user_id,
       CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 11 <> 0 THEN value END AS value, props
FROM events""")
def scan_delimited(spark, sf_dir):
    e = v.table(spark, sf_dir, "events")
    text = e.select(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id",
        F.when(F.col("event_id") % 7 == 0, "NA").otherwise(F.concat(F.lit(" "), "event_type", F.lit(" "))).alias("event_type"),
        F.when(F.col("event_id") % 11 == 0, "nan").otherwise(F.col("value").cast("string")).alias("value"),
        "props", F.lit("+55").alias("Phone"))
    path = scratch_path(spark, "delimited")
    text.write.csv(path, sep=";", header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                   ignoreTrailingWhiteSpace=False)
    return delimited.read_delimited(spark, path, EVENT_TYPES, {"event_id": "RideID", "ts": "Create"},
                                    key_columns=("event_type",))


@query("drop_pii", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer""")
def drop_pii(spark, sf_dir):
    named = v.table(spark, sf_dir, "customer").withColumnsRenamed({"c_name": "Name", "c_mktsegment": "Driver"})
    return delimited.drop_pii(named)


@query("base_profile", f"""
SELECT count(*) AS rows, {big('count(*) - count(RideID)')} AS null_ride_keys,
       {big('count(*) - count(ProductID)')} AS null_product_keys,
       count(DISTINCT RideID) AS distinct_rides, count(DISTINCT ProductID) AS distinct_products
FROM ve""")
def base(spark, sf_dir):
    return base_profile(v.estimates(spark, sf_dir))


@query("scan_projection", """
SELECT RideID, ProductID, Price FROM ve""")
def scan_projection(spark, sf_dir):
    return v.estimates(spark, sf_dir).select("RideID", "ProductID", "Price")


def _event_layer(spark, sf_dir):
    path = scratch_path(spark, "events")
    layers.write_layer(v.clock(spark, sf_dir), path)
    return path


@query("scan_partition_filter", """
SELECT RideID, "Create", Price FROM vk WHERE CategoryID = 'click'""")
def scan_partition_filter(spark, sf_dir):
    return layers.read_layer(spark, _event_layer(spark, sf_dir), ["RideID", "Create", "Price"], ["click"])


@query("scan_in_filter", """
SELECT CategoryID, RideID, Price FROM vk WHERE CategoryID IN ('click', 'error', 'purchase')""")
def scan_in_filter(spark, sf_dir):
    return layers.read_layer(spark, _event_layer(spark, sf_dir), ["CategoryID", "RideID", "Price"],
                             ["click", "error", "purchase"])


@query("partitioned_roundtrip", f"""
SELECT CategoryID, count(*) AS rows, {rnd('sum(Price)', 2)} AS total_price, min(RideEstimativeID) AS first_id
FROM va GROUP BY 1""")
def partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "analytical")
    layers.write_layer(v.analytical(spark, sf_dir), path)
    return layers.read_layer(spark, path, ["CategoryID", "Price", "RideEstimativeID"]).groupBy("CategoryID").agg(
        rows().alias("rows"), rounded(F.sum("Price"), 2).alias("total_price"),
        F.min("RideEstimativeID").alias("first_id"))


@query("export_category", f"""
SELECT CategoryID, count(*) AS rows, min("Create") AS min_time, max("Create") AS max_time,
       {rnd('sum(Price)', 2)} AS total_price
FROM va WHERE CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO') GROUP BY 1""")
def export_category(spark, sf_dir):
    """All categories by one job over one evaluation of the source."""
    root = scratch_path(spark, "export")
    source = v.analytical(spark, sf_dir).select("CategoryID", "Create", "RideID", "RideEstimativeID", "Price")
    layers.export_final(source, root, v.TARGETS, ["Create", "RideID", "RideEstimativeID"])
    return spark.read.parquet(root).groupBy("CategoryID").agg(
        rows().alias("rows"), F.min("Create").alias("min_time"), F.max("Create").alias("max_time"),
        rounded(F.sum("Price"), 2).alias("total_price"))


@query("export_final", f"""
SELECT CategoryID, count(*) AS rows, {big('count(*) FILTER (WHERE Price > 0)')} AS positive_target, min("Create") AS min_time,
       max("Create") AS max_time, {rnd('sum(Price)', 2)} AS total_price, {big('count(DISTINCT RideEstimativeID)')} AS ids,
       {big('0')} AS files_out_of_order, {big("count(CASE WHEN CategoryID = 'ECONOMY' THEN NULL ELSE Price_ECONOMY END)")} AS auxiliary_prices
FROM (SELECT vc.*, xp.Price_ECONOMY FROM vc LEFT JOIN xp USING (RideID)) WHERE CategoryID IN ('ECONOMY', 'STANDARD', 'PROMO') GROUP BY 1""")
def export_final(spark, sf_dir):
    """Contracts, leakage-safe columns and one sorted job, read back with the order of its files."""
    base = v.curated_layer(spark, sf_dir, ["RideEstimativeID", "RideID", "CategoryID", "Create", "Price"])
    own = {p: f"Price_{p}" for p in v.TARGETS}
    wide = history.attach_cross_prices(base, history.cross_prices(base, v.TARGETS, "CategoryID"))
    safe = wide.withColumns({c: F.when(F.col("CategoryID") != p, F.col(c)) for p, c in own.items()})
    root = scratch_path(spark, "final")
    seen = layers.export_final(safe, root, v.TARGETS, ["Create", "RideID", "RideEstimativeID"], own)
    back = spark.read.parquet(root)
    observed = spark.createDataFrame([(c, n["rows"], n["positive"]) for c, n in seen.items()], "CategoryID string, rows bigint, positive_target bigint")
    return observed.join(export_order(back, ["Create", "RideID", "RideEstimativeID"]), "CategoryID").join(back.groupBy("CategoryID").agg(
        F.min("Create").alias("min_time"), F.max("Create").alias("max_time"), rounded(F.sum("Price"), 2).alias("total_price"),
        F.count_distinct("RideEstimativeID").alias("ids"), F.count("Price_ECONOMY").alias("auxiliary_prices")), "CategoryID")


def export_order(back, order):
    """Per category the files whose first row does not come after the last row of the file before."""
    key = F.struct(*order)
    files = back.groupBy("CategoryID", F.input_file_name().alias("file")).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    before = F.lag("last").over(Window.partitionBy("CategoryID").orderBy("file"))
    return files.withColumn("wrong", F.coalesce(F.col("first") <= before, F.lit(False))).groupBy("CategoryID").agg(
        F.count_if("wrong").alias("files_out_of_order"))


@query("metrics_csv_roundtrip", f"""
SELECT CategoryID, count(*) AS rows, {rnd('avg(Price)')} AS mean_price, min("Create") AS min_time
FROM va GROUP BY 1""")
def metrics_csv_roundtrip(spark, sf_dir):
    metrics = v.analytical(spark, sf_dir).groupBy("CategoryID").agg(
        rows().alias("rows"), rounded(F.avg("Price")).alias("mean_price"), F.min("Create").alias("min_time"))
    path = layers.write_metrics_csv(metrics, scratch_path(spark, "metrics"))
    return layers.read_metrics_csv(spark, path, metrics.schema)


PROFILED = ["WaitingTime", "FareID", "OriginLat", "Price"]


@query("profile_report_json", "SELECT * FROM (" + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", {big(f'count(*) - count({c})')} AS null_count,
       {pct(f'count(*) - count({c})', 'count(*)', 2)} AS null_pct FROM ve""" for c in PROFILED) + ")")
def profile_report_json(spark, sf_dir):
    """The nested report goes to JSON and is read back. One row per profiled column, so the list is short."""
    profile = null_profile(v.estimates(spark, sf_dir), PROFILED)
    report = profile.agg(F.sort_array(F.collect_list(F.struct("column", "null_count", "null_pct"))).alias("columns"))
    path = layers.write_report_json(report, scratch_path(spark, "report"))
    return spark.read.schema(report.schema).json(path).select(F.inline("columns"))


@query("write_reconciliation", """
SELECT count(*) AS source_rows, count(*) AS written_rows, true AS reconciled FROM va""")
def write_reconciliation(spark, sf_dir):
    """Rows as the writing tasks saw them against rows on storage; the source is evaluated once."""
    path = scratch_path(spark, "reconciled")
    seen = layers.write_layer(v.analytical(spark, sf_dir), path)
    return layers.reconcile(seen["rows"], spark.read.parquet(path))


@query("partition_row_counts", """
SELECT CategoryID, count(*) AS rows FROM va GROUP BY 1""")
def partition_row_counts(spark, sf_dir):
    return layers.partition_row_counts(v.analytical(spark, sf_dir))


@query("analytical_validation", """
SELECT (SELECT count(*) FROM ve) AS source_rows, count(*) AS written_rows,
       CAST(count(*) FILTER (WHERE o.AddressID IS NULL) AS BIGINT) AS missing_origin,
       CAST(count(*) FILTER (WHERE d.AddressID IS NULL) AS BIGINT) AS missing_destination,
       count(*) = (SELECT count(*) FROM ve) AS ready_for_eda
FROM ve LEFT JOIN (SELECT * FROM vad WHERE RideAddressTypeID = 1) o ON ve.RideID = o.RideID
LEFT JOIN (SELECT * FROM vad WHERE RideAddressTypeID = 2) d ON ve.RideID = d.RideID""")
def analytical_validation(spark, sf_dir):
    source = v.estimates(spark, sf_dir)
    wide = joins.split_addresses(v.addresses(spark, sf_dir))
    built = source.join(wide, "RideID", "left")
    total = source.agg(rows()).scalar()
    return built.agg(rows().alias("written_rows"),
                     count_if(F.col("OriginAddressID").isNull()).alias("missing_origin"),
                     count_if(F.col("DestinationAddressID").isNull()).alias("missing_destination")
                     ).withColumn("source_rows", total).withColumn(
                         "ready_for_eda", F.col("written_rows") == F.col("source_rows"))
