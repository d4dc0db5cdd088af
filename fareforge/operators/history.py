"""Cross-product prices and user history, strictly from earlier rides."""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import add_temporal_features
from ..functions.quantiles import group_quantiles
from ..functions.running import first_per_key, prefix_scan
from ..functions.scalar import all_present, count_if, pct, rows

RIDE_HISTORY = ["UserPriorRideCount", "UserPriorPaidPriceMean"]
CATEGORY_HISTORY = ["UserPriorCategoryRideCount", "UserPriorCategoryPriceMean"]


def price_column(product: str) -> str:
    return f"Price_{product}"


def canonical_estimate(df: DataFrame, keys: list[str], estimate: str = "RideEstimativeID") -> DataFrame:
    """The estimate with the smallest id per key."""
    return first_per_key(df, keys, [estimate])


def cross_prices(df: DataFrame, products: list, product: str = "ProductID", estimate: str = "RideEstimativeID",
                 price: str = "Price") -> DataFrame:
    """One row per ride with the canonical price of each product; all columns always exist.

    A conditional `min_by` per product does the choice and the pivot in one aggregate with map-side combine.
    """
    of = lambda p: F.col(product) == p
    wanted = df.where(F.col(product).isin(list(products)))
    return wanted.groupBy("RideID").agg(*[
        F.min_by(price, F.when(of(p), F.col(estimate))).alias(price_column(p)) for p in products])


def cross_price_metrics(df: DataFrame, products: list, product: str = "ProductID") -> DataFrame:
    """Rows, rides, collapsed duplicates and ride coverage, overall and per product, as one row."""
    pairs = (df.where(F.col(product).isin(list(products)))
             .groupBy("RideID", product).agg(rows().alias("_n"), F.count("Price").alias("_priced")))
    rides = pairs.groupBy("RideID").agg(*[
        F.coalesce(F.sum(F.when(F.col(product) == p, F.col("_n"))), F.lit(0)).alias(f"n_{p}") for p in products])
    total = sum((F.col(f"n_{p}") for p in products[1:]), F.col(f"n_{products[0]}"))
    present = [F.col(f"n_{p}") > 0 for p in products]
    every = present[0]
    for c in present[1:]:
        every = every & c
    pairs_in_ride = sum((c.cast("int") for c in present[1:]), present[0].cast("int"))
    out = [F.coalesce(F.sum(total), F.lit(0)).alias("canonical_source_rows"),
           rows().alias("canonical_unique_ride_ids"),
           F.coalesce(F.sum(total - pairs_in_ride), F.lit(0)).alias("canonical_duplicate_rows_collapsed"),
           count_if(every).alias("rides_with_all_canonical_prices")]
    for p, here in zip(products, present):
        n = F.col(f"n_{p}")
        out += [F.coalesce(F.sum(n), F.lit(0)).alias(f"{p}_rows"), count_if(here).alias(f"{p}_unique_rides"),
                F.coalesce(F.sum(F.when(here, n - 1)), F.lit(0)).alias(f"{p}_duplicates_collapsed"),
                pct(count_if(here), rows()).alias(f"{price_column(p)}_ride_coverage_pct")]
    return rides.agg(*out)


def cross_price_coverage(enriched: DataFrame, products: list, product: str = "ProductID") -> DataFrame:
    """Availability of every cross price, and of both auxiliary prices, per model product."""
    columns = [price_column(p) for p in products]
    counted = enriched.where(F.col(product).isin(list(products))).groupBy(F.col(product).alias("p")).agg(
        rows().alias("n"), *[F.count(c).alias(c) for c in columns],
        *[count_if(all_present(*[c for c in columns if c != price_column(p)])).alias(f"both_{p}") for p in products])
    # at most one row per product, so a single row of totals feeds the fixed list of report lines
    total = lambda p, c: F.coalesce(F.max(F.when(F.col("p") == p, F.col(c))), F.lit(0))
    lines = []
    for p in products:
        for c in columns + ["pair"]:
            pair = c == "pair"
            found = total(p, f"both_{p}" if pair else c)
            lines.append(F.struct(
                F.lit(p).alias("ModelProduct"), F.lit("Both auxiliary prices" if pair else c).alias("FeatureName"),
                F.lit("auxiliary_pair" if pair else "target_equivalent" if c == price_column(p)
                      else "auxiliary_input").alias("FeatureRole"),
                found.alias("available_rows"), pct(found, total(p, "n")).alias("available_pct")))
    return counted.agg(F.array(*lines).alias("_a")).select(F.inline("_a"))


def ride_base(df: DataFrame) -> DataFrame:
    """One row per ride: the earliest by creation."""
    return first_per_key(df.select("RideID", "UserID", "Create", "RidePrice"), ["RideID"],
                         ["Create", "UserID", "RidePrice"])


def user_history(rides: DataFrame) -> DataFrame:
    """Per ride: the user's earlier rides, and the mean price of the paid ones among them.

    Unpaid rides count as rides but not in the mean.
    """
    paid = F.when(F.col("RidePrice") > 0, F.col("RidePrice"))
    out = prefix_scan(rides, ["UserID"], ["Create", "RideID"],
                      {"UserPriorRideCount": F.lit(1), "_paid": paid, "_paid_n": paid.isNotNull().cast("int")})
    mean = F.when(F.col("_paid_n") > 0, F.col("_paid") / F.col("_paid_n"))
    return out.withColumn("UserPriorPaidPriceMean", mean).drop("_paid", "_paid_n")


def category_base(df: DataFrame) -> DataFrame:
    """One row per (ride, category): the canonical estimate."""
    cols = ["RideID", "CategoryID", "UserID", "Create", "RideEstimativeID", "Price"]
    return canonical_estimate(df.select(*cols), ["RideID", "CategoryID"])


def user_category_history(pairs: DataFrame) -> DataFrame:
    """Per (ride, category): the user's earlier rides in that category and their mean price by row count."""
    out = prefix_scan(pairs, ["UserID", "CategoryID"], ["Create", "RideID", "RideEstimativeID"],
                      {"UserPriorCategoryRideCount": F.lit(1), "_price": F.col("Price")})
    n = F.col("UserPriorCategoryRideCount")
    return out.withColumn("UserPriorCategoryPriceMean", F.when(n > 0, F.col("_price") / n)).drop("_price")


def history_metrics(raw: DataFrame, lookup: DataFrame, count: str, mean: str, valid: Column, user: str = "UserID") -> DataFrame:
    """Rows scanned, collapsed, with a valid price, cold starts and percentiles of the prior count, as one row."""
    one = lookup.agg(
        rows().alias("unique_rows"), count_if(F.col(count) == 0).alias("cold_start_rows"),
        F.count(mean).alias("rows_with_mean"), count_if(valid).alias("rows_with_valid_price"))
    q = group_quantiles(lookup, [], count, {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    users = lookup.select(user).distinct().agg(rows()).scalar()
    scanned = raw.agg(rows()).scalar()
    quant = q.select(F.struct("p50", "p90", "p99")).scalar()
    out = one.withColumns({"rows_scanned": scanned, "unique_users": users, "_q": quant})
    return out.select(
        "rows_scanned", "unique_rows", (F.col("rows_scanned") - F.col("unique_rows")).alias("collapsed_rows"),
        "unique_users", "rows_with_valid_price", "cold_start_rows", "rows_with_mean",
        *[F.col(f"_q.{p}").cast("bigint").alias(f"prior_count_{p}") for p in ("p50", "p90", "p99")])


def attach_cross_prices(df: DataFrame, lookup: DataFrame) -> DataFrame:
    return df.join(lookup, "RideID", "left")


def attach_user_history(df: DataFrame, by_ride: DataFrame, by_category: DataFrame) -> DataFrame:
    return (df.join(by_ride.select("RideID", *RIDE_HISTORY), "RideID", "left")
            .join(by_category.select("RideID", "CategoryID", *CATEGORY_HISTORY), ["RideID", "CategoryID"], "left"))


def attach_histories(df: DataFrame, curated: DataFrame) -> DataFrame:
    """Both histories from the curated rows. `curated` is read several times and should be a stored layer."""
    return attach_user_history(df, user_history(ride_base(curated)), user_category_history(category_base(curated)))


def require_history(enriched: DataFrame) -> DataFrame:
    """The rows themselves, failing while they are computed when a count is missing after the joins."""
    broken = F.raise_error(F.lit("row without user history")).cast("bigint")
    counts = ["UserPriorRideCount", "UserPriorCategoryRideCount"]
    return enriched.withColumns({c: F.coalesce(F.col(c), broken) for c in counts})


def build_features(curated: DataFrame, products: list, product: str = "ProductID",
                   timestamps=("Schedule", "Create", "Updated"), first_year: int = 2020,
                   last_year: int = 2030) -> DataFrame:
    """The feature layer: calendar columns, cross prices and user history on every curated row."""
    calendar = add_temporal_features(curated, timestamps, first_year, last_year)
    enriched = attach_cross_prices(calendar, cross_prices(curated, products, product))
    return require_history(attach_histories(enriched, curated))


def history_coverage(enriched: DataFrame, categories: dict, group: str = "CategoryID") -> DataFrame:
    """Rows with a prior ride or a prior mean, per target category and over all rows."""
    rules = {
        "UserPriorRideCount": ("history_count", F.col("UserPriorRideCount") > 0),
        "UserPriorPaidPriceMean": ("history_value", F.col("UserPriorPaidPriceMean").isNotNull()),
        "UserPriorCategoryRideCount": ("category_count", F.col("UserPriorCategoryRideCount") > 0),
        "UserPriorCategoryPriceMean": ("category_value", F.col("UserPriorCategoryPriceMean").isNotNull()),
    }
    counted = enriched.groupBy(group).agg(
        rows().alias("n"), *[count_if(rule).alias(name) for name, (_, rule) in rules.items()])
    lines = []
    for code in [None, *categories]:
        scope = F.lit(True) if code is None else F.col(group) == code
        total = lambda c, s=scope: F.coalesce(F.sum(F.when(s, F.col(c))), F.lit(0))
        for name, (role, _) in rules.items():
            lines.append(F.struct(
                F.lit("ALL" if code is None else str(code)).alias(group),
                F.lit("overall" if code is None else categories[code]).alias("CategoryName"),
                F.lit(name).alias("FeatureName"), F.lit(role).alias("FeatureRole"),
                total(name).alias("available_rows"), pct(total(name), total("n")).alias("available_pct")))
    return counted.agg(F.array(*lines).alias("_a")).select(F.inline("_a"))


def feature_distribution(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value, count, pct) with values as text."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
        for i, f in enumerate(features)])).alias("_r")).select("_r.*")
    counts = long.groupBy("position", "feature", "value").agg(rows().alias("count"))
    whole = F.sum("count").over(Window.partitionBy("feature"))
    return (counts.withColumn("pct", pct(F.col("count"), whole))
            .orderBy("position", F.desc("count"), "value").drop("position"))


def feature_distribution_by_category(df: DataFrame, features: list[str], categories: list,
                                     group: str = "CategoryID") -> DataFrame:
    """Distribution within each target category; null values are kept."""
    long = df.where(F.col(group).isin(list(categories))).select(group, F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
        for i, f in enumerate(features)])).alias("_r")).select(group, "_r.*")
    counts = long.groupBy(group, "position", "feature", "value").agg(rows().alias("count"))
    whole = F.sum("count").over(Window.partitionBy(group, "feature"))
    return (counts.withColumn("pct", pct(F.col("count"), whole))
            .orderBy(group, "position", F.desc("count"), "value").drop("position"))
