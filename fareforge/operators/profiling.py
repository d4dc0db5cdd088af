"""Table profiling: one wide aggregate for per-column sums, one unpivoted aggregate for distinct values."""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.bounded import lookup_join, settle
from ..functions.quantiles import quantile_rows
from ..functions.running import first_per_key, repeated_keys
from ..functions.scalar import count_if, pct, rounded, rows


def base_profile(fact: DataFrame, ride_key: str = "RideID", product_key: str = "ProductID") -> DataFrame:
    """Rows, null keys and distinct active keys of the fact table."""
    distinct_rides = fact.select(ride_key).where(F.col(ride_key).isNotNull()).distinct()
    distinct_products = fact.select(product_key).where(F.col(product_key).isNotNull()).distinct()
    counts = fact.agg(rows().alias("rows"), count_if(F.col(ride_key).isNull()).alias("null_ride_keys"),
                      count_if(F.col(product_key).isNull()).alias("null_product_keys"))
    return counts.withColumns({
        "distinct_rides": distinct_rides.agg(rows()).scalar(),
        "distinct_products": distinct_products.agg(rows()).scalar(),
    })


def reconstruct(df: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """The logical table hidden in a wider layer: distinct rows, then one row per key."""
    return first_per_key(df.select(*columns).distinct(), key, columns)


def reconstruction_stats(df: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """Counts of a reconstruction from two grouped passes: by row, then by key."""
    by_row = df.groupBy(*columns).agg(rows().alias("_copies"))
    by_key = by_row.groupBy(*key).agg(F.sum("_copies").alias("_scanned"), rows().alias("_distinct"))
    return by_key.agg(
        F.coalesce(F.sum("_scanned"), F.lit(0)).alias("rows_scanned"),
        F.coalesce(F.sum("_distinct"), F.lit(0)).alias("distinct_rows"),
        rows().alias("logical_rows"),
        count_if(F.col("_distinct") > 1).alias("conflicting_keys"),
    ).withColumn("exact_duplicate_rows", F.col("rows_scanned") - F.col("distinct_rows"))


def duplicate_summary(df: DataFrame, key: list[str]) -> DataFrame:
    """Surplus rows by key and by whole row, and keys whose rows differ."""
    by_row = df.groupBy(*df.columns).agg(rows().alias("_copies"))
    by_key = by_row.groupBy(*key).agg(F.sum("_copies").alias("_rows"), rows().alias("_distinct"))
    return by_key.agg(
        (F.sum("_rows") - rows()).alias("duplicate_key_rows"),
        (F.sum("_rows") - F.sum("_distinct")).alias("duplicate_full_rows"),
        count_if(F.col("_distinct") > 1).alias("conflicting_keys"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, null_count, null_pct): one row of counters, then turned into rows."""
    names = columns or df.columns
    wide = df.agg(rows().alias("_n"), *[count_if(F.col(c).isNull()).alias(c) for c in names])
    long = wide.unpivot(["_n"], names, "column", "null_count")
    return long.select("column", "null_count", pct(F.col("null_count"), F.col("_n"), 2).alias("null_pct"))


def high_null_columns(profile: DataFrame, at_least: float = fixed.HIGH_NULL_PCT) -> DataFrame:
    level = F.when(F.col("null_pct") >= fixed.CRITICAL_NULL_PCT, "critical").otherwise("moderate")
    return (profile.where(F.col("null_pct") >= at_least).withColumn("level", level)
            .orderBy(F.desc("null_pct"), "column"))


def value_text(name: str) -> Column:
    return F.col(name).cast("string")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) over the unpivoted table; null is a value of its own. Partial counts
    are made before the shuffle, and rows of one column spread over the distinct values."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), value_text(c).alias("value")) for c in columns
    ])).alias("_r")).select("_r.*")
    return long.groupBy("column", "value").agg(rows().alias("count"))


def column_cardinality(counts: DataFrame) -> DataFrame:
    """(column, non_null, uniques, has_null, unique_ratio)."""
    present = F.col("value").isNotNull()
    out = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(present, F.col("count"))), F.lit(0)).alias("non_null"),
        count_if(present).alias("uniques"),
        F.max(~present).alias("has_null"))
    ratio = F.coalesce(rounded(F.try_divide(F.col("uniques"), F.col("non_null"))), F.lit(0.0))
    return out.withColumn("unique_ratio", ratio)


def _kind(schema: T.StructType) -> Column:
    """Type kind per column name, as a literal map."""
    kinds = {f.name: "text" if isinstance(f.dataType, T.StringType)
             else "number" if isinstance(f.dataType, T.NumericType) else "other" for f in schema}
    return F.try_element_at(F.create_map(*[F.lit(x) for p in kinds.items() for x in p]), F.col("column"))


def cardinality_classes(df: DataFrame, key: str) -> DataFrame:
    """Text with many values is high-cardinality; other text and small numeric domains are categorical."""
    columns = [c for c in df.columns if c != key]
    out = column_cardinality(value_counts(df, columns)).withColumn("kind", _kind(df.schema))
    wide = (F.col("uniques") > fixed.CATEGORICAL_MAX_UNIQUES) | (F.col("unique_ratio") > fixed.CATEGORICAL_MAX_RATIO)
    text = F.col("kind") == "text"
    small_number = (F.col("kind") == "number") & (F.col("uniques") <= fixed.SMALL_DOMAIN)
    label = (F.when(text & wide, "high_cardinality").when(text | small_number, "categorical").otherwise("other"))
    return out.select("column", "non_null", "uniques", "unique_ratio", label.alias("class"))


def top_values(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """The k most frequent values per column with the column's distinct values and their share of its rows; ties by value.

    The rank filter prunes before the shuffle.
    """
    counts = settle(value_counts(df, columns).where("value is not null"), "values")
    w = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    whole = column_cardinality(counts).select("column", F.col("uniques").alias("unique_count"), "unique_ratio")
    return lookup_join(top, whole, "column")


def constant_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns with at most one distinct value, null included. Min = max replaces a distinct count."""
    names = columns or df.columns
    wide = df.agg(*[
        (((F.min(c) == F.max(c)) & ~F.max(F.col(c).isNull())) | F.min(c).isNull()).alias(c) for c in names])
    return wide.unpivot([], names, "column", "constant").where("constant").select("column")


def outlier_candidates(df: DataFrame, key: str) -> list[str]:
    """Numeric, not the key, not named like an id. The rule on distinct values is applied to the result."""
    return [f.name for f in df.schema
            if isinstance(f.dataType, T.NumericType) and f.name != key and not f.name.lower().endswith("id")]


def iqr_outliers(df: DataFrame, columns: list[str], min_uniques: int = 11) -> DataFrame:
    """Quartiles, fences and values outside them, per column. A zero IQR means no outliers.

    Quartiles come from one pass over the unpivoted columns; the fences are one row of literals for
    the second pass, read as a scalar, so no join is needed.
    """
    quartiles = quantile_rows(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    reach = F.when(iqr == 0, 0.0).otherwise(1.5 * iqr)
    fenced = quartiles.withColumns({"iqr": iqr, "lower_bound": F.col("q1") - reach,
                                    "upper_bound": F.col("q3") + reach})
    row = fenced.agg(*[
        F.max(F.when(F.col("column") == c, F.struct("iqr", "lower_bound", "upper_bound"))).alias(c)
        for c in columns]).select(F.struct("*")).scalar()
    limits = df.select(*columns).withColumn("_f", row)

    def outside(c):
        f = F.col("_f")[c]
        return count_if((f["iqr"] != 0) & ((F.col(c) < f["lower_bound"]) | (F.col(c) > f["upper_bound"])))
    uniques = column_cardinality(value_counts(df, columns)).select("column", "uniques")
    second = limits.agg(F.array(*[
        F.struct(F.lit(c).alias("column"), F.count(c).alias("n"),
                 F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
                 outside(c).alias("outlier_count")) for c in columns]).alias("_a"))
    counted = second.select(F.inline("_a"))
    out = fenced.join(counted, "column").join(uniques, "column").where(F.col("uniques") >= min_uniques)
    names = ["min", "q1", "median", "q3", "max", "iqr", "lower_bound", "upper_bound"]
    return out.select("column", *[rounded(F.col(c)).alias(c) for c in names], "outlier_count",
                      pct(F.col("outlier_count"), F.col("n"), 2).alias("outlier_pct"))


def high_outlier_columns(outliers: DataFrame, at_least: float = fixed.HIGH_OUTLIER_PCT) -> DataFrame:
    return (outliers.where(F.col("outlier_pct") >= at_least).select("column", "outlier_count", "outlier_pct")
            .orderBy(F.desc("outlier_pct"), "column"))


def dtype_summary(df: DataFrame) -> DataFrame:
    """(column, dtype), carried by one aggregate row of the table it describes."""
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(t).alias("dtype")) for n, t in df.dtypes])
    return df.agg(rows().alias("rows")).select("rows", F.inline(pairs)).select("column", "dtype", "rows")
