"""Validated joins between the fact table and its dimensions."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checks import SAMPLE, broken, domain_violations, repeated_keys, require


def prefix_columns(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def active_only(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Dimension rows that some fact row refers to. Keys are made distinct first, which happens before the
    shuffle, so a key with very many fact rows arrives once per task."""
    return dim.join(fact.select(key).distinct(), key, "left_semi")


def uncovered_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct fact keys that the dimension lacks."""
    return fact.select(key).where(F.col(key).isNotNull()).distinct().join(dim.select(key), key, "left_anti")


def attach_dimension(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join that keeps a marker column `_matched`."""
    marked = dim.withColumn("_matched", F.lit(True))
    joined = fact.join(marked, key, "left")
    return joined.withColumn("_matched", F.coalesce("_matched", F.lit(False)))


def dimension_violations(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys that repeat in the dimension, keys it lacks, and null keys of the fact table."""
    tagged = lambda df, text: df.select(key, F.lit(text).alias("violation"))
    return (tagged(repeated_keys(dim, [key]), "repeated in dimension")
            .unionByName(tagged(uncovered_keys(fact, dim, key), "missing in dimension"))
            .unionByName(tagged(fact.where(F.col(key).isNull()), "null key")))


def merge_dimension(fact: DataFrame, dim: DataFrame, key: str, name: str, required: bool = True) -> DataFrame:
    """Many-to-one left join that fails, while it runs, when a key repeats in the dimension or, if a match is required,
    when a fact row has none. Grouping the dimension by its key is the shuffle that the join needs anyway."""
    columns = [c for c in dim.columns if c != key]
    one = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*columns)).alias("_d"))
    once = one.select(key, F.when(F.col("_n") == 1, F.col("_d")).otherwise(broken(f"{name}: repeated in dimension", key)).alias("_d"))
    joined = fact.join(once, key, "left")
    found = F.coalesce("_d", broken(f"{name}: missing in dimension", key)) if required else F.col("_d")
    return joined.withColumn("_d", found).select(*fact.columns, *[F.col("_d")[c].alias(c) for c in columns])


def unmatched_sample(fact: DataFrame, dim: DataFrame, key: str, sample: int = SAMPLE) -> DataFrame:
    return uncovered_keys(fact, dim, key).orderBy(key).limit(sample)


def full_outer_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One-to-one full outer join with the side each row came from."""
    both = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), key, "full_outer")
    side = (F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only")
            .otherwise("both"))
    return both.withColumn("side", side).drop("_l", "_r")


def split_addresses(addresses: DataFrame, key: str = "RideID", kind: str = "RideAddressTypeID") -> DataFrame:
    """Long to wide: type 1 is the origin, type 2 the destination; null types are ignored."""
    def one(value: int, prefix: str) -> DataFrame:
        rows = addresses.where(F.col(kind) == value).drop(kind)
        return prefix_columns(rows, prefix, [key])
    return full_outer_sides(one(1, "Origin"), one(2, "Destination"), key)


def require_addresses(addresses: DataFrame, key: str = "RideID", kind: str = "RideAddressTypeID") -> DataFrame:
    typed = addresses.where(F.col(kind).isNotNull())
    odd = domain_violations(addresses, kind, [1, 2]).select(F.lit(None).cast("bigint").alias(key), kind)
    require(odd.unionByName(repeated_keys(typed, [key, kind]).select(key, kind)),
            "unexpected or repeated address type")
    return addresses


def build_analytical(estimates: DataFrame, rides: DataFrame, products: DataFrame,
                     addresses: DataFrame) -> DataFrame:
    """Star join of the four tables with every contract in the plan: unique keys in all dimensions, a ride and a product
    with a category for every estimate. Rides without an address keep null address columns.

    Rides and addresses are as large as the fact table allows, so both are shuffled on RideID and the second join
    reuses the partitioning of the first.
    """
    require_addresses(addresses)
    wide = split_addresses(active_only(addresses, estimates, "RideID")).drop("side")
    out = merge_dimension(estimates, active_only(rides, estimates, "RideID"), "RideID", "ride")
    out = merge_dimension(out, wide, "RideID", "rideaddress", required=False)
    out = merge_dimension(out, active_only(products, estimates, "ProductID"), "ProductID", "product")
    return out.withColumn("CategoryID", F.coalesce("CategoryID", broken("product without a category:", "ProductID")))
