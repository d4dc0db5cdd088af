"""Repeatable stratified sampling with an exact size."""
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.bounded import lookup_join


def stratified_sample(df: DataFrame, group: str, key: str, size: int = fixed.SAMPLE_ROWS_PER_CATEGORY,
                      seed: int = fixed.SEED) -> DataFrame:
    """The `size` rows per group with the smallest seeded hash: the same rows under any partitioning.

    Rows are counted per (group, hash prefix); earlier prefixes give the offset of a prefix, and prefixes
    past the wanted size are dropped before any row is shuffled. What is left is ranked per prefix, so a
    large group never meets in one task.
    """
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}"))))
    hashed = hashed.withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    counts = hashed.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    needed = offsets.where(F.col("_before") < size).select(group, "_b", "_before")
    near = lookup_join(hashed, needed, [group, "_b"], "inner")
    rank = F.row_number().over(Window.partitionBy(group, "_b").orderBy("_h", key))
    # the plain rank is compared first, so each task sends at most `size` rows of a block
    first = near.withColumn("_r", rank).where(F.col("_r") <= size)
    return first.where(F.col("_r") + F.col("_before") <= size).select(*df.columns)
