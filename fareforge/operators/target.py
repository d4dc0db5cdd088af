"""Target analysis per category."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.bounded import lookup_join
from ..functions.quantiles import group_quantiles
from ..functions.scalar import adjusted_skewness, count_if, pct, rounded, rows


def _fences(df: DataFrame, group: str, value: str) -> DataFrame:
    q = group_quantiles(df, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({
        "iqr": iqr,
        "mild_lower": F.col("q1") - 1.5 * iqr, "mild_upper": F.col("q3") + 1.5 * iqr,
        "extreme_lower": F.col("q1") - 3.0 * iqr, "extreme_upper": F.col("q3") + 3.0 * iqr,
    })


def target_stats(df: DataFrame, group: str = "CategoryID", value: str = "Price") -> DataFrame:
    """Moments, fences and shares outside them. Second pass joins the few fence rows by size check."""
    fences = _fences(df, group, value)
    v = F.col(value)
    outside = lambda kind: count_if((v < F.col(f"{kind}_lower")) | (v > F.col(f"{kind}_upper")))
    carried = [c for c in fences.columns if c != group]
    stats = lookup_join(df.select(group, value), fences, group, "inner").groupBy(group, *carried).agg(
        rows().alias("rows"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"), adjusted_skewness(v).alias("skewness"),
        outside("mild").alias("mild_count"), outside("extreme").alias("extreme_count"),
        count_if(v == 0).alias("zero_count"))
    reals = ["mean", "median", "std", "min", "max", "skewness", "iqr",
             "mild_lower", "mild_upper", "extreme_lower", "extreme_upper"]
    counts = ["mild_count", "extreme_count", "zero_count"]
    return stats.select(
        group, "rows", *[rounded(F.col(c)).alias(c) for c in reals], *counts,
        *[pct(F.col(c), F.col("rows"), 2).alias(c.replace("_count", "_pct")) for c in counts])


def target_percentiles(df: DataFrame, group: str = "CategoryID", value: str = "Price") -> DataFrame:
    q = group_quantiles(df, [group], value, fixed.TARGET_PERCENTILES)
    return q.select(group, *[rounded(F.col(c)).alias(c) for c in fixed.TARGET_PERCENTILES])


def target_histogram(df: DataFrame, group: str = "CategoryID", value: str = "Price", bins: int = 80) -> DataFrame:
    """Equal-width bins between the group's minimum and maximum."""
    limits = df.groupBy(group).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    v = F.col(value)
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.when(width == 0, 1).otherwise(F.least(F.floor((v - F.col("lo")) / width) + 1, F.lit(bins)))
    binned = lookup_join(df.select(group, value).where(v.isNotNull()), limits, group, "inner")
    return (binned.groupBy(group, slot.cast("bigint").alias("bin"), "lo", "hi").agg(rows().alias("count"))
            .select(group, "bin", rounded(F.col("lo") + (F.col("bin") - 1) * width).alias("bin_start"),
                    rounded(F.col("lo") + F.col("bin") * width).alias("bin_end"), "count"))


def axis_limits(df: DataFrame, group: str = "CategoryID", value: str = "Price") -> DataFrame:
    """Upper axis limit of the histogram: the 99.5th percentile."""
    return group_quantiles(df, [group], value, {"axis_limit": 0.995})


def target_boxplot(df: DataFrame, group: str = "CategoryID", value: str = "Price") -> DataFrame:
    """Five-number summary with whiskers at the last values inside the mild fences."""
    fences = _fences(df, group, value)
    v = F.col(value)
    inside = F.when(v.between(F.col("mild_lower"), F.col("mild_upper")), v)
    box = ["q1", "median", "q3"]
    out = lookup_join(df.select(group, value), fences, group, "inner").groupBy(group, *box).agg(
        F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))
    names = ["whisker_low", *box, "whisker_high"]
    return out.select(group, *[rounded(F.col(c)).alias(c) for c in names])


def shape_class(skewness: Column) -> Column:
    """By the signed skewness: a long left tail counts as near symmetric."""
    return F.when(skewness < 0.5, "near_symmetric").when(skewness < 1, "moderate").otherwise("strong")


def treatment_note(extreme_pct: Column, skewness: Column) -> Column:
    return F.when((extreme_pct < 0.5) & (skewness < 1), "light").otherwise("robust")
