"""Pairwise Pearson correlation and what follows from it."""
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.scalar import count_if, label, pct, rounded, rows
from .profiling import column_cardinality, value_counts


def comoments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column pair the rows where both are present, with their sums and products about the columns' means.

    Tasks add up matrices over blocks of rows: with nulls as zeros, products of the values with the values, and of values
    and squares with the masks of what is present, hold every pair at once. A task sends one row per pair.
    """
    means = df.agg(*[F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(c) for c in columns]).first()
    shift = np.array([means[c] or 0.0 for c in columns])
    upper = np.triu_indices(len(columns), 1)
    fields = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"

    def run(batches):
        total = np.zeros((6, len(columns), len(columns)))
        for b in batches:
            x = b.to_numpy(dtype=float, na_value=np.nan) - shift
            here = (~np.isnan(x)).astype(float)
            x = np.where(here > 0, x, 0.0)
            total += np.stack([here.T @ here, x.T @ here, here.T @ x, (x * x).T @ here, here.T @ (x * x), x.T @ x])
        yield pd.DataFrame(dict(zip([f.split()[0] for f in fields.split(", ")], [*upper, *[m[upper] for m in total]]))).astype({"i": "int32", "j": "int32"})

    partial = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInPandas(run, fields)
    return partial.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def correlation_long(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """All column pairs in one pass of sums: (feature_left, feature_right, corr, corr_raw).

    Each pair uses the rows where both columns are present; a pair without spread on a side has no correlation.
    """
    n = F.col("n")
    var = lambda s, q: F.col(q) - F.col(s) * F.col(s) / n
    spread = lambda s, q: F.when(var(s, q) > 1e-13 * F.col(q), var(s, q))
    raw = F.when(n > 1, (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(spread("sx", "sxx") * spread("sy", "syy")))
    names = F.array(*map(F.lit, columns))
    out = comoments(df, columns).select(names[F.col("i")].alias("feature_left"), names[F.col("j")].alias("feature_right"), raw.alias("corr_raw"))
    return out.withColumn("corr", rounded(F.col("corr_raw"), digits))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Symmetric long form with a unit diagonal, still one pass over the data."""
    upper = correlation_long(df, columns).select("feature_left", "feature_right", "corr")
    cell = lambda a, b, r: F.struct(F.col(a).alias("feature"), F.col(b).alias("other"), r.alias("corr"))
    left, right, r = "feature_left", "feature_right", F.col("corr")
    # the first column pairs with every other one, so its rows carry the diagonal
    first = F.col(left) == columns[0]
    extra = F.when(first & (F.col(right) == columns[1]), F.array(cell(left, left, F.lit(1.0)), cell(right, right, F.lit(1.0)))) \
        .when(first, F.array(cell(right, right, F.lit(1.0)))).otherwise(F.array().cast("array<struct<feature:string,other:string,corr:double>>"))
    cells = F.concat(F.array(cell(left, right, r), cell(right, left, r)), extra)
    return upper.select(F.inline(cells))


def column_metadata(df: DataFrame, columns: list[str], excluded: dict[str, str], leakage: list[str],
                    families: dict[str, str]) -> DataFrame:
    """Type, nulls, distinct values, spread and role of every column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    sums = df.agg(rows().alias("n"), F.array(*[
        F.struct(F.lit(c).alias("column"), count_if(F.col(c).isNull()).alias("null_count"),
                 (F.stddev_samp(c) if c in numeric else F.lit(None).cast("double")).alias("std"))
        for c in columns]).alias("_a")).select("n", F.inline("_a"))
    uniques = column_cardinality(value_counts(df, columns)).select("column", "uniques")
    name = F.col("column")
    return sums.join(uniques, "column").select(
        name.alias("feature"), label(name, types).alias("dtype"), "null_count",
        pct(F.col("null_count"), F.col("n"), 2).alias("null_pct"), F.col("uniques").alias("nunique"),
        F.coalesce(rounded(F.col("std"), 6), F.lit(0.0)).alias("std"),
        (~name.isin(list(excluded))).alias("included_in_matrix"),
        label(name, excluded or {"": ""}, "").alias("exclusion_reason"),
        F.when(name.isin(leakage), "leakage_or_post_event").otherwise("candidate").alias("feature_status"),
        label(name, families, "other").alias("feature_family"))


def target_correlation(df: DataFrame, columns: list[str], target: str, metadata: DataFrame,
                       leakage: list[str]) -> DataFrame:
    """Correlation of every feature to the target, strongest first, with its metadata."""
    against = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"),
                                 F.col(target).cast("double").alias("y")) for c in columns if c != target])
    ranked = (df.select(F.explode(against).alias("_p")).select("_p.*")
              .groupBy("feature").agg(F.corr("x", "y").alias("raw")))
    role = F.when(F.col("feature").isin(leakage), "exclude").otherwise("candidate")
    meta = metadata.select("feature", "null_pct", "feature_status", "feature_family")
    return (ranked.join(meta, "feature", "left")
            .select("feature", rounded(F.col("raw"), 6).alias("corr_to_target"),
                    rounded(F.abs("raw"), 6).alias("abs_corr_to_target"),
                    "null_pct", "feature_status", "feature_family", role.alias("modeling_role"))
            .orderBy(F.desc("abs_corr_to_target"), "feature"))


def multicollinear_pairs(df: DataFrame, columns: list[str], target: str,
                         at_least: float = fixed.HIGH_CORRELATION) -> DataFrame:
    long = correlation_long(df, [c for c in columns if c != target])
    return (long.where(F.abs("corr_raw") >= at_least)
            .select("feature_left", "feature_right", "corr", rounded(F.abs("corr_raw"), 6).alias("abs_corr"))
            .orderBy(F.desc("abs_corr"), "feature_left", "feature_right"))


def low_signal(ranking: DataFrame, below: float = fixed.LOW_TARGET_CORRELATION) -> DataFrame:
    action = label(F.col("feature_family"), fixed.LOW_SIGNAL_ACTIONS, fixed.LOW_SIGNAL_DEFAULT)
    return (ranking.where((F.col("modeling_role") == "candidate") & (F.col("abs_corr_to_target") < below))
            .withColumn("possible_action", action))
