"""Mean predictors per time fold: deterministic models that make the evaluation checkable to the digit."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bounded import lookup_join
from ..functions.scalar import rows


def fold_sums(marked: DataFrame, keys: list[str], n_splits: int, target: str = "Price") -> DataFrame:
    """Sum and count of the target over the training rows of every fold: (keys, number, total, n).

    Rows are summed per first training fold; only those sums are carried on to the later, larger folds.
    """
    once = marked.where(F.col("train_from") <= n_splits).groupBy(*keys, "train_from").agg(
        F.sum(target).alias("total"), rows().alias("n"))
    spread = once.select(*keys, "total", "n", F.explode(F.sequence("train_from", F.lit(n_splits))).alias("number"))
    return spread.groupBy(*keys, "number").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def score_means(marked: DataFrame, n_splits: int, category: str = "CategoryID", product: str = "ProductID",
                waiting: str = "WaitingTime", history: str = "UserPriorCategoryPriceMean") -> DataFrame:
    """Evaluation rows with category, product and waiting-time means of their fold's training rows."""
    held = marked.where(F.col("evaluated_in") <= n_splits).withColumnRenamed("evaluated_in", "number")
    by_category = fold_sums(marked, [category], n_splits).select(
        category, "number", (F.col("total") / F.col("n")).alias("category_mean"), F.col("n").alias("TrainRows"))
    by_waiting = fold_sums(marked, [category, waiting], n_splits).select(
        category, waiting, "number", (F.col("total") / F.col("n")).alias("waiting_mean"))
    by_product = fold_sums(marked, [product], n_splits).select(
        product, "number", F.col("total").alias("product_total"), F.col("n").alias("product_n"))
    out = lookup_join(held, by_category, [category, "number"], "inner")
    out = lookup_join(out, by_waiting, [category, waiting, "number"])
    return out.join(by_product, [product, "number"], "left")


def shrunk_mean(strength: float):
    """Product mean pulled to the category mean by `strength` pseudo-rows."""
    total, n, base = F.coalesce("product_total", F.lit(0.0)), F.coalesce("product_n", F.lit(0)), F.col("category_mean")
    if strength == 0:
        return F.coalesce(F.try_divide(F.col("product_total"), F.col("product_n")), base)
    return (total + base * strength) / (n + strength)


def predictions(scored: DataFrame, models: list[tuple], keep: list[str]) -> DataFrame:
    """One row per evaluation row and model; `models` is a fixed list of (labels, prediction)."""
    return scored.select(*keep, F.explode(F.array(*[
        F.struct(*[F.lit(x).alias(n) for n, x in labels.items()], p.cast("double").alias("prediction"))
        for labels, p in models])).alias("_m")).select(*keep, "_m.*")
