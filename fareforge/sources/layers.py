"""Layers on storage: partitioned Parquet, sorted exports, metric tables and reports."""
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import ContractError, broken, missing_columns


def write_layer(df: DataFrame, path: str, partition: str = "CategoryID", observed: dict[str, Column] | None = None) -> dict:
    """Partitioned write. The rebalance hint lets a category of any size spread over many tasks and files.

    Returns the rows written (`rows`) and further aggregates by name, all collected by the tasks that write: the source is
    evaluated once, and a task that is repeated counts once.
    """
    seen = Observation()
    spread = df.hint("rebalance", partition).observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (observed or {}).items()])
    spread.write.mode("overwrite").partitionBy(partition).option("compression", "snappy").parquet(path)
    return seen.get


def read_layer(spark: SparkSession, path: str, columns: list[str] | None = None,
               categories: list | None = None, partition: str = "CategoryID") -> DataFrame:
    """Projection and category filter both reach the scan."""
    df = spark.read.parquet(path)
    if categories is not None:
        df = df.where(F.col(partition).isin(list(categories)))
    return df.select(*columns) if columns else df


def partition_row_counts(df: DataFrame, partition: str = "CategoryID") -> DataFrame:
    return df.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"))


def reconcile(expected: int, written: DataFrame) -> DataFrame:
    """One row: rows expected, rows on storage, and whether they agree."""
    found = written.agg(F.count(F.lit(1)).alias("written_rows"))
    return found.select(F.lit(expected).cast("bigint").alias("source_rows"), "written_rows",
                        (F.col("written_rows") == expected).alias("reconciled"))


def write_reconciled(df: DataFrame, path: str, partition: str = "CategoryID", observed: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
    """Write a layer and fail when the rows on storage differ from those the writing tasks saw; the layer and what was observed."""
    counts = write_layer(df, path, partition, observed)
    layer = df.sparkSession.read.parquet(path)
    found = layer.count()
    if found != counts["rows"]:
        raise ContractError(f"{counts['rows']} rows processed, {found} on storage in {path}")
    return layer, counts


def export_contracts(df: DataFrame, categories: list, own_price: dict, partition: str = "CategoryID", time: str = "Create",
                     target: str = "Price") -> DataFrame:
    """The rows of the categories, failing while they are written at a null time, a null target or a product's own price."""
    lost = missing_columns(df, [partition, time, target])
    if lost:
        raise ContractError(f"missing columns: {', '.join(lost)}")
    rows = df.where(F.col(partition).isin(list(categories)))
    checked = {c: F.coalesce(F.col(c), broken(f"null {c} in the export of", partition).cast(df.schema[c].dataType)) for c in (time, target)}
    for category, column in own_price.items():
        if column in df.columns:
            left = (F.col(partition) == category) & F.col(column).isNotNull()
            checked[column] = F.when(~left, F.col(column)).otherwise(
                F.when(left, broken("own price left in the export of", partition).cast(df.schema[column].dataType)))
    return rows.withColumns(checked)


def export_final(df: DataFrame, path: str, categories: list, order: list[str], own_price: dict | None = None, partition: str = "CategoryID",
                 time: str = "Create", target: str = "Price") -> dict:
    """Sorted export of all categories by one job: ranges of (category, order) are sorted and written below their category.

    Files of a category follow each other in order. Contracts of `export_contracts` fail the run, and so does a category
    without rows. Returns rows, earliest and latest time and positive targets per category, observed by the writing tasks.
    """
    seen, position = Observation(), {c: i for i, c in enumerate(categories)}
    here = lambda c: F.col(partition) == c
    counts = [e for c, i in position.items() for e in (
        F.count_if(here(c)).alias(f"rows_{i}"), F.count_if(here(c) & (F.col(target) > 0)).alias(f"positive_{i}"),
        F.min(F.when(here(c), F.col(time))).alias(f"first_{i}"), F.max(F.when(here(c), F.col(time))).alias(f"last_{i}"))]
    checked = export_contracts(df, categories, own_price or {}, partition, time, target)
    ranged = checked.repartitionByRange(partition, *order).sortWithinPartitions(partition, *order)
    ranged.observe(seen, *counts).write.mode("overwrite").partitionBy(partition).option("compression", "snappy").parquet(path)
    found = seen.get
    empty = [c for c, i in position.items() if not found[f"rows_{i}"]]
    if empty:
        raise ContractError(f"no rows to export for {empty}")
    return {c: {k: found[f"{k}_{i}"] for k in ("rows", "positive", "first", "last")} for c, i in position.items()}


def export_category(df: DataFrame, path: str, category, order: list[str],
                    partition: str = "CategoryID") -> str:
    """Globally sorted Snappy export of one category, in a folder of its own."""
    target = f"{path}/{partition}={category}"
    (df.where(F.col(partition) == category).orderBy(*order).write.mode("overwrite")
       .option("compression", "snappy").parquet(target))
    return target


def write_metrics_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(path, header=True)
    return path


def read_metrics_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def write_report_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path
