"""Delimited sources."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scalar import na_to_null, normalize_key


def header_columns(spark: SparkSession, path: str, sep: str = ";") -> list[str]:
    """Column names only; no data is parsed."""
    return spark.read.csv(path, sep=sep, header=True).columns


def drop_pii(df: DataFrame, columns=fixed.PII_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def read_delimited(spark: SparkSession, path: str, types: dict[str, str], renames: dict | None = None,
                   key_columns=("ProductID",), sep: str = ";", multi_line: bool = False) -> DataFrame:
    """Typed scan: missing-value tokens become null, unreadable values become null, personal columns are
    never selected, text keys are trimmed. Columns not named in `types` stay text.

    Files are split by line; `multi_line` allows line breaks inside quotes at the price of one task per file.
    """
    raw = spark.read.csv(path, sep=sep, header=True, encoding="UTF-8", quote='"', escape='"',
                         multiLine=multi_line)
    selected = []
    for name in raw.columns:
        if name in fixed.PII_COLUMNS:
            continue
        value = na_to_null(F.col(name))
        if name in key_columns:
            value = normalize_key(value)
        wanted = types.get(name, "string")
        if wanted == "bigint":
            # whole numbers may be written as 3.0
            value = F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
        elif wanted != "string":
            value = value.try_cast(wanted)
        selected.append(value.alias(name))
    return raw.select(*selected).withColumnsRenamed(renames or {})


def read_estimates(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, fixed.ESTIMATE_TYPES)


def read_rides(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, fixed.RIDE_TYPES, fixed.RIDE_RENAMES)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, fixed.PRODUCT_TYPES, fixed.PRODUCT_RENAMES)


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, fixed.ADDRESS_TYPES)
