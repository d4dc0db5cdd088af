"""Contracts. A check returns its violations as rows; `require` turns any violation into an error."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.running import repeated_keys

SAMPLE = 5


def broken(message: str, *details) -> Column:
    """A value that fails the run when it is read: the contract is part of the plan and costs no job of its own."""
    parts = [F.lit(message), *[F.coalesce(F.col(d).cast("string"), F.lit("null")) for d in details]]
    return F.raise_error(F.concat_ws(" ", *parts))


class ContractError(ValueError):
    pass


def require(violations: DataFrame, message: str) -> None:
    sample = violations.limit(SAMPLE).collect()
    if sample:
        raise ContractError(f"{message}: {[row.asDict() for row in sample]}")


def unique_key_violations(df: DataFrame, keys: list[str], sample: int = SAMPLE) -> DataFrame:
    return repeated_keys(df, keys).orderBy(*keys).limit(sample)


def domain_violations(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Distinct non-null values outside the allowed set."""
    return df.select(column).where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))).distinct()


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    lost = missing_columns(df, required)
    if lost:
        raise ContractError(f"missing columns: {', '.join(lost)}")
    return df
