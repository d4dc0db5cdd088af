"""Lookup joins and layers that later steps share."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def settle(df: DataFrame, label: str) -> DataFrame:
    """Compute a derived table once, as a written layer."""
    return materialize(df, label)


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join a lookup table. Adaptive execution broadcasts a side by its measured bytes and splits hot keys otherwise.

    With `null_safe`, null keys match each other.
    """
    if not null_safe:
        return fact.join(dim, on, how)
    keys = [on] if isinstance(on, str) else list(on)
    renamed = dim.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return fact.join(renamed, match, how).drop(*[f"_key_{k}" for k in keys])
