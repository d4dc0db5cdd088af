"""Column helpers. Every function returns a built-in expression, so plans stay in generated code."""
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import NA_TOKENS


def rounded(value: Column, digits: int = 4) -> Column:
    """Round with ties upwards; the small nudge keeps ties stable when a sum differs in its last bit."""
    scale = float(10 ** digits)
    return F.floor(value * scale + 0.500001) / scale


def pct(part: Column, whole: Column, digits: int = 4) -> Column:
    """Percentage, 0 when the denominator is 0."""
    return F.coalesce(rounded(F.try_divide(part * 100.0, whole), digits), F.lit(0.0))


def share(condition: Column, digits: int = 4) -> Column:
    """Percentage of all rows for which the condition holds; null counts as false."""
    return pct(count_if(condition), F.count(F.lit(1)), digits)


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def rows() -> Column:
    return F.count(F.lit(1))


def na_to_null(text: Column, tokens=NA_TOKENS) -> Column:
    return F.when(~text.isin(list(tokens)), text)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def normalize_key(value: Column) -> Column:
    return F.trim(value.cast("string"))


def label(code: Column, names: dict, default=None) -> Column:
    """Dictionary lookup as a literal map; unknown codes give the default."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), code)
    return found if default is None else F.coalesce(found, F.lit(default))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def abs_seconds(a: Column, b: Column) -> Column:
    return F.abs(seconds_between(a, b))


def all_present(*columns: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])


def any_missing(*columns: str) -> Column:
    return ~all_present(*columns)


def how_many_missing(*columns: str) -> Column:
    return reduce(add, [F.col(c).isNull().cast("int") for c in columns])


def adjusted_skewness(value: Column) -> Column:
    """Bias-adjusted sample skewness; null below three values."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))
