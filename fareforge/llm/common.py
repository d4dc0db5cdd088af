"""Helpers shared by the corpus operators."""
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..session import materialize, release, tune  # noqa: F401

#: Fixed value: what separates words in the text contracts, as a Java regular expression.
BLANKS = r"[\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the corpus operators: small Arrow batches keep very long texts from filling a worker."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a computed value inside one expression, so that later steps read it instead of computing it again."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """White-space words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def remainder(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text; null ids count as 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds, F.lit(0))


def last_layer() -> str:
    """The folder that `materialize` has written last."""
    return next(reversed(session._WRITTEN))


def only_result_stays(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """Write what `build` returns and delete all layers that were written on the way."""
    before = set(session._WRITTEN)
    out = materialize(build(), label)
    stays = last_layer()
    release(spark, *[p for p in list(session._WRITTEN) if p not in before and p != stays])
    return out
