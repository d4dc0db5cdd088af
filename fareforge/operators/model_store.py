"""Fitted models written once, under a digest of the data and the parameters they come from.

The digest is a sum over row hashes, so it does not depend on the order or the partitioning of the rows. A model's record
is written after its parts: a folder without a record is unfinished and is never read.
"""
import hashlib
import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root
from .moments import LinearModel


def data_digest(frame: DataFrame) -> str:
    """A number of the rows and their values, the same for any order."""
    row = frame.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*sorted(frame.columns)).cast("decimal(38,0)")).alias("h")).first()
    return hashlib.sha256(f"{sorted(frame.dtypes)} {row['n']} {row['h']}".encode()).hexdigest()


class ModelStore:
    """Models below one shared folder: `<digest>/part-<group>` per group, and `<digest>/record` when all are there."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root or f"{scratch_root(spark)}/models"

    def key(self, frame: DataFrame, settings: dict) -> str:
        return hashlib.sha256((data_digest(frame) + json.dumps(settings, sort_keys=True, default=str)).encode()).hexdigest()[:32]

    def has(self, key: str) -> bool:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}/record/_SUCCESS")
        return where.getFileSystem(conf).exists(where)

    def save(self, key: str, models: dict, record: DataFrame) -> None:
        """Linear models are one JSON row each, pipelines keep their own format."""
        lines = []
        for g, m in models.items():
            if isinstance(m, LinearModel):
                lines.append((g, m.as_json()))
            else:
                m.write().overwrite().save(f"{self.root}/{key}/pipeline-{g}")
                lines.append((g, None))
        table = self.spark.createDataFrame(lines, "name string, model string").coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.root}/{key}/models")
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{key}/record")

    def load(self, key: str) -> tuple[dict, DataFrame]:
        """The models by group and their record."""
        found = self.spark.read.parquet(f"{self.root}/{key}/models").collect()  # one row per group
        models = {r["name"]: LinearModel.from_json(r["model"]) if r["model"] else PipelineModel.load(f"{self.root}/{key}/pipeline-{r['name']}")
                  for r in found}
        return models, self.spark.read.parquet(f"{self.root}/{key}/record")

    def get(self, frame: DataFrame, settings: dict, fit) -> tuple[dict, DataFrame, bool]:
        """(models, record, whether they were there): `fit()` gives the models and the record where they are not."""
        key = self.key(frame, settings)
        there = self.has(key)
        if not there:
            self.save(key, *fit())
        return (*self.load(key), there)
