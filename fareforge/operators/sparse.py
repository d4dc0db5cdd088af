"""Sparse feature vectors of numbers and one-hot labels. The labels of a column stay a table on storage: rows are joined to
their slots, so neither the driver nor a schema holds one entry per label.
"""
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bounded import lookup_join
from ..functions.scalar import rows
from ..session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lower bits of a row's running number within its task.
PLACE_BITS = 33
LABELS = "label string, place long"


class _Columns(HasInputCols, HasOutputCol):
    """Number columns, then one block of slots per label column."""
    labelCols = Param(Params._dummy(), "labelCols", "label columns, one-hot after the numbers", TypeConverters.toListString)

    def getLabelCols(self) -> list[str]:
        return self.getOrDefault(self.labelCols)


class SparseAssembler(Estimator, _Columns):
    """Slots by falling frequency, ties by label. A label that was not seen in training has no slot."""

    @keyword_only
    def __init__(self, *, inputCols, labelCols, outputCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._set(outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> "SparseAssemblerModel":
        found = [ordered_labels(dataset, c) for c in self.getLabelCols()]
        return SparseAssemblerModel()._set(inputCols=self.getInputCols(), labelCols=self.getLabelCols(), outputCol=self.getOutputCol(),
                                           tables=[t for t, _ in found], starts=[s for _, s in found])


def ordered_labels(dataset: DataFrame, column: str) -> tuple[str, list[int]]:
    """(folder of the labels in order, running count of labels before each sorted range and after the last)."""
    counts = dataset.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(rows().alias("n"))
    path = scratch_path(dataset.sparkSession, "labels")
    counts.orderBy(F.desc("n"), "label").select("label", F.monotonically_increasing_id().alias("place")).write.parquet(path)
    table = dataset.sparkSession.read.schema(LABELS).parquet(path)
    ranges = table.groupBy(F.shiftright("place", PLACE_BITS).alias("range")).agg(rows().alias("n")).collect()  # one row per task
    sizes = {r["range"]: r["n"] for r in ranges}
    starts = [0]
    for k in range(max(sizes, default=-1) + 1):
        starts.append(starts[-1] + sizes.get(k, 0))
    return path, starts


class SparseAssemblerModel(Model, _Columns, MLWritable, MLReadable):
    tables = Param(Params._dummy(), "tables", "folder of the labels of each label column", TypeConverters.toListString)
    starts = Param(Params._dummy(), "starts", "labels before each sorted range, per label column", TypeConverters.toList)

    def sizes(self) -> list[int]:
        return [s[-1] for s in self.getOrDefault(self.starts)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, out, numbers = dataset.sparkSession, dataset, self.getInputCols()
        labels = list(zip(self.getLabelCols(), self.getOrDefault(self.tables), self.getOrDefault(self.starts)))
        for c, path, starts in labels:
            table = spark.read.schema(LABELS).parquet(path)
            before = F.array(*[F.lit(int(s)) for s in starts])[F.shiftright("place", PLACE_BITS).cast("int")]
            slot = (before + F.col("place").bitwiseAND(2**PLACE_BITS - 1)).cast("int")
            out = lookup_join(out, table.select(F.col("label").alias(c), slot.alias(f"_slot_{c}")), c)
        sizes = self.sizes()
        slots = F.array(*[F.col(f"_slot_{c}") for c, *_ in labels]).cast("array<int>")
        vector = assembled(len(numbers), sizes)(F.array(*[F.col(c).cast("double") for c in numbers]).cast("array<double>"), slots)
        about = {"ml_attr": {"num_attrs": len(numbers) + sum(sizes)}, "numbers": len(numbers), "labels": sizes}
        return out.select(*dataset.columns, vector.alias(self.getOutputCol(), metadata=about))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: SparseAssemblerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for i, table in enumerate(self.model.getOrDefault(self.model.tables)):
            self.sparkSession.read.parquet(table).write.parquet(f"{path}/labels-{i}")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        tables = model.getOrDefault(model.tables)
        return model._set(tables=[f"{path}/labels-{i}" for i in range(len(tables))])


def assembled(numbers: int, sizes: list[int]):
    """(numbers, slots) -> sparse vector without zeros; a missing number fails the run, a missing slot is left out."""
    offsets = numbers + np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    width = int(offsets[-1])

    def run(values: pa.Array, slots: pa.Array) -> pa.Array:
        n = len(values)
        x = values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, numbers)
        if np.isnan(x).any():
            raise ValueError("missing number in a feature vector")
        at = slots.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(sizes))
        index = np.hstack([np.broadcast_to(np.arange(numbers, dtype=float), (n, numbers)), at + offsets[:-1]])
        value = np.hstack([x, np.where(np.isnan(at), 0.0, 1.0)])
        kept = value != 0
        ends = pa.array(np.concatenate([[0], np.cumsum(kept.sum(axis=1))]).astype(np.int32))
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, width, np.int32)),
             pa.ListArray.from_arrays(ends, pa.array(index[kept].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(value[kept]))],
            names=["type", "size", "indices", "values"])

    # types by their names: the function goes to the tasks by value
    run.__annotations__ = {"values": pa.Array, "slots": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, VectorUDT())


def unpack(vectors: pa.StructArray, numbers: int, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers by column, slot per label column or -1) of sparse and dense vectors."""
    kind, _, indices, values = vectors.flatten()
    n, lengths = len(vectors), values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(n), lengths)
    slot = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    thin = (kind.to_numpy(zero_copy_only=False) == 0)[row]
    slot[thin] = indices.flatten().to_numpy(zero_copy_only=False)
    value = values.flatten().to_numpy(zero_copy_only=False)
    x = np.zeros((numbers, n))
    here = slot < numbers
    x[slot[here], row[here]] = value[here]
    held = np.full((len(sizes), n), -1, np.int32)
    start = numbers
    for i, size in enumerate(sizes):
        here = (slot >= start) & (slot < start + size) & (value != 0)
        held[i, row[here]] = slot[here]
        start += size
    return x, held


def layout(prepared: DataFrame, column: str = "features") -> tuple[int, list[int]]:
    """(numbers, sizes of the label blocks) of a vector column; vectors of other makers are numbers only."""
    about = prepared.schema[column].metadata
    if "numbers" in about:
        return about["numbers"], list(about["labels"])
    width = about.get("ml_attr", {}).get("num_attrs")
    return (width if width is not None else prepared.select(F.unwrap_udt(column)["size"]).first()[0]), []
