"""Regression trees over sparse vectors: boosted trees and random forests whose cost follows what is set, not the width.

A number is cut at up to `maxBins` values as Spark's trees cut it; a label is a slot of its own and is split off against all
others, as a one-hot column is. Per level only labels that occur in a node are looked at, so a vocabulary of any size costs
one entry per row. Rows are packed once (a byte per number and four per label column) and read by the tasks that grow trees:
trees of a forest are grown apart from each other, rounds of boosting follow each other in one task per fit. Trees are written
to the shared folder and read by the tasks that score; the driver holds neither rows nor trees.
"""
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import summary
from ..session import materialize, scratch_path
from . import sparse

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a packed block, and trees of a forest that one task grows.
BLOCK = 65_536
CHUNK = 4
#: Bytes of a model's trees that a scoring task keeps between batches.
KEPT = 64 << 20
#: Cells of the histograms of one level; levels of more nodes are sorted instead.
CELLS = 1 << 20
NODES = ("feature", "cut", "left", "value")
TYPES = {"feature": np.int32, "cut": np.float64, "left": np.int32, "value": np.float64}
TREES = "tree int, weight double, " + ", ".join(f"{c} binary" for c in NODES)
PACKED = "part int, at int, y binary, bins binary, labels binary"


# ---- rows of a fit, packed ----------------------------------------------------------------------

def cuts_of(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Midpoints between neighbours: all of them up to `most` bins, else those at even ranks."""
    middles = (values[1:] + values[:-1]) / 2
    if len(values) <= most:
        return middles
    upto = np.cumsum(counts)
    wanted = np.searchsorted(upto, upto[-1] * np.arange(1, most) / most)
    return middles[np.unique(np.minimum(wanted, len(middles) - 1))]


def find_cuts(rows: DataFrame, numbers: int, sizes: list[int], most: int) -> list[np.ndarray]:
    """Cuts per number from one pass: each task sends a summary of its values, exact where there are few different ones."""
    def run(batches):
        found = [(np.empty(0), np.empty(0))] * numbers
        for b in batches:
            x, _ = sparse.unpack(b.column("v"), numbers, sizes)
            found = [summary(np.concatenate([v, x[i]]), np.concatenate([n, np.ones(x.shape[1])])) for i, (v, n) in enumerate(found)]
        if numbers and len(found[0][0]):
            yield pa.RecordBatch.from_arrays([pa.array(range(numbers), pa.int32()), *[pa.array([f[k].tobytes() for f in found], pa.binary()) for k in (0, 1)]],
                                             names=["number", "points", "counts"])
    parts = [(np.empty(0), np.empty(0))] * numbers
    for r in sorted(rows.select("v").mapInArrow(run, "number int, points binary, counts binary").toLocalIterator(), key=lambda r: (r[0], r[1])):
        v, n = parts[r[0]]
        parts[r[0]] = np.concatenate([v, np.frombuffer(r[1])]), np.concatenate([n, np.frombuffer(r[2])])
    return [cuts_of(*summary(v, n, max(1, len(v))), most) for v, n in parts]


def pack(rows: DataFrame, cuts: list[np.ndarray], sizes: list[int]) -> DataFrame:
    """Blocks of rows: target, bin of every number, slot of every label column."""
    numbers = len(cuts)

    def run(batches):
        from pyspark import TaskContext
        part, at, held, n = TaskContext.get().partitionId(), 0, [], 0

        def block():
            y, bins, labels = (np.concatenate(x, axis=-1) for x in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at], pa.int32()),
                                               *[pa.array([x.tobytes()], pa.binary()) for x in (y, bins, labels)]], names=["part", "at", "y", "bins", "labels"])
        for b in batches:
            y = b.column("y").to_numpy(zero_copy_only=False).astype(float)
            if np.isnan(y).any():
                raise ValueError("a training row has no target")
            x, labels = sparse.unpack(b.column("v"), numbers, sizes)
            bins = np.array([np.searchsorted(c, v) for c, v in zip(cuts, x)], np.uint8).reshape(numbers, len(y))
            held.append((y, bins, labels))
            n += len(y)
            if n >= BLOCK:
                yield block()
                at, held, n = at + 1, [], 0
        if n:
            yield block()
    return rows.select("y", "v").mapInArrow(run, PACKED)


def unpacked(blocks: list[dict], numbers: int, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(target, bins, labels) of all blocks in the order they were packed in."""
    blocks = sorted(blocks, key=lambda b: (b["part"], b["at"]))
    y = [np.frombuffer(b["y"]) for b in blocks]
    bins = [np.frombuffer(b["bins"], np.uint8).reshape(numbers, len(v)) for b, v in zip(blocks, y)]
    labels = [np.frombuffer(b["labels"], np.int32).reshape(columns, len(v)) for b, v in zip(blocks, y)]
    return np.concatenate(y), np.concatenate(bins, axis=1), np.concatenate(labels, axis=1)


# ---- one tree -----------------------------------------------------------------------------------

def cells(key: np.ndarray, w: np.ndarray, wy: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys that occur, in order; their weights; their sums)"""
    if most <= 2 * len(key):
        n, s = np.bincount(key, w, most), np.bincount(key, wy, most)
        at = np.flatnonzero(n)
        return at, n[at], s[at]
    bits = len(key).bit_length()
    if most.bit_length() + bits < 63:  # sorting numbers is faster than sorting places
        both = np.sort((key << bits) | np.arange(len(key)))
        key, order = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    return key[first], np.add.reduceat(w[order], first), np.add.reduceat(wy[order], first)


def histograms(node, rows, w, wy, bins, starts, nodes: int) -> np.ndarray:
    """Weights and sums per node and bin of all numbers, in blocks of rows."""
    width = int(starts[-1])
    out = np.zeros((2, nodes * width))
    for k in range(0, len(rows), BLOCK):
        here = slice(k, k + BLOCK)
        key = (node[here] * width + starts[:-1, None] + bins[:, rows[here]]).ravel()
        for i, v in enumerate((w[here], wy[here])):
            out[i] += np.bincount(key, np.tile(v, len(bins)), nodes * width)
    return out.reshape(2, nodes, width)


class Best:
    """The best split so far of every open node, by the reduction of the sum of squares."""

    def __init__(self, n: np.ndarray, s: np.ndarray, least: int):
        self.n, self.s, self.least, self.base = n, s, least, s * s / n
        self.gain, self.feature, self.at = np.zeros(len(n)), np.full(len(n), -1, np.int64), np.zeros(len(n), np.int64)

    def offer(self, node, n, s, feature, at, allowed=None) -> None:
        """Candidates in the order of nodes; n and s are the weight and the sum of one side."""
        rest, total = self.n[node] - n, self.s[node] - s
        good = (n >= self.least) & (rest >= self.least)
        if allowed is not None:
            good &= allowed
        node, n, s, rest, total, feature, at = (x[good] if isinstance(x, np.ndarray) else x for x in (node, n, s, rest, total, feature, at))
        if not len(node):
            return
        gain = s * s / n + total * total / rest - self.base[node]
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        top = np.maximum.reduceat(gain, first)
        run = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(node)]))
        hit = np.flatnonzero(gain == top[run])
        hit = hit[np.r_[True, run[hit][1:] != run[hit][:-1]]]  # the first of equal ones
        hit = hit[gain[hit] > self.gain[node[hit]]]
        at_node = node[hit]
        self.gain[at_node] = gain[hit]
        self.feature[at_node] = feature[hit] if isinstance(feature, np.ndarray) else feature
        self.at[at_node] = at[hit]


def drawn(rng, nodes: int, numbers: int, width: int, share: float):
    """Per node `ceil(share * width)` slots without enumerating them: (which numbers, how many label slots)."""
    count = max(1, int(np.ceil(share * width)))
    some = rng.hypergeometric(numbers, width - numbers, count, nodes) if 0 < numbers < width else np.full(nodes, count if numbers else 0)
    rank = np.argsort(np.argsort(rng.random((nodes, numbers)), axis=1), axis=1) if numbers else np.empty((nodes, 0))
    return rank < some[:, None], count - some


def drawn_labels(rng, node: np.ndarray, slots: int, count: np.ndarray) -> np.ndarray:
    """Which of the label slots that occur (in the order of nodes) are among the `count` drawn of all `slots` in their node."""
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    present = np.diff(np.r_[first, len(node)])
    some = rng.hypergeometric(present, slots - present, count[node[first]])
    order = np.lexsort((rng.random(len(node)), node))
    rank = np.empty(len(node), np.int64)
    rank[order] = np.arange(len(node)) - np.repeat(first, present)
    return rank < np.repeat(some, present)


def grow(y, w, bins, labels, cuts, sizes, depth, least=1, min_gain=0.0, share=1.0, rng=None) -> dict[str, np.ndarray]:
    """One tree, level by level: rows of weight 0 are out of the bag. A leaf has feature -1; right is left + 1.

    A number goes left up to its cut, a label goes right where its slot is set.
    """
    numbers, slots = len(cuts), int(sum(sizes))
    centre = np.average(y, weights=w)
    rows = np.flatnonzero(w)
    w, y = w[rows].astype(float), y[rows] - centre
    wy = w * y
    spread = float((wy * y).sum())
    node, ids = np.zeros(len(rows), np.int64), np.zeros(1, np.int64)
    out = {c: [] for c in NODES}
    made, above = 1, None
    starts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in cuts])]).astype(np.int64)
    width = int(starts[-1])
    of, at_bin = np.repeat(np.arange(numbers), np.diff(starts)), np.arange(width) - np.repeat(starts[:-1], np.diff(starts))
    for level in range(depth + 1):
        n, s, q = (np.bincount(node, v, len(ids)) for v in (w, wy, wy * y))
        level_out = {"feature": np.full(len(ids), -1, np.int32), "cut": np.zeros(len(ids)), "left": np.full(len(ids), -1, np.int32), "value": s / n + centre}
        for c in NODES:
            out[c].append(level_out[c])
        mixed = (q - s * s / n > 1e-12 * spread) & (n >= 2 * least)
        if level == depth or not mixed.any():
            break
        opened = np.flatnonzero(mixed)
        dense = 0 < len(opened) * width <= min(CELLS, 4 * len(rows) * numbers)
        if dense and above is not None:  # the smaller child of a node is counted, the other one is the rest
            pair = np.flatnonzero(mixed.reshape(-1, 2).any(axis=1))
            sizes_of = np.bincount(node, minlength=len(ids)).reshape(-1, 2)
            small = 2 * np.arange(len(sizes_of)) + (sizes_of[:, 1] < sizes_of[:, 0])
            wanted = np.full(len(ids), -1, np.int64)
            wanted[small[pair]] = np.arange(len(pair))
            here = wanted[node] >= 0
            part = histograms(wanted[node[here]], rows[here], w[here], wy[here], bins, starts, len(pair))
            both = np.empty((2, len(ids), width))
            both[:, small[pair]], both[:, small[pair] ^ 1] = part, above[:, pair] - part
            above = both[:, opened]
        place = np.cumsum(mixed) - 1
        kept = mixed[node]
        if not kept.all():
            rows, w, y, wy, node = rows[kept], w[kept], y[kept], wy[kept], node[kept]
        node = place[node]
        if not dense:
            above = None
        elif above is None:
            above = histograms(node, rows, w, wy, bins, starts, len(opened))
        best = Best(n[opened], s[opened], least)
        which, of_labels = drawn(rng, len(opened), numbers, numbers + slots, share) if share < 1 else (None, None)
        if dense:
            first = np.repeat(starts[:-1], np.diff(starts))
            c_n, c_s = (np.cumsum(h, axis=1) for h in above)
            c_n, c_s = (c - (c - h)[:, first] for c, h in zip((c_n, c_s), above))
            best.offer(np.repeat(np.arange(len(opened)), width), c_n.ravel(), c_s.ravel(), np.tile(of, len(opened)), np.tile(at_bin, len(opened)),
                       None if which is None else which[:, of].ravel())
        for f in range(0 if dense else numbers):
            size = len(cuts[f]) + 1
            if size == 1:
                continue
            key, c_n, c_s = cells(node * size + bins[f, rows], w, wy, len(opened) * size)
            owner = key // size
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            length = np.diff(np.r_[first, len(owner)])
            c_n, c_s = (np.cumsum(c) - np.repeat((np.cumsum(c) - c)[first], length) for c in (c_n, c_s))
            best.offer(owner, c_n, c_s, f, key % size, None if which is None else which[owner, f])
        if slots:
            found = [cells((node * slots + at - numbers)[at >= numbers], w[at >= numbers], wy[at >= numbers], len(opened) * slots)
                     for at in (column[rows] for column in labels)]
            key, c_n, c_s = (np.concatenate(x) for x in zip(*found))
            if len(found) > 1:
                order = np.argsort(key, kind="stable")
                key, c_n, c_s = key[order], c_n[order], c_s[order]
            if len(key):
                owner = key // slots
                allowed = None if which is None else drawn_labels(rng, owner, slots, of_labels)
                best.offer(owner, c_n, c_s, numbers + key % slots, np.zeros(len(key), np.int64), allowed)
        split = (best.feature >= 0) & (best.gain > 1e-12 * spread) & (best.gain / best.n >= min_gain)
        if not split.any():
            break
        chosen = opened[split]
        feature, at = best.feature[split], best.at[split]
        level_out["feature"][chosen] = feature
        level_out["cut"][chosen] = [cuts[f][a] if f < numbers else 0.5 for f, a in zip(feature.tolist(), at.tolist())]
        level_out["left"][chosen] = made + 2 * np.arange(len(chosen))
        above = None if above is None else above[:, split]
        place = np.cumsum(split) - 1
        kept = split[node]
        rows, w, y, wy, node = rows[kept], w[kept], y[kept], wy[kept], place[node[kept]]
        goes, f = np.empty(len(rows), bool), feature[node]
        number = f < numbers
        goes[number] = bins[f[number], rows[number]] > at[node[number]]
        goes[~number] = (labels[:, rows[~number]] == f[~number]).any(axis=0)
        node = 2 * node + goes
        ids = np.arange(made, made + 2 * len(chosen))
        made += 2 * len(chosen)
    return {c: np.concatenate(out[c]).astype(TYPES[c]) for c in NODES}


def values_at(tree: dict, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The tree's value for every row of numbers and labels."""
    at = np.zeros(x.shape[1], np.int64)
    rows = np.arange(len(at))
    while len(rows):
        node = at[rows]
        f = tree["feature"][node]
        inner = f >= 0
        rows, node, f = rows[inner], node[inner], f[inner]
        number = f < len(x)
        goes = np.empty(len(rows), bool)
        goes[number] = x[f[number], rows[number]] > tree["cut"][node[number]]
        goes[~number] = (labels[:, rows[~number]] == f[~number]).any(axis=0)
        at[rows] = tree["left"][node] + goes
    return tree["value"][at]


# ---- estimators ---------------------------------------------------------------------------------

def _trees(train: DataFrame, est, tasks: int, fit) -> str:
    """Folder of the trees that `fit(task, y, bins, labels, cuts, sizes)` yields as (tree, weight, arrays)."""
    spark, column = train.sparkSession, est.getFeaturesCol()
    numbers, sizes = sparse.layout(train, column)
    rows = train.select(F.col(est.getLabelCol()).cast("double").alias("y"), F.unwrap_udt(column).alias("v"))
    cuts = find_cuts(rows, numbers, sizes, est.getMaxBins())
    packed = materialize(pack(rows, cuts, sizes), "packed")

    def run(batches):
        blocks = {}
        for b in batches:
            for r in b.to_pylist():
                blocks.setdefault(r["task"], []).append(r)
        for task in sorted(blocks):
            data = unpacked(blocks.pop(task), numbers, len(sizes))
            for tree, weight, arrays in fit(task, *data, cuts, sizes):
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([weight]), *[pa.array([arrays[c].tobytes()], pa.binary()) for c in NODES]],
                                                 names=["tree", "weight", *NODES])
    # every task reads all blocks from storage; nothing is shuffled or sent to the driver
    asked = spark.range(0, tasks, 1, tasks).select(F.col("id").cast("int").alias("task"))
    together = asked.crossJoin(packed.coalesce(1).hint("shuffle_replicate_nl"))
    path = scratch_path(spark, "trees")
    together.mapInArrow(run, TREES).write.parquet(path)
    return path


def _model(est, train: DataFrame, path: str, mean: bool) -> "TreesModel":
    numbers, sizes = sparse.layout(train, est.getFeaturesCol())
    if not train.sparkSession.read.schema(TREES).parquet(path).select("tree").head(1):
        raise ValueError("no training rows")
    return TreesModel()._set(featuresCol=est.getFeaturesCol(), predictionCol=est.getPredictionCol(), path=path, numbers=numbers, sizes=sizes, mean=mean)


def _share(text: str, width: int, otherwise: float) -> float:
    """The share of all slots that a node looks at."""
    named = {"all": 1.0, "auto": otherwise, "onethird": 1 / 3, "sqrt": width ** -0.5, "log2": max(1.0, np.log2(width)) / width}
    if text in named:
        return named[text]
    return min(1.0, int(text) / width) if text.isdigit() else float(text)


class SparseForest(RandomForestRegressor):
    """Bootstrapped trees on all cores; the prediction is their mean."""

    def _fit(self, dataset: DataFrame) -> "TreesModel":
        trees, depth, least, gain = self.getNumTrees(), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain()
        rate, seed, strategy = self.getSubsamplingRate(), self.getSeed(), self.getFeatureSubsetStrategy()

        def fit(task, y, bins, labels, cuts, sizes):
            width = len(cuts) + sum(sizes)
            for t in range(task * CHUNK, min(trees, (task + 1) * CHUNK)):
                rng = np.random.default_rng([seed & (2**63 - 1), t])
                bag = np.bincount(rng.integers(0, len(y), max(1, round(rate * len(y)))), minlength=len(y))
                yield t, 1.0, grow(y, bag, bins, labels, cuts, sizes, depth, least, gain, _share(strategy, width, 1 / 3), rng)
        return _model(self, dataset, _trees(dataset, self, -(-trees // CHUNK), fit), True)


class SparseBoosting(GBTRegressor):
    """Trees on twice the residuals, as Spark boosts squared errors: the first counts in full, the others by the step size."""

    def _fit(self, dataset: DataFrame) -> "TreesModel":
        if self.getLossType() != "squared":
            raise ValueError("squared errors only")
        rounds, depth, least, gain = self.getMaxIter(), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain()
        rate, seed, strategy, step = self.getSubsamplingRate(), self.getSeed(), self.getFeatureSubsetStrategy(), self.getStepSize()

        def fit(task, y, bins, labels, cuts, sizes):
            rng, width = np.random.default_rng(seed & (2**63 - 1)), len(cuts) + sum(sizes)
            known, coded = np.zeros(len(y)), [np.arange(len(c) + 1) for c in cuts]
            for t in range(rounds):
                w = (rng.random(len(y)) < rate).astype(float) if rate < 1 else np.ones(len(y))
                w = w if w.any() else np.ones(len(y))
                tree = grow(y if t == 0 else 2 * (y - known), w, bins, labels, cuts, sizes, depth, least, gain, _share(strategy, width, 1.0), rng)
                weight = 1.0 if t == 0 else step
                known += weight * values_at(_binned(tree, cuts, coded), bins, labels)
                yield t, weight, tree
        return _model(self, dataset, _trees(dataset, self, 1, fit), False)


def _binned(tree: dict, cuts: list[np.ndarray], coded: list[np.ndarray]) -> dict:
    """The same tree on bins."""
    at = [int(coded[f][np.searchsorted(cuts[f], c)]) if 0 <= f < len(cuts) else 0 for f, c in zip(tree["feature"].tolist(), tree["cut"].tolist())]
    return {**tree, "cut": np.array(at)}


class TreesModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """Trees in a folder of the shared store, read by the tasks that score."""
    path = Param(Params._dummy(), "path", "folder of the trees", TypeConverters.toString)
    numbers = Param(Params._dummy(), "numbers", "slots that are numbers", TypeConverters.toInt)
    sizes = Param(Params._dummy(), "sizes", "slots per label column", TypeConverters.toListInt)
    mean = Param(Params._dummy(), "mean", "whether trees are averaged or added", TypeConverters.toBoolean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        path, numbers, sizes, mean = (self.getOrDefault(p) for p in (self.path, self.numbers, self.sizes, self.mean))

        def run(batches):
            kept = None
            for vectors in batches:
                x, labels = sparse.unpack(vectors, numbers, sizes)
                total, count, now, held = np.zeros(len(vectors)), 0, [], 0
                for weight, tree in kept or stored_trees(path):
                    total += weight * values_at(tree, x, labels)
                    count += 1
                    if kept is None and held <= KEPT:
                        now.append((weight, tree))
                        held += sum(v.nbytes for v in tree.values())
                kept = kept or (now if held <= KEPT else None)
                yield pa.array(total / count if mean else total)
        from collections.abc import Iterator
        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return dataset.withColumn(self.getPredictionCol(), F.arrow_udf(run, "double")(F.unwrap_udt(self.getFeaturesCol())))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


def stored_trees(uri: str):
    """(weight, arrays) of the trees in their order within each file."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq
    fs, root = pafs.FileSystem.from_uri(uri)
    for info in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda f: f.path):
        if not info.path.endswith(".parquet"):
            continue
        with fs.open_input_file(info.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(1):
                for r in batch.to_pylist():
                    yield r["weight"], {c: np.frombuffer(r[c], TYPES[c]) for c in NODES}


class _Writer(MLWriter):
    def __init__(self, model: TreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.sparkSession.read.schema(TREES).parquet(self.model.getOrDefault(self.model.path)).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._set(path=f"{path}/trees")
