"""Hard negatives by best-first search in sort-tile-recursive R-trees.

All vectors are packed into R-trees of a bounded number of bytes: ranges of the coordinate that varies most are dealt to
tasks, where each tree is tiled by two further coordinates into leaves with their bounding boxes. For an anchor, the box of
a node gives an interval of inner products, coordinate by coordinate. Nodes are opened in the order of their upper bounds,
and those outside all of the anchor's score windows, or strictly below what a window already holds as its last, stay closed.

Anchors are the stated query set. They are taken in blocks of a bounded number, which go to every task; each task keeps the
best per anchor and window over its trees, and what the tasks found is merged by one small shuffle per block.
"""
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ready
from .jaccard import arrow_rows

EVERY, ROTATE, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between LEAST / MOST of the positive's score and that score.
LEAST, MOST = 80, 100
SCALE = 256
#: Bytes of the vectors of a tree, about; rows of a leaf; leaves of a node; anchors sent to all tasks at once.
TREE_BYTES, LEAF, FANOUT, BLOCK = 1 << 20, 64, 16, 8192
#: Rows of a range of the first coordinate, about: one task packs them.
RANGE_ROWS = 1 << 16
#: Anchors that a task works on together, and leaves opened for each before bounds are looked at again (then doubled).
TOGETHER, FIRST_WAVE = 1024, 8
NOTHING = -np.iinfo(np.int64).max
EXACT = 2.0 ** 53


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, one per vec_id, labels as the contract changes them."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col("label").cast("long")
    turned = F.when(F.col("vec_id") % ROTATE == 0, (label + 1) % LABELS).otherwise(label)
    rows = embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    first = F.min(F.struct(turned.alias("label"), F.col("embedding"))).alias("first")
    return rows.groupBy("vec_id").agg(first).select("vec_id", "first.label", "first.embedding")


def whole_numbers(vectors) -> np.ndarray:
    return np.floor(SCALE * np.array([np.asarray(v, np.float64) for v in vectors], np.float64))


def spread(rows: DataFrame) -> list[int]:
    """Coordinates of the most frequent vector length, those that vary most first."""
    def run(batches):
        sums = {}
        for b in batches:
            for size, group in b.groupby(b["embedding"].map(len))["embedding"]:
                x = whole_numbers(group)
                old = sums.get(size, (0, 0.0, 0.0))
                sums[size] = (old[0] + len(x), old[1] + x.sum(axis=0), old[2] + (x * x).sum(axis=0))
        out = [(int(s), n, list(np.atleast_1d(a)), list(np.atleast_1d(q))) for s, (n, a, q) in sums.items() if s]
        yield pd.DataFrame(out, columns=["size", "n", "total", "squares"])

    sums: dict[int, list] = {}
    for r in rows.select("embedding").mapInPandas(run, "size int, n long, total array<double>, squares array<double>").toLocalIterator():
        old = sums.setdefault(r["size"], [0, 0.0, 0.0])  # one row per task and length: bounded by the vectors' length
        sums[r["size"]] = [old[0] + r["n"], old[1] + np.array(r["total"]), old[2] + np.array(r["squares"])]
    if not sums:
        return [0]
    n, total, squares = max(sums.values(), key=lambda v: v[0])
    return [int(d) for d in np.argsort(-(squares / n - (total / n) ** 2), kind="stable")]


TREE = "dim int, kind string, ids binary, labels binary, vectors binary, ends binary, low binary, high binary"


def tiled(x: np.ndarray, dims: list[int]) -> np.ndarray:
    """The order of rows that puts them into leaves: slices of one coordinate, sorted by the next inside."""
    second, third = [d for d in dims if d < x.shape[1]][1:3] if x.shape[1] > 2 else (0, x.shape[1] - 1)
    leaves = -(-len(x) // LEAF)
    slice_rows = LEAF * int(np.ceil(np.sqrt(leaves)))
    order = np.argsort(x[:, second], kind="stable")
    return np.concatenate([s[np.argsort(x[s, third], kind="stable")] for s in np.split(order, range(slice_rows, len(x), slice_rows))])


def trees(rows: DataFrame) -> DataFrame:
    """One row of TREE per R-tree over rows (vec_id, label, embedding)."""
    dims, count = spread(rows), rows.count()

    def tree(part: pd.DataFrame) -> list:
        x = whole_numbers(part["embedding"])
        order = tiled(x, dims)
        x, starts = x[order], np.arange(0, len(x), LEAF)
        kind = "<i4" if not len(x) or np.abs(x).max(initial=0) < 2**31 else "<f8"
        low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
        ids, labels = (part[c].to_numpy(np.int64)[order] for c in ("vec_id", "label"))
        ends = np.append(starts[1:], len(x))
        return [x.shape[1], kind, ids.tobytes(), labels.tobytes(), x.astype(kind).tobytes(), ends.astype("<i4").tobytes(),
                low.astype(kind).tobytes(), high.astype(kind).tobytes()]

    def run(batches):
        held = None
        for b in batches:
            held = b if held is None else pd.concat([held, b], ignore_index=True)
            while len(held):
                sizes = held["embedding"].map(len).to_numpy()
                same = int((sizes != sizes[0]).argmax()) or len(sizes)
                most = max(LEAF, TREE_BYTES // (4 * max(1, int(sizes[0]))))
                if same == len(held) < most:
                    break
                yield pd.DataFrame([tree(held.iloc[:min(same, most)])], columns=NAMES)
                held = held.iloc[min(same, most):].reset_index(drop=True)
        if held is not None and len(held):
            yield pd.DataFrame([tree(held)], columns=NAMES)

    by = [F.size("embedding"), F.get("embedding", F.lit(dims[0])), F.col("vec_id")]
    ranges = rows.where(F.size("embedding") > 0).repartitionByRange(max(8, -(-count // RANGE_ROWS)), *by)
    return ranges.sortWithinPartitions(*by).mapInPandas(run, TREE)


NAMES = [c.split()[0] for c in TREE.split(", ")]


class Tree:
    def __init__(self, row):
        shape = lambda raw: np.frombuffer(raw, row["kind"]).reshape(-1, row["dim"]).astype(np.float64)
        self.dim, self.vectors, self.low, self.high = row["dim"], shape(row["vectors"]), shape(row["low"]), shape(row["high"])
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.ends = np.frombuffer(row["ends"], "<i4")
        self.starts = np.append(0, self.ends[:-1])
        nodes = np.arange(0, len(self.low), FANOUT)
        self.node_of = np.arange(len(self.low)) // FANOUT
        self.node_low, self.node_high = np.minimum.reduceat(self.low, nodes), np.maximum.reduceat(self.high, nodes)
        self.size = np.abs(self.vectors).max(initial=0)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with anything inside each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


class Search:
    """The best rows per anchor and score window over the trees seen so far.

    `low` and `high` are (anchors, windows); `same` asks for rows of the anchor's label, else for those of other labels.
    """

    def __init__(self, ids, labels, vectors, low, high, same: bool, keep: int):
        self.ids, self.labels, self.q, self.low, self.high, self.same = ids, labels, vectors, low, high, same
        self.score = np.full((*low.shape, keep), NOTHING)
        self.found = np.full((*low.shape, keep), np.iinfo(np.int64).max)
        self.size = np.abs(vectors).max(initial=0)

    def wanted(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which boxes may hold something for an anchor: bounds are (anchors, boxes)."""
        floor = np.maximum(self.low, self.score[:, :, -1])
        return ((most[:, :, None] >= floor[:, None, :]) & (least[:, :, None] <= self.high[:, None, :])).any(axis=2)

    def visit(self, tree: Tree) -> None:
        if tree.dim != self.q.shape[1]:
            return
        exact = self.size * tree.size * tree.dim < EXACT
        if exact:
            node = self.wanted(*bounds(self.q, tree.node_low, tree.node_high))
            if not node.any():
                return
            least, most = bounds(self.q, tree.low, tree.high)
            open_ = node[:, tree.node_of]
        else:  # such large numbers are multiplied as Python's, and nothing is left out
            open_ = np.ones((len(self.q), len(tree.low)), bool)
            least, most = np.full(open_.shape, -np.inf), np.full(open_.shape, np.inf)
        order, at, wave = np.argsort(-most, axis=1, kind="stable"), 0, FIRST_WAVE
        while at < order.shape[1]:
            now = np.zeros_like(open_)
            np.put_along_axis(now, order[:, at:at + wave], True, axis=1)
            self.open(tree, now & open_ & self.wanted(least, most), exact)
            at, wave = at + wave, 2 * wave

    def open(self, tree: Tree, todo: np.ndarray, exact: bool) -> None:
        found = []
        for leaf in np.flatnonzero(todo.any(axis=0)):
            who, rows = np.flatnonzero(todo[:, leaf]), slice(tree.starts[leaf], tree.ends[leaf])
            x, ids = tree.vectors[rows], tree.ids[rows]
            if exact:
                s = (self.q[who] @ x.T).astype(np.int64)
            else:
                big = lambda m: np.array([[int(v) for v in r] for r in m.tolist()], object).reshape(m.shape)
                s = (big(self.q[who]) @ big(x).T).astype(np.int64)
            fit = (tree.labels[rows][None, :] == self.labels[who][:, None]) == self.same
            fit &= ids[None, :] != self.ids[who][:, None]
            for w in range(self.low.shape[1]):
                last, last_id = self.score[who, w, -1][:, None], self.found[who, w, -1][:, None]
                ok = fit & (s >= self.low[who, w][:, None]) & (s <= self.high[who, w][:, None])
                ok &= (s > last) | ((s == last) & (ids[None, :] < last_id))
                i, j = np.nonzero(ok)
                if len(i):
                    found.append((who[i] * self.low.shape[1] + w, s[i, j], ids[j]))
        if found:
            self.merge(*(np.concatenate(c) for c in zip(*found)))

    def merge(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        keep, touched = self.score.shape[2], np.unique(key)
        a, w = touched // self.low.shape[1], touched % self.low.shape[1]
        key = np.concatenate([np.repeat(touched, keep), key])
        score = np.concatenate([self.score[a, w].ravel(), score])
        ids = np.concatenate([self.found[a, w].ravel(), ids])
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key, "left")
        top = rank < keep
        a, w = key[top] // self.low.shape[1], key[top] % self.low.shape[1]
        self.score[a, w, rank[top]], self.found[a, w, rank[top]] = score[top], ids[top]


HITS = "anchor_id long, window int, id long, score long"


def searched(packed: DataFrame, anchors: list[tuple], low, high, same: bool, keep: int) -> DataFrame:
    """The best `keep` rows per (anchor, window) over all trees, numbered from 1: HITS and rank.

    anchors are (ids, labels, vectors) of one vector length each; low and high have a row per anchor in that order.
    """
    starts = np.cumsum([0, *[len(a[0]) for a in anchors]])

    def run(batches):
        parts = [Search(ids[k:k + TOGETHER], labels[k:k + TOGETHER], x[k:k + TOGETHER], low[s + k:s + k + TOGETHER][:len(ids) - k],
                        high[s + k:s + k + TOGETHER][:len(ids) - k], same, keep)
                 for s, (ids, labels, x) in zip(starts, anchors) for k in range(0, len(ids), TOGETHER)]
        for b in batches:
            for row in b.to_dict("records"):
                tree = Tree(row)
                for p in parts:
                    p.visit(tree)
        for p in parts:
            a, w, k = np.nonzero(p.score > NOTHING)
            yield pd.DataFrame({"anchor_id": p.ids[a], "window": w, "id": p.found[a, w, k], "score": p.score[a, w, k]})

    best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    hits = packed.mapInPandas(run, HITS)
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(embeddings: DataFrame) -> DataFrame:
    """RESULT over all rows of embeddings (vec_id, embedding, label).

    Rows without an id take no part either; of rows that repeat an id the first by label and components stands. Vectors are
    compared with those of the same length; empty ones have no partners. Scores beyond 64 bits stop the run. Other columns
    are ignored; an empty table gives an empty result.
    """
    spark = ready(embeddings.sparkSession)
    rows = materialize(usable(embeddings), "vectors")
    packed = materialize(trees(rows), "trees")
    queries = rows.where(F.col("vec_id") % EVERY == 0)
    blocks = -(-queries.count() // BLOCK)
    turn = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks)))
    out = []
    for block in range(blocks):
        chosen = queries.where(turn == block).orderBy("vec_id").toPandas()  # about BLOCK rows
        chosen["size"] = chosen["embedding"].map(len)
        anchors = [(g["vec_id"].to_numpy(np.int64), g["label"].to_numpy(np.int64), whole_numbers(g["embedding"]))
                   for size, g in chosen.groupby("size") if size]
        if not anchors:
            continue
        ids = np.concatenate([a[0] for a in anchors])
        wide = np.ones((len(ids), 1), np.int64)
        with arrow_rows(spark, 16):
            positives = materialize(searched(packed, anchors, wide * (NOTHING + 1), wide * np.iinfo(np.int64).max, True, POSITIVES), "positives")
            low, high = np.ones((len(ids), POSITIVES), np.int64), np.zeros((len(ids), POSITIVES), np.int64)  # empty windows
            place = {i: k for k, i in enumerate(ids.tolist())}
            for r in positives.toLocalIterator():  # up to POSITIVES rows per anchor of the block
                if r["score"] >= 0:  # below zero the window is empty
                    low[place[r["anchor_id"]], r["rank"] - 1] = -(-LEAST * r["score"] // MOST)
                    high[place[r["anchor_id"]], r["rank"] - 1] = r["score"]
            found = searched(packed, anchors, low, high, False, NEGATIVES)
            out.append(materialize(positives.select(
                "anchor_id", F.col("id").alias("positive_id"), (F.col("rank") - 1).alias("window"), F.col("score").alias("positive_score")).join(
                found.select("anchor_id", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")),
                ["anchor_id", "window"]).select(*[c.split()[0] for c in RESULT.split(", ")]), "negatives"))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], RESULT)


def mine_sql() -> str:
    """The same by all inner products of anchors, for DuckDB."""
    return f"""
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % {ROTATE} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS a, r.vec_id AS r, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS s
  FROM rows a JOIN rows r ON a.vec_id % {EVERY} = 0 AND a.vec_id <> r.vec_id AND len(a.v) = len(r.v)),
positive AS (SELECT a, r, s FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, r) <= {POSITIVES})
SELECT p.a AS anchor_id, p.r AS positive_id, (row_number() OVER best)::INTEGER AS rank, n.r AS negative_id,
  p.s AS positive_score, n.s AS negative_score
FROM positive p JOIN scored n ON p.a = n.a AND NOT n.same AND {LEAST} * p.s <= {MOST} * n.s AND {MOST} * n.s <= {MOST} * p.s
WINDOW best AS (PARTITION BY p.a, p.r ORDER BY n.s DESC, n.r) QUALIFY row_number() OVER best <= {NEGATIVES}"""
