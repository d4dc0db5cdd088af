"""Packing documents into windows of a fixed number of tokens by non-negative least squares over length combinations.

Documents longer than a window give whole windows; what remains of each has a length below the window, and only the
histogram of those lengths reaches the driver. Combinations of up to three lengths that fill a window are repeated as
often as non-negative least squares against the histogram says, rounded down; what is left is packed greedily, and a piece
is cut only where no whole one fits the gap. The plan is a table of rank intervals per length whose size follows the
window, not the corpus; each document finds its places by the rank it has among those of its length.
"""
import zlib
from collections import defaultdict, deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .wordwise import ByteEncoder

WINDOW, END_ID = 1024, 0
#: Rows of a group in which ranks are counted, about; and the least number of such groups.
GROUP_ROWS, LEAST_GROUPS = 100_000, 256
#: Steps of the active-set solver at most; each brings in one combination.
SOLVER_STEPS = 4096


# ---- the plan -----------------------------------------------------------------------------------

class ActiveSet:
    """Active columns with the inverse of their Gram matrix, which is kept up to date as columns come and go."""

    def __init__(self, window: int, target: np.ndarray):
        self.all, self.inverse = np.zeros((window, window), order="F"), np.zeros((window, window))
        self.target, self.right, self.x, self.names = target, np.zeros(0), np.zeros(0), []

    def columns(self) -> np.ndarray:
        return self.all[:, :len(self.names)]

    def enter(self, name: int, column: np.ndarray) -> bool:
        """Add a column; False if it is a sum of active ones."""
        n = len(self.names)
        u = self.inverse[:n, :n] @ (self.columns().T @ column)
        gap = column @ column - (self.columns() @ u) @ column
        if n == len(self.all) or gap < 1e-9:
            return False
        self.inverse[:n, :n] += np.outer(u, u / gap)
        self.inverse[:n, n] = self.inverse[n, :n] = -u / gap
        self.inverse[n, n] = 1 / gap
        self.all[:, n] = column
        self.names.append(name)
        self.right, self.x = np.append(self.right, column @ self.target), np.append(self.x, 0.0)
        return True

    def leave(self, k: int) -> int:
        n = len(self.names)
        stay = np.delete(np.arange(n), k)
        side = self.inverse[stay, k]
        self.inverse[:n - 1, :n - 1] = self.inverse[np.ix_(stay, stay)] - np.outer(side, side / self.inverse[k, k])
        self.all[:, :n - 1] = self.all[:, stay]
        self.right, self.x = self.right[stay], self.x[stay]
        return self.names.pop(k)

    def settle(self) -> list[int]:
        """Move to the least squares of the active columns; those that would turn negative leave and are returned."""
        left = []
        while True:
            n = len(self.names)
            wish = self.inverse[:n, :n] @ self.right
            low = np.flatnonzero(wish <= 1e-9)
            if not len(low):
                self.x = wish
                return left
            steps = self.x[low] / np.maximum(self.x[low] - wish[low], 1e-30)
            self.x = self.x + min(steps.min(), 1.0) * (wish - self.x)
            left.append(self.leave(int(low[steps.argmin()])))


def least_squares(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], float]]:
    """Non-negative repeat counts of combinations of two or three lengths with the sum `window` that come closest to the
    histogram (count per length, index 0 unused), as (lengths, count).

    An active-set solver: the combination with the steepest gradient enters, and the unconstrained solution on the active
    ones is approached until one of them would turn negative, which leaves. Gradients of all combinations are sums of two
    or three residuals, so the matrix of combinations is never built.
    """
    target = histogram.astype(float)
    there = target > 0
    first = np.arange(1, window)[there[1:]]
    first = first[2 * first <= window]
    i, j = np.meshgrid(first, np.arange(1, window)[there[1:]], indexing="ij")
    k = window - i - j
    ok = (i <= j) & (j <= k) & there[np.clip(k, 0, window - 1)]
    three = np.stack([i[ok], j[ok], k[ok]], 1)
    two = np.stack([first, window - first], 1)[there[window - first]]
    combos = np.concatenate([np.concatenate([two, np.full((len(two), 1), -1)], 1), three]) if len(two) or len(three) else np.zeros((0, 3), int)
    active = ActiveSet(window, target)
    residual, floor = np.append(target, 0.0), max(0.5, 1e-6 * target.max(initial=0))  # index -1 reads the zero at the end
    closed = np.zeros(len(combos), bool)
    for _ in range(SOLVER_STEPS if len(combos) else 0):
        gradient = residual[combos[:, 0]] + residual[combos[:, 1]] + residual[combos[:, 2]]
        gradient[closed] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= floor:
            break
        closed[best] = True
        lengths = combos[best]
        if active.enter(best, np.bincount(lengths[lengths >= 0], minlength=window).astype(float)):
            for left in active.settle():
                closed[left] = left == best  # one that has left may come back, but not at once
            residual[:window] = target - active.columns() @ active.x
    names, x = active.names, active.x
    order = np.argsort(-x, kind="stable")
    return [(tuple(int(v) for v in combos[names[o]] if v >= 0), float(x[o])) for o in order]


class Pool:
    """Pieces by length: runs of ranks of documents, each with where in their remainder the piece starts."""

    def __init__(self, histogram: np.ndarray):
        self.runs, self.count = defaultdict(deque), histogram.astype(np.int64).copy()
        for length in np.flatnonzero(histogram):
            self.runs[int(length)].append((int(length), 0, 0, int(histogram[length])))

    def take(self, length: int, n: int):
        """(rest, start, low, high) of n pieces of a length."""
        self.count[length] -= n
        while n:
            rest, start, low, high = self.runs[length].popleft()
            used = min(n, high - low)
            yield rest, start, low, low + used
            if low + used < high:
                self.runs[length].appendleft((rest, start, low + used, high))
            n -= used

    def give(self, length: int, run: tuple[int, int, int, int]) -> None:
        self.runs[length].append(run)
        self.count[length] += run[3] - run[2]

    def largest(self, most: int, tried: dict[int, int] = {}) -> int:
        """The largest length up to `most` of which there are more than tried; 0 if there is none."""
        found = np.flatnonzero(self.count[1:most + 1])
        return next((int(v) + 1 for v in found[::-1] if self.count[v + 1] > tried.get(int(v) + 1, 0)), 0)


PLAN = "rest int, start int, length int, low long, high long, sequence long, at int"


def plan(histogram: np.ndarray, window: int = WINDOW) -> tuple[list[tuple], int]:
    """Rows of PLAN for a histogram of remainders (index: length), and the number of sequences.

    A row says: of documents with that remainder, those of rank low to high - 1 put `length` ids from `start` on (counted
    inside the remainder) at place `at` of sequence + rank - low.
    """
    pool, out, made = Pool(histogram), [], 0

    def place(lengths: list[tuple[int, int]], repeats: int) -> None:
        """`repeats` windows of pieces, given as (length of the pool, length used)."""
        nonlocal made
        at = 0
        for length, used in lengths:
            done = 0
            for rest, start, low, high in list(pool.take(length, repeats)):
                out.append((rest, start, used, low, high, made + done, at))
                done += high - low
                if used < length:
                    pool.give(length - used, (rest, start + used, low, high))
            at += used
        made += repeats

    for lengths, wish in least_squares(histogram, window):
        most = min(pool.count[v] // lengths.count(v) for v in lengths)
        if (repeats := int(min(np.floor(wish + 1e-6), most))) > 0:
            place([(v, v) for v in lengths], repeats)
    while (longest := pool.largest(window)):
        lengths, gap, tried = [(longest, longest)], window - longest, {longest: 1}
        while gap:
            free = lambda most: pool.largest(most, tried)
            fits = free(gap) or free(window)  # a whole piece, else the largest one is cut
            if not fits:
                break
            lengths.append((fits, min(fits, gap)))
            tried[fits] = tried.get(fits, 0) + 1
            gap -= min(fits, gap)
        place(lengths, int(min(pool.count[v] // n for v, n in tried.items())))
    return out, made


# ---- documents ----------------------------------------------------------------------------------

def encoded(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, n, ids): the ids of every row of docs, end id included. `row` is unique once the table is written."""
    def run(batches):
        from pyspark import TaskContext
        encoder, row = ByteEncoder.shared(tokenizer_path), TaskContext.get().partitionId() << 40
        end = np.array([end_id], encoder.kind).tobytes()
        for b in batches:
            ids = [x + end for x in encoder.ids(b["text"].fillna("").tolist())]
            yield pd.DataFrame({"row": np.arange(row, row + len(b)), "doc_id": b["doc_id"].astype("Int64"),
                                "n": [len(x) // encoder.kind.itemsize for x in ids], "ids": ids})
            row += len(b)

    return docs.select("doc_id", "text").mapInPandas(run, "row long, doc_id long, n long, ids binary")


def before_in_group(rows: DataFrame, keys: list[str], amount, name: str, groups: int) -> DataFrame:
    """rows with the sum of `amount` over the rows before each one, per key; a key is dealt over many groups by row."""
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    own = Window.partitionBy(*keys, "_group").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*keys, "_group").agg(F.sum(amount).alias("_sum"))
    below = Window.partitionBy(*keys).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_group", F.coalesce(F.sum("_sum").over(below), F.lit(0)).alias("_below"))
    inside = dealt.withColumn("_inside", F.coalesce(F.sum(amount).over(own), F.lit(0)))
    joined = inside.join(starts, [*keys, "_group"])
    return joined.withColumn(name, F.col("_below") + F.col("_inside")).drop("_group", "_inside", "_below")


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of docs (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and the piece's ids
    (little-endian unsigned 32-bit).

    Every id of a document, end id included, lies in one piece; a null or empty text is its end id alone. Every sequence but
    one is full. Rows that repeat an id and rows without one are documents of their own; other columns are ignored; an empty
    table gives no pieces.
    """
    spark = docs.sparkSession
    texts = materialize(encoded(docs, tokenizer_path, end_id), "packing-ids")
    sizes = texts.select("row", F.expr(f"n div {window}").alias("full"), F.expr(f"cast(n % {window} as int)").alias("rest"))
    histogram = np.zeros(window, np.int64)
    counted = sizes.groupBy("rest").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full")).collect()  # one row per length
    for r in counted:
        histogram[r["rest"]] = r["n"]
    groups = max(LEAST_GROUPS, int(histogram.sum()) // GROUP_ROWS)
    histogram[0] = 0
    rows, sequences = plan(histogram, window)
    planned = F.broadcast(spark.createDataFrame(rows, PLAN))  # bounded by the window, whatever the corpus
    ranked = before_in_group(sizes.where("rest > 0"), ["rest"], F.lit(1), "rank", groups)
    cuts = ranked.join(planned, "rest").where("rank >= low and rank < high").select(
        "row", F.col("start").cast("long").alias("start"), "length", (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence"), "at",
        F.lit(1).cast("long").alias("full"))
    whole = before_in_group(sizes.where("full > 0").withColumn("_one", F.lit(0)), ["_one"], F.col("full"), "before", groups)
    fulls = whole.select("row", F.lit(-1).cast("long").alias("start"), F.lit(window).alias("length"),
                         (F.lit(sequences) + F.col("before")).alias("sequence"), F.lit(0).alias("at"), "full")
    places = materialize(cuts.unionByName(fulls).groupBy("row").agg(F.collect_list(
        F.struct("start", "length", "sequence", "at", "full")).alias("places")), "packing-places")
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def split(batches):
        kind = ByteEncoder.shared(tokenizer_path).kind
        for b in batches:
            out, held = [], 0
            for doc_id, n, raw, places_ in zip(b["doc_id"], b["n"], b["ids"], b["places"]):
                ids = np.frombuffer(raw, kind).astype("<u4")
                own = None if pd.isna(doc_id) else int(doc_id)
                base = n - n % window
                for p in places_:
                    for k in range(p["full"]):
                        start = k * window if p["start"] < 0 else base + p["start"]
                        piece = ids[start:start + p["length"]].tobytes()
                        row = [own, start, p["length"], zlib.crc32(piece), n, p["sequence"] + k, p["at"]]
                        out.append(row + [piece] if with_ids else row)
                        held += len(piece) if with_ids else 64
                        if held > 1 << 24:
                            yield frame(out)
                            out, held = [], 0
            yield frame(out)

    def frame(rows_):
        names = [f.split()[0] for f in fields.split(", ")] + ["ids"] * with_ids
        return pd.DataFrame(rows_, columns=names).astype({"doc_id": "Int64"})

    # both tables are read from storage, so the join shuffles each text's ids once and nothing is computed twice
    return texts.join(places, "row").select("doc_id", "n", "ids", "places").mapInPandas(split, fields + ", ids binary" * with_ids)
