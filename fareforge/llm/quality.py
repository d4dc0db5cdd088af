"""Quality scores by naive Bayes support vectors.

Indicators of hashed character n-grams, and of n-grams over the marks "same word as before", are scaled by the log ratio of their smoothed counts in the two classes; a linear
hinge-loss model over them is fitted by dual coordinate descent, with a stronger penalty for the rarer class, and its
margins become probabilities by a logistic fit on labelled rows that the margin model has not seen.
"""
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remainder
from .grams import gram_presence, pack, unpack

ORDERS, BITS = (1, 2, 3), 15
#: N-grams over repetition marks have a cell for each pattern of up to so many marks.
MARKS = 5
SIZE = (len(ORDERS) << BITS) + (2 << MARKS)
#: Added to the squared length of a row, so that texts of a few words stay near the bias.
DAMPING = 4.0
#: Labelled documents to learn from, at most: those with the smallest digest of their id.
SAMPLE = 6_000
FOLDS, HELD_OUT, ACCEPT = 5, 0, 0.3
SMOOTH, COST, ROUNDS, SEED = 1.0, 1.0, 12, 7


def indicators(text: str) -> np.ndarray:
    """Ascending indices of all n-grams of a whole text."""
    words = text.split()
    same = np.fromiter(map(str.__eq__, words, words[1:]), np.int64, max(len(words) - 1, 0))
    found, code = [gram_presence(text, ORDERS, BITS)], np.ones(len(same), np.int64)
    for n in range(1, MARKS + 1):
        if len(same) < n:
            break
        code = 2 * code[:len(same) - n + 1] + same[n - 1:]
        found.append(((len(ORDERS) << BITS) + np.unique(code)).astype(np.int32))
    return np.concatenate(found)


def length(values: np.ndarray) -> float:
    return float(np.sqrt(values @ values + DAMPING))


@dataclass
class Model:
    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, indices: np.ndarray) -> float:
        r = self.ratios[indices]
        return float(self.weights[indices] @ r) / length(r) + self.bias

    def score(self, text: str) -> float:
        m = self.slope * self.margin(indicators(text)) + self.shift
        return float(1 / (1 + np.exp(-np.clip(m, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    counts = np.full((2, size), SMOOTH)
    for idx, label in zip(rows, y):
        counts[label, idx] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Hinge loss with a constant feature: one dual variable per row, boxed by the cost of its class."""
    sign = np.where(y == 1, 1.0, -1.0)
    cost = COST * len(y) / (2 * np.maximum(np.bincount(y, minlength=2), 1))[y]
    values = [(v := ratios[i]) / length(v) for i in rows]
    w, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(y))
    order = np.random.default_rng(SEED)
    for _ in range(ROUNDS):
        for i in order.permutation(len(y)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + bias) - 1
            square = values[i] @ values[i] + 1
            step = np.clip(alpha[i] - gradient / square, 0, cost[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[rows[i]] += step * sign[i] * values[i]
                bias += step * sign[i]
    return w, bias


def logistic_fit(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(label 1 | margin), with targets kept off 0 and 1 by the class counts."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(y))], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        b += np.clip(np.linalg.solve(hessian, x.T @ (t - p)), -5, 5)
    return float(b[0]), float(b[1])


def learn(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    if len(labels) == 0 or labels.min() == labels.max():
        p = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(SIZE), np.zeros(SIZE), 0.0, 0.0, float(np.log((p + 1e-3) / (1 - p + 1e-3))))
    own = np.arange(len(labels)) % 5 != 0
    if len(set(labels[own])) < 2 or len(set(labels[~own])) < 2:
        own = np.ones(len(labels), bool)
    fit = [r for r, o in zip(rows, own) if o]
    ratios = log_count_ratios(fit, labels[own], SIZE)
    w, bias = dual_descent(fit, labels[own], ratios)
    margins = Model(w, ratios, bias, 1, 0)
    rest = own if own.all() else ~own
    slope, shift = logistic_fit(np.array([margins.margin(r) for r, o in zip(rows, rest) if o]), labels[rest])
    return Model(w, ratios, bias, slope, shift)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled rows outside the held-out fold.

    At most `sample` documents: the chosen ids are bounded, so they are broadcast to the scan of the texts. Labels that
    disagree on an id count as 0; labels without a document, null labels and null ids are passed over.
    """
    usable = labels.where((remainder(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = (usable.groupBy("doc_id").agg(F.min("quality").alias("label"))
              .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample))

    def indices(batches):
        for b in batches:
            packed = [pack(indicators(t or "")) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"], "x": packed})

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = sorted(texts.mapInPandas(indices, "doc_id long, label int, x binary").collect(), key=lambda r: (r.doc_id, r.x))
    return learn([unpack(r.x) for r in rows], np.array([r.label for r in rows], int))


def scorer(model: Model):
    """A column function from text to score; null and empty texts get that of a text without n-grams."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(model.score)

    def of(text: Column) -> Column:
        return score(text)
    return of


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs; rows that repeat an id are scored each, other columns
    are ignored, an empty table gives an empty result."""
    of = scorer(train(docs, labels))
    return docs.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                       of(F.col("text")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier does not reject, with all their columns."""
    of = scorer(train(docs, labels))
    return docs.where(of(docs["text"]) >= ACCEPT)
