"""Language identification with a blended-spectrum string kernel.

Two texts are as alike as the n-grams that both hold, per order over the geometric mean of what each holds. Kernel rows
against landmark texts give Nyström features; one ridge regression per language is solved on them. The landmarks, their
whitening and the solution multiply out to one matrix from n-grams to languages, so a batch is scored by one product.
"""
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder
from .grams import gram_presence, pack, unpack

ORDERS, BITS = (1, 2, 3), 13
#: Texts per language to learn from, as expected from the draw, and most landmarks among them.
SAMPLE, LANDMARKS = 400, 256
FOLDS, HELD_OUT = 3, 1
RIDGE, SHARPNESS, BATCH = 1e-2, 6.0, 64
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_REST = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None


def spectrum(text: str) -> np.ndarray:
    return gram_presence(_REST.sub(" ", text.lower()), ORDERS, BITS)


def kernel_rows(found: list[np.ndarray]) -> np.ndarray:
    """Dense presence rows whose products are kernel values: each order has length 1 / sqrt(number of orders)."""
    x = np.zeros((len(found), len(ORDERS) << BITS), np.float32)
    for row, idx in zip(x, found):
        edges = np.searchsorted(idx, np.arange(len(ORDERS) + 1) << BITS)
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi > lo:
                row[idx[lo:hi]] = 1 / np.sqrt((hi - lo) * len(ORDERS))
    return x


@dataclass
class Model:
    languages: list[str]
    map: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for start in range(0, len(texts), BATCH):
            part = texts[start:start + BATCH]
            known = [has_letter(t) and bool(self.languages) for t in part]
            z = SHARPNESS * (kernel_rows([spectrum(t) for t in part]) @ self.map)
            p = np.exp(z - z.max(axis=1, keepdims=True)) if self.languages else np.zeros((len(part), 1))
            best, top = p.argmax(axis=1), p.max(axis=1) / np.maximum(p.sum(axis=1), 1e-9)
            names += [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            scores += [float(t) if k else 0.0 for t, k in zip(top, known)]
        return names, scores


def learn(found: list[np.ndarray], languages: list[str]) -> Model:
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((len(ORDERS) << BITS, 1), np.float32))
    x = kernel_rows(found)
    at = np.unique(np.linspace(0, len(found) - 1, min(LANDMARKS, len(found))).astype(int))
    marks = x[at]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    phi = (x @ marks.T).astype(np.float64) @ whiten
    y = np.where(np.array(languages)[:, None] == np.array(names)[None], 1.0, -1.0)
    weights = np.linalg.solve(phi.T @ phi + RIDGE * len(found) * np.eye(phi.shape[1]) / phi.shape[1], phi.T @ y)
    return Model(names, (marks.T.astype(np.float64) @ (whiten @ weights)).astype(np.float32))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows with a language outside the held-out fold: of each language a draw by
    digest of the id that is expected to hold `sample` rows. Texts without letters teach nothing."""
    usable = docs.select("doc_id", "text", "lang").where(
        (remainder(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = usable.groupBy("lang").agg((F.lit(float(sample)) / F.count(F.lit(1))).alias("share"))
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / 2.0**32
    texts = usable.join(F.broadcast(share), "lang").where(draw < F.col("share"))  # one row per language

    def spectra(batches):
        for b in batches:
            b = b[b["text"].map(has_letter)]
            yield pd.DataFrame({"lang": b["lang"], "x": [pack(spectrum(t)) for t in b["text"]]})

    rows = sorted(texts.mapInPandas(spectra, "lang string, x binary").collect(), key=lambda r: (r.x, r.lang))
    return learn([unpack(r.x) for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs (doc_id, text, lang).

    Texts without a letter, null and empty ones included, are `und` with score 0; so is every text where nothing could
    be learned. Rows that repeat an id are scored each; other columns are ignored; an empty table gives an empty result.
    """
    model = train(docs)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.predict(texts.fillna("").tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    scored = docs.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                         predict(F.col("text")).alias("p"))
    return scored.select("doc_id", "held_out", "p.lang_pred", "p.score")
