"""Hard negatives against all inner products."""
import math

import numpy as np
import pandas as pd
import pytest

from fareforge.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score long, anchor_id string, size int"


def brute(rows):
    seen = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        lab = (lab + 1) % 10 if i % 7 == 0 else lab
        key = (lab, list(v))
        if i not in seen or key < seen[i][0]:
            seen[i] = (key, lab, [math.floor(256 * x) for x in v])
    out = set()
    for a, (_, lab, v) in seen.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (_, other, w) in seen.items() if i != a and len(w) == len(v) > 0)
        for p, i, other in [s for s in scored if s[2] == lab][:5]:
            fit = [(n, j) for n, j, o in scored if o != lab and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out |= {(a, i, k + 1, j, -p, -n) for k, (n, j) in enumerate(fit)}
    return out


def frame(spark, rows):
    full = [(i, None if v is None else [None if x is None else float(x) for x in v], lab, 5, "clash", 3) for i, v, lab in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def mined(df):
    return [tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]


@pytest.mark.parametrize("leaf,first", [(64, 8), (3, 1)])
def test_clusters_ties_and_hot_vector(spark, monkeypatch, leaf, first):
    for name, value in (("LEAF", leaf), ("FIRST_WAVE", first), ("TREE_BYTES", 4000), ("TOGETHER", 3), ("RANGE_ROWS", 300), ("BLOCK", 4)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 8))
    rows = [(i, np.float32(centers[i % 6] + rng.normal(size=8) * 0.3).tolist(), int(rng.integers(0, 10))) for i in range(1200)]
    rows = [(i, [0.5] * 8 if i % 3 == 0 else v, lab) for i, v, lab in rows]
    got = mined(negatives.mine(frame(spark, rows)))
    assert len(got) == len(set(got)) and set(got) == brute(rows) and got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 2, 3], 1), (100, [1, 2, 2], 1), (100, [9, 9, 9], 2), (None, [1, 1, 1], 1), (2, [nan, 1, 1], 1), (3, [1, inf, 1], 2), (4, None, 1),
            (5, [1, None, 1], 2), (6, [1, 1, 1], None), (7, [1, 2, 3], 9), (8, [1, 2, 2.5], 3), (9, [1, 2], 1), (10, [], 1), (200, [1, 2], 1),
            (11, [1, 1.9], 2), (12, [1, 2, 3], 2), (13, [-1, -2, -3], 1), (300, [-1, -2, -3], 4), (400, [0, 0, 0], 5), (15, [0, 0, 0], 5), (16, [0, 0, 0], 6)]
    got = mined(negatives.mine(frame(spark, rows)))
    assert sorted(got) == sorted(brute(rows)) and {r[0] for r in got} >= {0, 200, 400}
    assert mined(negatives.mine(frame(spark, []))) == [] and mined(negatives.mine(frame(spark, [(1, [1.0], 1)]))) == []


def test_numbers_beyond_doubles(spark):
    rows = [(i, [2.0**20 + i, 2.0**19, -2.0**20 - 3 * i], i % 3) for i in (0, 1, 2, 3, 4, 5, 100, 101, 106)]
    got = mined(negatives.mine(frame(spark, rows)))
    assert set(got) == brute([(i, np.float32(v).tolist(), lab) for i, v, lab in rows]) and got


def test_boxes_are_closed(spark):
    """Far clusters stay closed: their boxes lie below what the near ones hold."""
    near, far = np.eye(4)[0] * 4, -np.eye(4)[0] * 4
    x = np.concatenate([near + np.linspace(0, 1, 640)[:, None] * 0.1, far + np.linspace(0, 1, 640)[:, None] * 0.1])
    dims = [0, 1, 2, 3]
    order = negatives.tiled(np.floor(256 * x), dims)
    v = np.floor(256 * x)[order]
    starts = np.arange(0, len(v), negatives.LEAF)
    row = pd.Series({"dim": 4, "kind": "<i4", "ids": order.astype(np.int64).tobytes(), "labels": np.zeros(len(v), np.int64).tobytes(),
                     "vectors": v.astype("<i4").tobytes(), "ends": np.append(starts[1:], len(v)).astype("<i4").tobytes(),
                     "low": np.minimum.reduceat(v, starts).astype("<i4").tobytes(), "high": np.maximum.reduceat(v, starts).astype("<i4").tobytes()})
    tree = negatives.Tree(row)
    search = negatives.Search(np.array([-1]), np.array([0]), np.floor(256 * near)[None, :], np.array([[negatives.NOTHING + 1]]),
                              np.array([[2**62]]), True, 5)
    opened = []
    inner = search.open
    search.open = lambda t, todo, exact: (opened.append(todo.sum()), inner(t, todo, exact))
    search.visit(tree)
    assert 0 < sum(opened) <= len(starts) // 2 + negatives.FIRST_WAVE
    assert search.score[0, 0].tolist() == sorted((np.floor(256 * near) @ np.floor(256 * x).T).astype(int))[::-1][:5]


def test_table_has_links(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert set(mined(negatives.mine(df))) == brute(rows)
