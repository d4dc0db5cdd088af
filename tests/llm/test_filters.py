"""Filters of the n-gram join: none rejects a link, and each rejects what it is for."""
import numpy as np
import pytest

from fareforge.llm import jaccard


def similar(rng, n, kept):
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    return base, np.unique(np.concatenate([base[:kept], rng.integers(0, 2**63, n - kept, dtype=np.uint64)]))


def near(x, y):
    words = min(len(jaccard.bitmap(x)), len(jaccard.bitmap(y))) // 8
    differing = np.bitwise_count(jaccard.folded(jaccard.bitmap(x), words) ^ jaccard.folded(jaccard.bitmap(y), words)).sum()
    return bool(jaccard.close(int(differing), len(x) + len(y)))


@pytest.mark.parametrize("n", [1, 2, 7, 40, 300, 5000])
def test_links_pass_all_filters(n):
    rng = np.random.default_rng(n)
    for _ in range(60):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop = rng.integers(0, n // 4 + 1)
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 2**63, rng.integers(0, n // 3 + 2), dtype=np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 75 * (len(x) + len(y) - both):
            assert near(x, y) and jaccard.share_in_all_orders(jaccard.orders(x), jaccard.orders(y))


def test_orders_reject_unrelated_sets_of_any_size():
    rng = np.random.default_rng(0)
    for n in (20, 300, 2000):
        passed = sum(jaccard.share_in_all_orders(jaccard.orders(x), jaccard.orders(y))
                     for x, y in ((rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(200)))
        assert passed <= 2


def test_orders_reject_most_pairs_that_share_one_prefix_shingle():
    """Candidates of the first order share a shingle by chance; the further orders put it elsewhere."""
    rng = np.random.default_rng(1)
    passed = 0
    for _ in range(300):
        x, y = (rng.integers(0, 2**63, 300, dtype=np.uint64) for _ in range(2))
        y[0] = x[0]
        passed += jaccard.share_in_all_orders(jaccard.orders(x), jaccard.orders(y))
    assert passed <= 30


def test_bitmaps_reject_half_alike_sets():
    rng = np.random.default_rng(2)
    assert sum(near(*similar(rng, 400, 260)) for _ in range(100)) <= 5


@pytest.mark.parametrize("settings", [{}, {"SMALL": 2, "BLOCK": 8, "ROUNDS": 1}, {"SMALL": 2, "BLOCK": 5, "PART": 7, "ROUNDS": 0}])
def test_components_of_crowded_groups(spark, monkeypatch, settings):
    """Chains of edits, half-alike texts with a common passage, and copies, against all pairs."""
    for name, value in settings.items():
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(3)
    common = [f"c{i}" for i in range(30)]
    texts = []
    for group in range(4):
        words = common + [f"g{group}w{i}" for i in range(60)]
        for _ in range(25):
            words = list(words)
            for k in rng.integers(0, len(words), 2):
                words[k] = f"e{rng.integers(0, 10**9)}"
            texts.append(" ".join(words))
    texts += texts[:7] + [" ".join(common + [f"x{i}y{k}" for k in range(12)]) for i in range(40)]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: find(i) for i in range(len(texts))}
