"""Word shingles of whole texts as 64-bit numbers, computed for a batch of texts at once."""
import numpy as np

from .token_store import mixed

WORDS = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_WEIGHTS = [np.uint64(w) for w in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text where its words begin (one more entry than texts)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    inside = ~_BLANK[data]
    turn = np.flatnonzero(np.diff(np.concatenate([[False], inside])))
    starts, ends = turn[::2], turn[1::2]
    edges = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    first = np.searchsorted(starts, edges)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    lengths = ends - starts
    begins = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(begins, lengths)
    factors = mixed(np.arange(lengths.max(), dtype=np.uint64), 11) | np.uint64(1)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * factors[place], begins)
        return mixed(sums + lengths.astype(np.uint64), 12), first


def shingle_sets(texts: list[str], size: int = WORDS) -> list[np.ndarray]:
    """Per text its distinct shingles, ascending. Texts of fewer words have one shingle, texts without words none."""
    words, first = word_hashes(texts)
    with np.errstate(over="ignore"):
        count = max(len(words) - size + 1, 0)
        rolled = np.zeros(count, np.uint64)
        for k in range(size):
            rolled += words[k:k + count] * _WEIGHTS[k % len(_WEIGHTS)]
        rolled = mixed(rolled, 13)
        out = []
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            if hi - lo >= size:
                out.append(np.unique(rolled[lo:hi - size + 1]))
            elif hi > lo:
                short = np.uint64(hi - lo)
                for k in range(lo, hi):
                    short = short * _WEIGHTS[0] + words[k]
                out.append(mixed(np.array([short], np.uint64), 14))
            else:
                out.append(np.zeros(0, np.uint64))
        return out
