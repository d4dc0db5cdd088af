"""Hashed presence of character n-grams."""
import numpy as np


def gram_presence(text: str, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Ascending indices of the n-grams of a whole text; each order has 2**bits cells of its own."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    mark = np.zeros(len(orders) << bits, bool)
    with np.errstate(over="ignore"):
        for k, n in enumerate(orders):
            size = len(points) - n + 1
            if size < 1:
                continue
            h = points[:size].copy()
            for j in range(1, n):
                h *= np.uint32(0x9E3779B1)
                h += points[j:j + size]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
            h *= np.uint32(0xC2B2AE35)
            mark[(h >> np.uint32(32 - bits)).astype(np.int64) + (k << bits)] = True
    return np.flatnonzero(mark).astype(np.int32)


def pack(indices: np.ndarray) -> bytes:
    return indices.astype("<i4").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<i4")
