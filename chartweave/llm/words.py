"""Words and word shingles: maximal runs of letters and digits after lower-casing, hashed in numpy."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _S)
    x = x * _M1
    x = x ^ (x >> _S)
    x = x * _M2
    return x ^ (x >> _S)


class Hasher:
    """64-bit hashes of words; a worker remembers at most ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        self.seen, self.limit = {}, limit

    def words(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in a row, and where each text's words end."""
        if len(self.seen) > self.limit:
            self.seen.clear()
        seen = self.seen
        for w in set(chain.from_iterable(split)).difference(seen):
            seen[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        ends = np.cumsum([len(w) for w in split], dtype=np.int64) if split else np.zeros(0, np.int64)
        n = int(ends[-1]) if len(ends) else 0
        return np.fromiter(map(seen.__getitem__, chain.from_iterable(split)), np.uint64, n), ends


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (those that cross an end are the caller's to drop)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:m].copy()
    for k in range(1, n):
        out = mix(out) + hashes[k : k + m]
    return mix(out)
