"""64-bit hashes of word shingles of whole texts, vectorised with numpy.

Letters A to Z are lower-cased and words are runs of anything but the six ASCII blanks.
The hash of a word is a polynomial over its bytes, taken from running sums over a stretch
of text; shingle hashes mix the hashes of their words in order.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

STRETCH = 1 << 18  # bytes hashed at once; a longer word is hashed by itself
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 2**64)
    up = np.full(STRETCH + 1, _BASE, dtype=np.uint64)
    down = np.full(STRETCH + 1, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hash of each word of a text, in order."""
    raw = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    if not len(raw):
        return np.zeros(0, dtype=np.uint64)
    edge = np.diff(np.concatenate(([1], _BLANK[raw].view(np.int8), [1])))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    out = np.empty(len(starts), dtype=np.uint64)
    up, down = _powers()
    at = 0
    while at < len(starts):
        origin = starts[at]
        stop = int(np.searchsorted(ends, origin + STRETCH, side="right"))
        if stop <= at:  # one word longer than a stretch
            digest = hashlib.blake2b(raw[origin : ends[at]].tobytes(), digest_size=8).digest()
            out[at] = np.frombuffer(digest, dtype=np.uint64)[0]
            at += 1
            continue
        part = raw[origin : ends[stop - 1]]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[part] * up[: len(part)], dtype=np.uint64, out=sums[1:])
        s, e = starts[at:stop] - origin, ends[at:stop] - origin
        out[at:stop] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = stop
    return out


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than ``width`` make one shingle."""
    words = word_hashes(text or "")
    width = min(width, len(words))
    if not width:
        return words
    n = len(words) - width + 1
    acc = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        acc = mixed(acc * np.uint64(_BASE) + words[j : j + n])
    return np.unique(acc)
