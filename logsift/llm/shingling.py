"""Hashed words and shingles of many texts at once, with numpy.

Words are runs of bytes other than space and U+0009 to U+000D of the text with A-Z lower-cased. A shingle is ``k`` words in
a row; a text of fewer words has all of them as one shingle. Both are 64-bit hashes: two different shingles of a corpus
with a billion distinct ones fall together with a chance of about 0.03 in all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes that are hashed at once; longer texts are hashed alone.
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_ODD to the powers 0 to n, and to their negatives, modulo 2**64."""
    up, down = np.full(n + 1, _ODD, dtype=np.uint64), np.full(n + 1, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each text."""
    buf = np.frombuffer(b"\n".join([b"", *texts, b""]), dtype=np.uint8)
    space = _SPACE[buf]
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    up, down = _powers(1 << max(20, int(len(buf)).bit_length()))
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=total[1:])
    h = mixed((total[end] - total[start]) * down[start])
    bounds = np.cumsum([1, *(len(t) + 1 for t in texts)])
    at = np.searchsorted(start, bounds)
    return h, np.diff(at)


def _chunks(texts: Iterable[str | None]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass").translate(_LOWER)
        if part and size + len(b) > CHUNK:
            yield part
            part, size = [], 0
        part.append(b)
        size += len(b) + 1
    if part:
        yield part


def shingle_sets(texts: Iterable[str | None], k: int = 5) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text its sorted distinct shingles (uint64) and a 128-bit digest of its word sequence."""
    for part in _chunks(texts):
        h, counts = word_hashes(part)
        n = len(h)
        g = np.zeros(max(0, n - k + 1), dtype=np.uint64)
        for j in range(k):
            g += h[j : n - k + 1 + j] * np.uint64((_ODD * (2 * j + 3) ** 5 | 1) & (2**64 - 1)) if len(g) else g
        g = mixed(g)
        at = 0
        for c in counts.tolist():
            own = h[at : at + c]
            if c >= k:
                s = np.unique(g[at : at + c - k + 1])
            elif c:
                s = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=8, salt=b"short").digest(), dtype=np.uint64)
            else:
                s = own[:0]
            yield s, hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            at += c
