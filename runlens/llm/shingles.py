"""Shingle sets of whole texts as sorted arrays of 64-bit hashes, computed over many texts at once.

Words are runs of bytes other than ASCII white space, A-Z lowered; a shingle is five consecutive
words; a text with fewer words is one shingle. A word's hash is a polynomial over a table of random 64-bit
values, a shingle's a stirred sum of its words' hashes times odd constants.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
CHUNK_BYTES = 1 << 20


def stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(n: int, seed: int) -> np.ndarray:
    return stir((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
BYTE = np.where(SPACE, np.uint64(0), _numbers(256, 11))
BASE = np.uint64(0xD1342543DE82EF95)
WEIGHT = _numbers(WORDS + 1, 1000) | np.uint64(1)
_POWERS = np.cumprod(np.full(256, BASE, dtype=np.uint64))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.full(max(n, 2 * len(_POWERS)), BASE, dtype=np.uint64))
    return _POWERS


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a byte string that begins with white space."""
    a = np.frombuffer(raw, np.uint8)
    space = SPACE[a]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    runs = np.diff(np.append(starts, len(a)))
    place = np.arange(starts[0], len(a)) - np.repeat(starts, runs)
    values = BYTE[a[starts[0]:]] * _powers(int(runs.max()))[place]
    return starts, stir(np.add.reduceat(values, starts - starts[0]))


def _sets(raw: list[bytes]) -> list[np.ndarray]:
    joined = b" " + b" ".join(raw).lower() + b" "
    starts, words = _word_hashes(joined)
    begins = np.cumsum([1] + [len(x) + 1 for x in raw])
    cut = np.searchsorted(starts, begins)
    n = len(words)
    if n >= WORDS:
        sums = np.zeros(n - WORDS + 1, dtype=np.uint64)
        for k in range(WORDS):
            sums += words[k: n - WORDS + 1 + k] * WEIGHT[k]
        shingles = stir(sums)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= WORDS:
            s = np.sort(shingles[a: b - WORDS + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif b > a:
            out.append(stir((words[a:b] * WEIGHT[: b - a]).sum(keepdims=True) + WEIGHT[WORDS:] * np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (empty for null or no words)."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass")
        part.append(raw)
        size += len(raw)
        if size >= CHUNK_BYTES:
            out += _sets(part)
            part, size = [], 0
    return out + _sets(part) if part else out
