"""Word shingles of whole texts as arrays of 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

WORDS = 5
_M = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15 | 1
_RNG = np.random.default_rng(20_240_613)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: [\x20\x09-\x0D], the contract's white space
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A published 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, step in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            a = np.full(max(n, 1 << 16), np.uint64(step))
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased), and where each text's words end."""
    data = [t.encode().lower() + b"\n" for t in texts]
    raw = np.frombuffer(b"".join(data), np.uint8)
    ends_of_text = np.cumsum([len(d) for d in data])
    word = ~_SPACE[raw]
    edge = np.diff(np.r_[False, word].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power(len(raw) + 1)
    total = np.r_[np.uint64(0), np.cumsum(_BYTE[raw] * up[:len(raw)], dtype=np.uint64)]
    hashes = mix((total[ends] - total[starts]) * down[starts])
    return hashes, np.searchsorted(starts, ends_of_text)


def shingle_sets(texts: list[str], size: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted; fewer words than ``size`` are one shingle."""
    words, ends = word_hashes(texts)
    n = len(words) - size + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        rolled += words[k:k + max(n, 0)] * _PLACE[k]
    rolled = mix(rolled)
    out, at = [], 0
    for end in ends.tolist():
        if end - at >= size:
            out.append(np.unique(rolled[at:end - size + 1]))
        elif end > at:
            few = words[at:end] * _PLACE[:end - at]
            out.append(mix(np.array([few.sum(dtype=np.uint64) + np.uint64(end - at)])))
        else:
            out.append(np.zeros(0, np.uint64))
        at = end
    return out
