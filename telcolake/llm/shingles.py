"""Hashed word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTER = _mix(np.arange(1, 257, dtype=np.uint64) * _PRIME)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 4096), _PRIME | np.uint64(1)))])
    return _powers


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word: runs without ASCII white space, A-Z lower-cased."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~_WHITE[raw]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edge = np.flatnonzero(np.diff(inside.astype(np.int8)))
    starts = np.r_[0, edge + 1] if inside[0] else edge + 1
    starts = starts[inside[starts]] if len(starts) else starts
    place = np.flatnonzero(inside)
    first = np.searchsorted(place, starts)
    lengths = np.diff(np.r_[first, len(place)])
    within = np.arange(len(place)) - np.repeat(first, lengths)
    values = _LETTER[_FOLD[raw[place]]] * _power(int(lengths.max()) + 1)[within]
    return _mix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), starts


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text; a shorter text is one shingle, a text without words none."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raws])
    words, starts = word_hashes(b"\n".join(raws) + b"\n")
    bounds = np.r_[0, np.searchsorted(starts, ends)]
    if len(words) >= n:
        rolled = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            rolled = (rolled + words[k : k + len(rolled)]) * (_PRIME + np.uint64(2 * k))
            rolled ^= rolled >> np.uint64(29)
        rolled = _mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for k in range(a, b):
                one = _mix(one * _PRIME + words[k : k + 1])
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
