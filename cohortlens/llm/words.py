"""Word and n-gram hashes of many texts at once, in numpy.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r. A word's 64-bit
hash depends on its bytes only, an n-gram's on its words only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes, and words, that are hashed at once; the tables of powers are about as long.
PIECE_BYTES = 1 << 16
PIECE_WORDS = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Random values of the 256 bytes, and which of them are white space."""
    values = np.random.default_rng(20240101).integers(0, 1 << 64, 256, dtype=np.uint64)
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return values, space


@lru_cache(maxsize=2)
def _powers(base: int, length: int) -> np.ndarray:
    out = np.full(length, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, length: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for ``i < length``; only a short table is kept."""
    kept = 1 << 17
    if length <= kept:
        return _powers(base, kept)[:length]
    return _powers.__wrapped__(base, length)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which :func:`range_hash` takes the hash of any range."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values) + 1)[:-1], out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the ranges ``[start, end)``; equal ranges have equal hashes."""
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts])


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, space = _tables()
    gap = space[data]
    edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return starts, range_hash(prefix_sums(values[data]), starts, ends)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the number of words of each text."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(e) + 1 for e in encoded], dtype=np.int64)
    data = np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8) if encoded else np.zeros(
        0, np.uint8)
    _, space = _tables()
    places, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        while end < len(data) and not space[data[end - 1]]:  # to the end of a word
            more = np.flatnonzero(space[data[end:end + PIECE_BYTES]])
            end = end + int(more[0]) + 1 if len(more) else min(len(data), end + PIECE_BYTES)
        starts, found = _piece_hashes(data[at:end])
        places.append(starts + at)
        hashes.append(found)
        at = end
    if not places:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    before = np.searchsorted(np.concatenate(places), np.cumsum(sizes))
    return np.concatenate(hashes), np.diff(before, prepend=0)


def slabs(texts: list[str], size: int = 500_000) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``size`` characters together, with the first one's number."""
    first, held, chars = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text)
        chars += len(text)
        if chars >= size:
            yield first, held
            first, held, chars = i + 1, [], 0
    if held:
        yield first, held


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``len − n + 1`` runs of n words."""
    total = len(words) - n + 1
    if total < 1:
        return np.zeros(0, np.uint64)
    out = np.empty(total, np.uint64)
    for first in range(0, total, PIECE_WORDS):
        starts = np.arange(min(PIECE_WORDS, total - first))
        out[first:first + len(starts)] = range_hash(
            prefix_sums(words[first:first + len(starts) + n - 1]), starts, starts + n)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out
