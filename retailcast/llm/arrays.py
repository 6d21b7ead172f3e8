"""Vectorised hashing of words, bytes and their k-grams, on numpy arrays.

All hashes are functions of content alone, so every task of every run agrees.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Odd multipliers of the polynomial hashes (two independent ones) and of the final mixing.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
SEEDS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x5851F42D4C957F2D))
LOW = 24


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def mix_in_place(h: np.ndarray, room: np.ndarray) -> None:
    """``mix`` of ``h`` written to ``h``; ``room`` is overwritten."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        np.right_shift(h, U64(shift), out=room)
        h ^= room
        if factor:
            h *= U64(factor)


def inverse(a: int) -> int:
    return pow(int(a), -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, U64(int(base)), dtype=U64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


def prefix(values: np.ndarray, base) -> np.ndarray:
    """Prefix sums of ``values[i] * base^i`` modulo 2^64, with a leading 0."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def spans_hash(pre: np.ndarray, base, start: np.ndarray, end: np.ndarray, seed=U64(0)) -> np.ndarray:
    """Hash of each span [start, end) of the sequence whose prefix sums are ``pre``."""
    back = powers(inverse(base), len(pre))
    return mix((pre[end] - pre[start]) * back[start] + seed + (end - start).astype(U64))


def grams_hash(values: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values (len - k + 1 of them)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    pre = prefix(values, BASES[which])
    back = powers(inverse(BASES[which]), n)
    return mix((pre[k:] - pre[:n]) * back + SEEDS[which])


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words_of(text: np.ndarray, offsets: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+`` of documents laid end to end.

    -> (start, end) byte positions of the words, and per document the index of its first word
    (one entry more than documents).
    """
    solid = np.ones(len(text) + 2, dtype=bool)
    solid[0] = solid[-1] = False
    solid[1:-1] = ~_SPACE[text]
    begins = solid[1:-1] & ~solid[:-2]
    inner = offsets[1:-1]
    inner = inner[inner < len(text)]
    begins[inner] = solid[1:-1][inner]
    start = np.flatnonzero(begins)
    stop = solid[1:-1] & ~solid[2:]
    last = inner[inner > 0] - 1
    stop[last] = solid[1:-1][last]
    end = np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(start, offsets)


def words_hash(text: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each word's bytes."""
    if not len(start):
        return np.zeros(0, dtype=U64)
    pre = prefix(text.astype(U64) + U64(1), BASES[which])
    return spans_hash(pre, BASES[which], start, end, SEEDS[which])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values (len - w + 1 of them), by doubling."""
    n, span, m = len(v) - w + 1, 1, v
    if n <= 0:
        return v[:0]
    while 2 * span <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:n], m[w - span:w - span + n])


def minimizer_positions(hashes: np.ndarray, w: int) -> np.ndarray:
    """For every ``w`` consecutive gram hashes the position of the smallest one.

    Compared by the upper 40 bits, ties to the left, so that equal content chooses
    equal positions wherever it stands.
    """
    low = U64((1 << LOW) - 1)
    pos = np.arange(len(hashes), dtype=U64) & low
    pos |= hashes & ~low
    m = sliding_min(pos, w)
    m &= low
    at = np.arange(len(m), dtype=U64)
    m -= at
    m &= low
    m += at
    return m.view(np.int64)


def per_item(bounds: np.ndarray) -> np.ndarray:
    """Document number of each item, from the documents' bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def covered(n: int, start: np.ndarray, length) -> np.ndarray:
    """Which of n positions lie in one of the spans [start, start + length)."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, start, 1)
    np.add.at(delta, np.minimum(start + length, n), -1)
    return np.cumsum(delta[:-1]) > 0


def runs_of(mask: np.ndarray, bounds: np.ndarray):
    """Maximal runs of True that don't cross document bounds -> (start, end)."""
    n = len(mask)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1
