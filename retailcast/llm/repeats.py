"""Windows of a fixed length and the grams that stand for them, in one block of documents.

Every window is represented by its smallest gram (its minimizer).  Equal windows have
equal minimizers at equal places, so a window can stand in two documents only if its
minimizer does: a corpus-wide question about windows becomes one about a few grams.
"""

from __future__ import annotations

import numpy as np

from .arrays import NONE, minimizer_positions, mix


class Windows:
    """All whole windows of documents with a known id, and their minimizers.

    ``start``: window starts; ``of``: per window the number of its minimizer; ``at``: minimizer
    positions; ``first``, ``count``: the (consecutive) windows of each minimizer; ``doc``: document
    number of each item; ``hash``: the minimizers' gram hashes.
    """

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, known: np.ndarray, gram: int, window: int):
        n = int(bounds[-1])
        self.doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
        whole = max(0, n - window + 1)
        hashes = hashes.copy()
        hashes[self.doc[:len(hashes)] != self.doc[gram - 1:]] = NONE
        inside = (self.doc[:whole] == self.doc[window - 1:]) & known[self.doc[:whole]] if whole else np.zeros(0, bool)
        self.start = np.flatnonzero(inside)
        place = minimizer_positions(hashes, window - gram + 1)[self.start] if whole else np.zeros(0, np.int64)
        new = np.ones(len(place), dtype=bool)
        new[1:] = place[1:] != place[:-1]
        self.first = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        self.at = place[self.first]
        self.count = np.diff(np.append(self.first, len(place)))
        self.hash = mix(hashes[self.at])  # minimizers are small; mixed again they deal out evenly


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts by the keys (first key first), and the starts of equal groups in it."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def number_of(order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Group number of each item of ``grouped``."""
    out = np.empty(len(order), dtype=np.int64)
    new = np.zeros(len(order), dtype=np.int64)
    new[starts] = 1
    out[order] = np.cumsum(new) - 1
    return out
