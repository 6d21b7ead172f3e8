"""Removal of byte strings that repeat across documents, by maximal repeats of suffix arrays.

Only windows whose minimizer more than one document holds can repeat, and only with a gram
(``Pieces`` has which) beside the minimizer that another segment of it has too.  The windows
of one minimizer are a short segment of text; segments go to the shard of their minimizer, so
all occurrences of a window meet in one shard.  If a minimizer has one and the same segment
wherever it stands, that segment is a repeat with all its occurrences, and its hash and
documents are enough.  Where segments differ, their bytes are sent, and a suffix array over
the distinct ones and its common-prefix lengths are scanned with a stack: every interval of
the common-prefix tree is a repeat with all its occurrences; those whose occurrences are
preceded by different bytes can't be extended to the left and are the maximal repeats.  What a
repeat covers in a document with a larger id than its least one is removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .arrays import U64, mix
from .blocks import (ASK, Block, answer, blocks_size, each_block, output_schema, output_table, rows_table, shard_bounds, shards_for,
                     with_answers, write_blocks)
from .repeats import Windows, grouped, number_of
from .shared import Scratch, pow2_at_least

GRAM = 16
#: A block's texts.  The exchanges have a row for each (block, shard), whose number grows with the
#: square of the input: blocks and shards are large, so that a row still holds some KB at many GB.
BLOCK_BYTES = 1 << 22
#: Texts are cut into windows by runs of documents of so many bytes, whose arrays fit into a processor's cache.
RUN_BYTES = 1 << 17
#: Distinct (minimizer, segment) pairs of all blocks in a shard.
GRAM_ENTRIES = 1_600_000
#: Bytes of segments in a suffix array; a shard has up to ``PARTS`` of them, fewer if there would not be ``SHARDS`` shards.
ARRAY_BYTES, PARTS, SHARDS = 1 << 19, 16, 128
#: A minimizer with more different segments in the blocks than this is hot: its windows are
#: dealt out one by one, by their own hash, so that no shard has to hold them all.
HOT_ENTRIES = 1 << 15
SHORT = 5  # bytes of a hash that a shard compares
ONE, MIXED, HOT = 1, 2, 3  # repeats with one segment, with different ones, with very many
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _span_hash(grams: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each span, from the grams that cover it (at most 112 bytes)."""
    out = size.astype(U64)
    for i in range(0, 7 * GRAM, GRAM):
        out = mix(out * U64(0xD6E8FEB86659FD93) + grams[start + np.minimum(i, size - GRAM)])
    return out


def byte_grams(text: np.ndarray) -> np.ndarray:
    """Hash of every ``GRAM`` (16) consecutive bytes."""
    n = len(text) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    raw = text.tobytes() + b"\0" * 16
    eight = np.empty(len(text), dtype=U64)
    for r in range(8):
        part = np.frombuffer(raw, dtype="<u8", offset=r, count=(len(text) - r + 7) // 8)
        eight[r::8] = part[:len(eight[r::8])]
    out = eight[:n] * U64(0x9E3779B97F4A7C15)
    out += eight[8:8 + n] * U64(0xD6E8FEB86659FD93)
    return mix(out)


def _runs(offsets: np.ndarray):
    """Runs of documents of ``RUN_BYTES`` bytes at most (or one document) -> (first, end)."""
    a, end = 0, len(offsets) - 1
    while a < end:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + RUN_BYTES, side="right")) - 1)
        yield a, b
        a = b


def _alike(deal: np.ndarray, text_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the upper 24 bits of ``deal`` in which equal pairs stand together, and the starts of equal pairs in it.

    Pairs are sorted by as many bits of a hash as fit beside their place.  Pairs whose bits agree by chance may
    be mixed up and start more than once; that makes an entry twice, and never one of two.
    """
    place = U64(max(1, (len(deal) - 1).bit_length()))
    key = mix(deal * U64(0xD6E8FEB86659FD93) ^ text_hash)
    key >>= U64(24)
    key |= deal & ~U64((1 << 40) - 1)
    key >>= place
    key <<= place
    key |= np.arange(len(deal), dtype=U64)
    key.sort()
    key &= (U64(1) << place) - U64(1)
    order = key.astype(np.int64)
    new = np.ones(len(order), dtype=bool)
    d, t = deal[order], text_hash[order]
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1])
    return order, np.flatnonzero(new)


class Pieces:
    """A block's windows as segments, one for each run of windows with one minimizer.

    A window reaches over its minimizer by ``ceil((window - GRAM) / 2)`` bytes or more on one side at least, so it
    has the gram that lies so far to the left or to the right.  ``left`` and ``right`` are a byte of the hash of
    those grams, where the segment has them: a segment can have a window in common with another one of its
    minimizer only if one of the two agrees.
    """

    def __init__(self, block: Block, window: int):
        self.block, self.window = block, window
        cut = [self._cut(a, b) for a, b in _runs(block.offsets)]
        self.hash, self.text_hash, self.left, self.right, self.ids, self.start, self.count = (np.concatenate(x) for x in zip(*cut, strict=True))
        self.order, self.starts = _alike(self.hash, self.text_hash)

    def _cut(self, a: int, b: int) -> tuple:
        """Segments of the documents from a to before b: hashes of minimizer, segment and gram to the left and right, document's id, place, windows."""
        base, end = int(self.block.offsets[a]), int(self.block.offsets[b])
        grams = byte_grams(self.block.text[base:end])
        w = Windows(grams, self.block.offsets[a:b + 1] - base, self.block.known[a:b], GRAM, self.window)
        if not len(w.at):
            return (*(np.zeros(0, k) for k in (U64, U64, np.uint8, np.uint8, np.int64, np.int64, np.int64)),)
        start, size, side = w.start[w.first], w.count + self.window - 1, (self.window - GRAM + 1) // 2
        text_hash = _span_hash(grams, start, size)
        left = np.where(w.at - side >= start, grams[np.maximum(w.at - side, 0)], text_hash).astype(np.uint8)
        right = np.where(w.at + side + GRAM <= start + size, grams[np.minimum(w.at + side, len(grams) - 1)], text_hash).astype(np.uint8)
        return w.hash, text_hash, left, right, self.block.ids[a:b][w.doc[w.at]], start + base, w.count

    def ask(self, shards: int, number: int) -> list[tuple]:
        """For each shard the distinct (minimizer, segment) pairs, and whether several documents have them."""
        if not len(self.starts):
            return []
        o, s = self.order, self.starts
        ids = self.ids[o]
        more = np.minimum.reduceat(ids, s) != np.maximum.reduceat(ids, s)
        first = o[s]
        h, t, left, right = self.hash[first], self.text_hash[first], self.left[first], self.right[first]
        at, short, short_t = shard_bounds(h, shards), _short(h, shards), _short(t, 1)
        return [(i, number, np.int64(b - a).tobytes() + short[a:b].tobytes() + short_t[a:b].tobytes() + left[a:b].tobytes() + right[a:b].tobytes() + np.packbits(more[a:b]).tobytes())
                for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]

    def send(self, payloads: list[bytes], shards: int, parts: int, number: int) -> list[tuple]:
        """Rows of distinct segments for the shards, and one (shard -1) that the block gets back.

        A shard's row holds the segments that are alone under their minimizer (hashes and least
        id), and the bytes of the others, in order of the shard's ``parts``.
        """
        kinds = np.zeros(len(self.starts), dtype=np.uint8)
        at = 0
        for p in payloads:
            size = int(np.frombuffer(p, dtype=np.int64, count=1)[0])
            bits = np.unpackbits(np.frombuffer(p, dtype=np.uint8, offset=8), count=2 * size)
            kinds[at:at + size] = bits[:size] + 2 * bits[size:]
            at += size
        assert at == len(kinds), "an answer is missing"
        kinds = kinds[number_of(self.order, self.starts)]
        one = self._distinct(self.hash, self.text_hash, np.flatnonzero(kinds == ONE), self.start, self.count, self.ids)
        mixed, hot = np.flatnonzero(kinds == MIXED), np.flatnonzero(kinds == HOT)
        of, place = _expand(np.zeros(len(hot), np.int64), self.count[hot] - 1)  # each window of a hot minimizer by itself
        single, of = self.start[hot][of] + place, hot[of]
        alone = self._window_hash(single)
        deal, text_hash = np.concatenate([self.hash[mixed], alone]), np.concatenate([self.text_hash[mixed], alone])
        start = np.concatenate([self.start[mixed], single])
        count = np.concatenate([self.count[mixed], np.ones(len(single), np.int64)])
        ids = np.concatenate([self.ids[mixed], self.ids[of]])
        many = self._distinct(deal, text_hash, np.arange(len(deal)), start, count, ids)
        n = len(one["first"])
        state = b"".join(x.tobytes() for x in (
            np.concatenate([one["start"], many["start"]]), np.concatenate([one["number"], many["number"] + n]).astype(np.uint32),
            np.concatenate([one["count"], many["count"]]).astype(np.uint8), np.concatenate([one["later"], many["later"]])))
        out = [(-1, number, np.array([n, len(many["first"])], dtype=np.int64).tobytes() + _press(state))]
        start, size = many["start"][many["first"]], many["count"][many["first"]] + self.window - 1
        begin = np.concatenate([[0], np.cumsum(size)])
        text = self.block.text[np.repeat(start - begin[:-1], size) + np.arange(begin[-1])]
        at, at_part = shard_bounds(one["deal"], shards), shard_bounds(many["deal"], shards * parts)
        at_many = at_part[::parts]
        short = _short(one["deal"], shards)
        for i in range(shards):
            a, b, c, d = at[i], at[i + 1], at_many[i], at_many[i + 1]
            if b > a or d > c:
                each = np.diff(at_part[i * parts:(i + 1) * parts + 1]).astype(np.uint32)
                out.append((i, number, np.array([b - a, d - c], dtype=np.int64).tobytes() + each.tobytes() + one["hash"][a:b].tobytes() + one["least"][a:b].tobytes() + many["least"][c:d].tobytes()
                            + short[a:b].tobytes() + size[c:d].astype(np.uint8).tobytes() + _press(text[begin[c]:begin[d]].tobytes())))
        return out

    def _window_hash(self, start: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), dtype=U64)
        for at in range(0, len(start), 1 << 14):
            part = start[at:at + (1 << 14)]
            text = self.block.text[part[:, None] + np.arange(self.window)].ravel()
            out[at:at + len(part)] = _span_hash(byte_grams(text), np.arange(len(part)) * self.window, np.full(len(part), self.window))
        return out

    @staticmethod
    def _distinct(deal, text_hash, which, start, count, ids) -> dict:
        """Distinct ones of the segments ``which``, in order of the hash that deals them."""
        deal, text_hash, ids = deal[which], text_hash[which], ids[which]
        order, starts = _alike(deal, text_hash)
        least = np.minimum.reduceat(ids[order], starts) if len(starts) else ids
        number, first = number_of(order, starts), order[starts]
        return {"deal": deal[first], "hash": text_hash[first], "least": least, "first": first, "number": number, "start": start[which], "count": count[which], "later": ids > least[number] if len(ids) else np.zeros(0, bool)}


def _press(raw: bytes) -> bytes:
    return np.int64(len(raw)).tobytes() + (zstandard.ZstdCompressor(level=3).compress(raw) if raw else b"")


def _pressed(raw: bytes) -> bytes:
    size = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
    return zstandard.ZstdDecompressor().decompress(raw[8:], max_output_size=size) if size else b""


def _short(h: np.ndarray, shards: int) -> np.ndarray:
    """The ``SHORT`` bytes of each hash after the bits that chose its shard."""
    bits = U64(shards.bit_length() - 1)
    return np.ascontiguousarray((h << bits).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :SHORT])


def _wide(short: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(short), 8), dtype=np.uint8)
    wide[:, :SHORT] = short
    return wide.view(">u8").ravel().astype(U64)


def _grams(_, payloads):
    """Of each (minimizer, segment): can it have a window in common with others, and with which kind of segments."""
    counts = [int(np.frombuffer(p, dtype=np.int64, count=1)[0]) for p in payloads]
    total = sum(counts)
    short, short_t, more, at = np.zeros((total, SHORT), np.uint8), np.zeros((total, SHORT), np.uint8), np.zeros(total, dtype=bool), 0
    sides = np.zeros((2, total), np.uint8)
    for p, n in zip(payloads, counts, strict=True):
        got, here = np.frombuffer(p, dtype=np.uint8, offset=8), slice(at, at + n)
        short[here] = got[:SHORT * n].reshape(n, SHORT)
        short_t[here] = got[SHORT * n:2 * SHORT * n].reshape(n, SHORT)
        sides[:, here] = got[2 * SHORT * n:(2 * SHORT + 2) * n].reshape(2, n)
        more[here] = np.unpackbits(got[(2 * SHORT + 2) * n:], count=n).astype(bool)
        at += n
    order, s = _order(_wide(short) >> U64(64 - 8 * SHORT), 8 * SHORT)
    new = np.ones(total, dtype=bool)
    new[1:] = s[1:] != s[:-1]
    starts, number = np.flatnonzero(new), np.cumsum(new) - 1
    text, more = _wide(short_t)[order], more[order]
    again = (np.diff(np.append(starts, total)) > 1) | np.logical_or.reduceat(more, starts)
    same = np.minimum.reduceat(text, starts) == np.maximum.reduceat(text, starts)
    kind = np.where(again & same, ONE, 0).astype(np.uint8)[number]
    which = np.flatnonzero((again & ~same)[number])
    number = number[which]
    meets = more[which]
    for side in sides:
        meets |= _twice(number, side[order[which]])
    which, number = which[meets], number[meets]
    kind[which] = np.where(np.bincount(number, minlength=len(starts))[number] > HOT_ENTRIES, HOT, MIXED)
    kinds, out, at = np.empty(total, dtype=np.uint8), [], 0
    kinds[order] = kind
    for n in counts:
        k = kinds[at:at + n]
        out.append(np.int64(n).tobytes() + np.packbits(np.concatenate([k & 1, k >> 1])).tobytes())
        at += n
    return out


def _twice(number: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Which items have a byte that another item of their (ascending) number has."""
    out = np.zeros(len(number), dtype=bool)
    if len(number):
        order, s = _order((number.astype(U64) << U64(8)) | byte, int(number[-1]).bit_length() + 8)
        equal = s[1:] == s[:-1]
        out[order[1:][equal]] = out[order[:-1][equal]] = True
    return out


def _order(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the keys (of at most ``bits`` bits), and the sorted keys.

    Where a key and its place fit in 64 bits they are sorted as one value: many times faster.
    """
    place = max(1, (len(key) - 1).bit_length())
    if bits + place > 64:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = np.sort((key << U64(place)) | np.arange(len(key), dtype=U64))
    return (both & U64((1 << place) - 1)).astype(np.int64), both >> U64(place)


def suffix_array(symbols: np.ndarray, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, list]:
    """Positions ``wanted`` sorted by the ``depth`` symbols from there on (0 ends a text), by rank doubling.

    symbols: 0..256 with ``depth`` (7 at least) zeros at the end -> (sorted positions, ranks at each length).  Ranks
    are doubled for all positions up to a quarter of the depth; the rest is added for the wanted ones alone.
    """
    n = len(symbols) - depth
    used = np.bincount(symbols, minlength=257) > 0
    used[0] = True
    dense = (np.cumsum(used) - 1).astype(U64)[symbols]  # the symbols that there are, numbered
    bits = max(1, int(used.sum() - 1).bit_length())
    length = max(2, min(7, (64 - n.bit_length()) // bits))
    key = np.zeros(n, dtype=U64)
    for i in range(length):
        key <<= U64(bits)
        key |= dense[i:i + n]
    bits *= length
    half = max(1, n.bit_length())
    levels = []
    while True:
        order, s = _order(key, bits)
        new = np.ones(n, dtype=bool)
        new[1:] = s[1:] != s[:-1]
        rank = np.zeros(len(symbols), dtype=np.int32)
        rank[order] = np.cumsum(new, dtype=np.int32)
        levels.append((length, rank))
        if 4 * length >= depth or new.all():
            break
        bits = 2 * half
        key = rank[:n].astype(U64)
        key <<= U64(half)
        after = min(n, len(symbols) - length)
        key[:after] |= rank[length:length + after].astype(U64)
        length *= 2
    own, done = rank[wanted], length
    order, last = np.argsort(own, kind="stable"), len(symbols) - 1
    while done < depth and not new.all():
        key = own.astype(U64)
        key <<= U64(half)
        key |= rank[np.minimum(wanted + done, last)].astype(U64)
        order, s = _order(key, 2 * half)
        new = np.ones(len(order), dtype=bool)
        new[1:] = s[1:] != s[:-1]
        own = np.empty(len(order), dtype=np.int32)
        own[order] = np.cumsum(new, dtype=np.int32)
        done += length
    return wanted[order], levels


def common_prefix(symbols: np.ndarray, levels: list, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, at most ``most``."""
    out, last = np.zeros(len(a), dtype=np.int64), len(symbols) - 1
    top, deepest = levels[-1][0], int(most.max()) if len(most) else 0
    for length, rank in [levels[-1]] * (deepest // top - 1) + levels[::-1]:
        i, j = rank[np.minimum(a + out, last)], rank[np.minimum(b + out, last)]
        out += np.where((i == j) & (i > 0), length, 0)
    alive = np.ones(len(a), dtype=bool)
    for _ in range(levels[0][0] - 1):
        alive &= symbols[np.minimum(a + out, last)] == symbols[np.minimum(b + out, last)]
        out += alive
    return np.minimum(out, most)


def common_prefix_intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All intervals of the common-prefix tree of length ``least`` or more, by one scan with a stack.

    lcp[i]: common prefix of the suffixes i - 1 and i -> (first, last, length).
    """
    out: list[tuple[int, int, int]] = []
    high = np.flatnonzero(lcp >= least)
    values, stack, before = lcp[high].tolist(), [], -2
    for i, v in zip(high.tolist(), values, strict=True):
        if i != before + 1:
            while stack:
                length, first = stack.pop()
                out.append((first, before, length))
        first = i - 1
        while stack and stack[-1][0] > v:
            length, first = stack.pop()
            out.append((first, before, length))
        if not stack or stack[-1][0] < v:
            stack.append((v, first))
        before = i
    while stack:
        length, first = stack.pop()
        out.append((first, before, length))
    t = np.array(out, dtype=np.int64).reshape(-1, 3)
    return t[:, 0], t[:, 1], t[:, 2]


def maximal_repeats(text: np.ndarray, bounds: np.ndarray, window: int):
    """Maximal repeats of ``window`` bytes or more among texts laid end to end.

    -> (sorted positions, first and last index in them of each repeat, its length).  A repeat is
    given with all its occurrences, the intervals of the suffix array.
    """
    size = np.diff(bounds)
    depth = int(size.max()) if len(size) else 0
    n = int(bounds[-1]) + len(size)
    owner = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(text)) + owner  # each text is followed by a 0
    symbols = np.zeros(n + max(depth, 7) + 1, dtype=np.int16)
    symbols[place] = text.astype(np.int16) + 1
    rest = bounds[1:][owner] - np.arange(len(text))
    wanted = rest >= window
    order, levels = suffix_array(symbols, place[wanted], max(depth, 7) + 1)
    left = np.zeros(len(symbols), dtype=np.int64)
    left[place] = rest
    lcp = np.zeros(len(order), dtype=np.int64)
    if len(order) > 1:
        lcp[1:] = common_prefix(symbols, levels, order[:-1], order[1:], np.minimum(left[order[:-1]], left[order[1:]]))
    first, last, length = common_prefix_intervals(lcp, window)
    before = np.where(order > 0, symbols[order - 1], 0)
    differs = np.zeros(len(order) + 1, dtype=np.int64)
    if len(order) > 1:
        differs[2:] = np.cumsum((before[1:] != before[:-1]) | (before[1:] == 0) | (before[:-1] == 0))
    diverse = differs[last + 1] > differs[first + 1]
    back = np.zeros(len(symbols), dtype=np.int64)
    back[place] = np.arange(len(text))
    return back[order], first[diverse], last[diverse], length[diverse]


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the intervals -> (interval number, member)."""
    n = last - first + 1
    number = np.repeat(np.arange(len(n)), n)
    return number, np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + first[number]


def _ones(parts: list) -> np.ndarray:
    """Which segments that are alone under their minimizer stand in a smaller document too."""
    text, least, short = (np.concatenate(x) for x in zip(*parts, strict=True))
    order, starts = grouped(text, _wide(short))
    return least > np.minimum.reduceat(least[order], starts)[number_of(order, starts)] if len(starts) else np.zeros(0, bool)


def _mixed(least: np.ndarray, size: np.ndarray, begin: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """Per segment a bit for each of its windows: set if the window stands in a smaller document too.

    The segments are ``size`` bytes of ``text`` from ``begin``.
    """
    if not len(size):
        return np.zeros(0, U64)
    most = int(size.max())
    table = np.zeros((len(size), most + 1), dtype=np.uint8)
    row, column = _expand(np.zeros(len(size), np.int64), size - 1)
    table[row, column] = text[begin[row] + column]
    table[:, most] = size
    _, one, number = np.unique(table.view(f"V{most + 1}").ravel(), return_index=True, return_inverse=True)
    owner = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(owner, number, least)
    sizes = size[one]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    row, column = _expand(np.zeros(len(one), np.int64), sizes - 1)
    own = table[one[row], column]
    position, first, last, length = maximal_repeats(own, bounds, window)
    doc = owner[row[position]]
    dup = np.zeros(len(own) + 1, dtype=np.int64)
    total, step = np.cumsum(last - first + 1), 1 << 20  # members of nested repeats, so many at a time
    for part in np.split(np.arange(len(first)), np.searchsorted(total, np.arange(step, total[-1], step))) if len(first) else []:
        if not len(part):
            continue
        cuts = np.stack([first[part], last[part] + 1], axis=1).ravel()
        low = np.minimum.reduceat(np.append(doc, doc[-1:]), cuts)[::2]
        repeat, member = _expand(first[part], last[part])
        later = doc[member] > low[repeat]
        at = position[member[later]]
        np.add.at(dup, at, 1)
        np.add.at(dup, at + length[part][repeat[later]] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(dup[:-1]) > 0)  # window starts that repeat in a smaller document
    bits = np.zeros(len(one), dtype=U64)
    np.bitwise_or.at(bits, row[at], U64(1) << column[at].astype(U64))
    out = bits[number]
    out[least > owner[number]] = ALL  # the same segment in a smaller document
    return out


def _segments(window: int, parts: int):
    def run(_, payloads):
        sizes, ones, many, each = [], [], [], []
        for p in payloads:
            n, m = np.frombuffer(p, dtype=np.int64, count=2).tolist()
            each.append(np.frombuffer(p, dtype=np.uint32, count=parts, offset=16))
            begin = 16 + 4 * parts
            at = begin + 16 * n + 8 * m
            sizes.append((n, m))
            ones.append((np.frombuffer(p, dtype=U64, count=n, offset=begin), np.frombuffer(p, dtype=np.int64, count=n, offset=begin + 8 * n), np.frombuffer(p, dtype=np.uint8, count=SHORT * n, offset=at).reshape(n, SHORT)))
            many.append((np.frombuffer(p, dtype=np.int64, count=m, offset=begin + 16 * n), np.frombuffer(p, dtype=np.uint8, count=m, offset=at + SHORT * n), np.frombuffer(_pressed(p[at + SHORT * n + m:]), dtype=np.uint8)))
        dup, bits, out, a, b = _ones(ones), _parts(many, np.array(each), window), [], 0, 0
        for n, m in sizes:
            out.append(np.array([n, m], dtype=np.int64).tobytes() + bits[b:b + m].tobytes() + np.packbits(dup[a:a + n]).tobytes())
            a, b = a + n, b + m
        return out

    return run


def _parts(many: list, each: np.ndarray, window: int) -> np.ndarray:
    """``_mixed`` of a shard's segments, one part of the shard at a time (each: segments by payload and part)."""
    least, size, text = (np.concatenate(x) for x in zip(*many, strict=True))
    size = size.astype(np.int64)
    begin = np.cumsum(size) - size
    part = np.repeat(np.tile(np.arange(each.shape[1], dtype=np.uint16), len(each)), each.ravel())
    order, bits = np.argsort(part, kind="stable"), np.zeros(len(size), U64)
    for which in np.split(order, np.cumsum(each.sum(axis=0))[:-1]):
        bits[which] = _mixed(least[which], size[which], begin[which], text, window)
    return bits


def _gone(block: Block, payloads: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of a block's bytes that are removed, by what it kept for itself (the first payload) and the shards' answers.

    -> (first, end, document number) of each; runs don't cross documents.
    """
    n, m = np.frombuffer(payloads[0], dtype=np.int64, count=2).tolist()
    state = _pressed(payloads[0][16:])
    size = len(state) // 14
    start, number, count, later = (np.frombuffer(state, dtype=k, count=size, offset=at * size) for k, at in ((np.int64, 0), (np.uint32, 8), (np.uint8, 12), (bool, 13)))
    ones, many = [], []
    for p in payloads[1:]:
        a, b = np.frombuffer(p, dtype=np.int64, count=2).tolist()
        many.append(np.frombuffer(p, dtype=U64, count=b, offset=16))
        ones.append(np.unpackbits(np.frombuffer(p, dtype=np.uint8, offset=16 + 8 * b), count=a))
    bits = np.concatenate([np.where(np.concatenate([*ones, np.zeros(0, np.uint8)]) > 0, ALL, U64(0)), *many])
    assert len(bits) == n + m, "an answer is missing"
    mine = np.where(later, ALL, bits[number]) if size else bits
    whole, some = np.flatnonzero(mine == ALL), np.flatnonzero((mine != ALL) & (mine > 0))
    segment, offset = _expand(np.zeros(len(some), np.int64), count[some].astype(np.int64) - 1)
    dup = (mine[some][segment] >> offset.astype(U64)) & U64(1) > 0
    single = start[some][segment[dup]] + offset[dup]
    first = np.concatenate([start[whole], single])
    order = np.argsort(first)
    end = np.concatenate([start[whole] + count[whole] - 1, single])[order] + window
    first = first[order]
    doc = np.searchsorted(block.offsets, first, side="right") - 1
    new = np.ones(len(first) + 1, dtype=bool)
    new[1:-1] = (first[1:] > end[:-1]) | (doc[1:] != doc[:-1])
    return first[new[:-1]], end[new[1:]], doc[new[:-1]]


def layout(size: int) -> tuple[int, int, int]:
    """For so many bytes of text: shards of grams, shards of segments, and the latter's parts with a suffix array each."""
    arrays = min(shards_for(size / 4, ARRAY_BYTES, 32), 1 << 24)  # ``_alike`` orders by so many bits
    shards = min(arrays, pow2_at_least(arrays / PARTS, SHARDS))
    return shards_for(size / 18, GRAM_ENTRIES, SHARDS // 2), shards, arrays // shards


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """Remove every byte covered by a ``window``-byte string that also starts in a document of smaller id.

    Texts are UTF-8 bytes (null: empty); strings never cross documents and are judged on the
    input.  Returns every row with its other columns, the bytes that stay (binary), ``n_bytes``,
    ``n_removed`` and ``n_spans`` (maximal removed runs).  A row with null id neither loses bytes
    nor is a source; rows of one id don't remove each other's bytes, whether equal or not.  An
    empty table gives an empty table; input columns named like an added one are replaced.
    ``window`` may be 20 to 60.
    """
    if not GRAM + 4 <= window <= 60:
        raise ValueError("window must be 20 to 60 bytes")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {"n_bytes", "n_removed", "n_spans"}])
    scratch = Scratch(docs.sparkSession, "suffix_dedup")
    blocks = write_blocks(scratch, docs, id_col, text_col, BLOCK_BYTES)
    _, size = blocks_size(blocks)
    gram_shards, segment_shards, parts = layout(size)
    asked = each_block(blocks, lambda b, i: Pieces(b, window).ask(gram_shards, i), ASK)
    again = scratch.write(answer(asked, _grams), "gram_answers", batch_rows=8)
    sent = with_answers(blocks, again, lambda b, i, got: rows_table(Pieces(b, window).send(got, segment_shards, parts, i), ASK), ASK)
    sent = scratch.write(sent, "segments", "uncompressed")
    both = sent.where("shard < 0").unionByName(answer(sent.where("shard >= 0"), _segments(window, parts)))
    schema = output_schema(docs, id_col, text_col, [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long")], "binary")

    def finish(block: Block, _, payloads: list[bytes]) -> pa.Table:
        begin, end, doc = _gone(block, payloads, window)
        sizes, n = np.diff(block.offsets), len(block.ids)
        spans = np.bincount(doc, minlength=n)
        removed = np.bincount(doc, weights=end - begin, minlength=n).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(removed)])
        raw = block.text.tobytes()
        kept = b"".join(raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)], strict=True))
        cut = (block.offsets - total).tolist()
        texts = pa.array([kept[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], type=pa.binary())
        return output_table(block, text_col, texts, {"n_bytes": sizes.astype(np.int64), "n_removed": removed.astype(np.int64), "n_spans": spans.astype(np.int64)})

    return with_answers(blocks, both, finish, schema)
