"""Secret scan: fixed patterns, and a password guess-cost over credential-context values.

The guess cost of a value is the cheapest way to build it from parts an attacker tries
first: words, dates, repeated blocks, keyboard walks, and brute force for the rest.  It is
found by dynamic programming over the value's positions; the step for brute force adds one
character.  Words are ranked by how common they are: in a general list of 32,000 words, in the
documents themselves, and in a short list of what passwords are made of.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import BASES, U64, mix, powers, prefix
from .shared import Scratch

# The base patterns of the scan.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

# Keys that announce a credential, with freer values than the base patterns.  A quoted
# value reaches to the closing quote on its line; without one it ends at the first blank.
CONTEXT = re.compile(r"""(?<![A-Za-z0-9])(?ai:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|auth(?:orization)?|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret)["']?[\x20\t]*(?:[:=]|(?ai:is)(?=[\x20\t]))[\x20\t]*(?:"((?:[^"\\\n]|\\[^\n]){6,}+)"|'((?:[^'\\\n]|\\[^\n]){6,}+)'|["']?([^\s"'<>]{6,}))""")

# Common parts of passwords, the commonest first.
WORDS = ("password", "admin", "welcome", "login", "letmein", "secret", "master", "dragon", "monkey", "love", "hello", "test",
         "user", "root", "pass", "guest", "changeme", "default", "sunshine", "princess", "football", "baseball", "shadow",
         "summer", "winter", "spring", "autumn", "flower", "freedom", "whatever", "trust", "super", "system", "server", "home",
         "house", "the", "and", "you", "this", "that", "with", "have", "from", "not", "for", "are", "was", "all", "one", "our",
         "out", "day", "time", "year", "work", "blue", "red", "green", "black", "white", "star", "king", "queen", "angel",
         "happy", "lucky", "money", "music", "soccer", "hockey", "tiger", "eagle", "horse", "battery", "correct", "staple",
         "token", "key", "api", "access", "example", "sample", "demo", "temp", "value", "string", "none", "null", "true",
         "false", "your", "here", "insert", "placeholder", "company", "office", "london", "paris", "berlin", "madrid")
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4@310$57!", "aaeiosstl")
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")

# Words of the documents: 3 to 32 letters, in two documents or more, the commonest 2^16 at most.
WORD = re.compile(r"\b[^\W\d_]{3,32}\b")
LONGEST = 32
MOST_WORDS = 1 << 16
SHORT = 256  # characters up to which every period is compared over the whole value
PLACES = 1 << 18  # places of a longer one that are compared at once
_PAIRS = [p for row in KEYBOARD for p in zip(row, row[1:])] + [p for up, low in zip(KEYBOARD, KEYBOARD[1:]) for p in zip(up, low)]
_NEXT = {*_PAIRS, *((b, a) for a, b in _PAIRS)}


def _class_bits(c: str) -> float:
    if c.isascii():
        return math.log2(10) if c.isdigit() else math.log2(26) if c.isalpha() else math.log2(33)
    return 8.0


def _scanned(a: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of the stretches with each period, one period after the other."""
    for p in range(1, len(a) // 2 + 1):
        same = a[p:] == a[:-p]
        if same.sum() < p:
            continue
        turns = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
        yield from ((s, e + p, p) for s, e in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True) if e - s >= p)


def _agreeing(a: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The same stretches of a long value, some of them twice or more.

    A stretch with period p holds two places x and x + p, x a multiple of p, from which the value
    agrees with itself backward and forward p characters or more in all.  How far, is found by
    halving on hashes of the parts, for many x and p at once: n ln n places in all.
    """
    n, power, hashes = len(a), powers(BASES[0], len(a) + 1), prefix(mix(a.astype(U64)), BASES[0])

    def agree(x, y, most, way):
        """Characters in which the parts at x and y agree, forward (1) or backward (-1)."""
        low, high = np.zeros(len(x), np.int64), most + 1
        while (high - low > 1).any():
            mid = (low + high) >> 1
            x0, y0 = (x, y) if way > 0 else (x - mid, y - mid)
            same = (hashes[x0 + mid] - hashes[x0]) * power[y - x] == hashes[y0 + mid] - hashes[y0]
            low, high = np.where(same, mid, low), np.where(same, high, mid)
        return low

    first = 1
    while first <= n // 2:
        last = min(n // 2, first + max(0, PLACES * first // n))
        periods = np.arange(first, last + 1)
        count = (n - 1) // periods
        p = np.repeat(periods, count)
        x = (np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count)) * p
        hit = np.flatnonzero(a[x] == a[x + p])
        x, p = x[hit], p[hit]
        after, before = agree(x, x + p, n - x - p, 1), agree(x, x + p, x, -1)
        hit = np.flatnonzero(after + before >= p)
        yield from zip((x - before)[hit].tolist(), (x + p + after)[hit].tolist(), p[hit].tolist(), strict=True)
        first = last + 1


def _repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, period) of all stretches that repeat a block, which is itself no repeat, at least once."""
    a = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), dtype="<u4")

    def least(found):
        # a stretch of a block that is itself a repeat is one of the shorter block, too
        periods: dict[tuple[int, int], int] = {}
        for s, e, p in found:
            periods[s, e] = min(p, periods.get((s, e), p))
        return [(s, e, p) for (s, e), p in periods.items()]

    if len(a) > SHORT:
        found = least(_agreeing(a))
        if all((a[s:e - p] == a[s + p:e]).all() for s, e, p in found):
            return found  # else different parts had one hash
    return least(_scanned(a))


class _Copies:
    """The cheapest way to end with copies of a block in a stretch that repeats it, place by place.

    From place j, c copies cost best[j] + bits of the block + log2(c).  The starts that end at a place lie
    whole blocks apart and their blocks are one.  The logarithm grows ever slower, so an earlier start
    that is behind a later one may pass it, but never the other way: of the starts in the running
    the latest leads, and each waits for the next one below it to pass (at once, or it is dropped).
    """

    def __init__(self, start: int, end: int, period: int):
        self.start, self.end, self.period = start, end, period
        self.fewest = 2 + (period == 1)
        self.running: dict[int, list[tuple[int, float]]] = {}
        self.bits: dict[int, float] = {}

    def cheapest(self, i: int, best: list[float], bits) -> float:
        """Cost up to place ``i``, asked for every place from ``fewest`` copies on; ``bits``: of the block at a place."""
        at, turn = divmod(i - self.start, self.period)
        running, k = self.running.setdefault(turn, []), at - self.fewest
        j = self.start + turn + k * self.period
        cost = best[j]
        if turn not in self.bits:
            self.bits[turn] = bits(j, self.period)
        self._drop(running, at)
        if not running or cost + math.log2(self.fewest) < running[-1][1] + math.log2(at - running[-1][0]):
            while len(running) > 1 and self._passed(running[-2], running[-1]) <= self._passed(running[-1], (k, cost)):
                running.pop()
            running.append((k, cost))
        k, cost = running[-1]
        return cost + (self.bits[turn] + math.log2(at - k)) + 1.0

    def _drop(self, running, at):
        while len(running) > 1 and running[-2][1] + math.log2(at - running[-2][0]) <= running[-1][1] + math.log2(at - running[-1][0]):
            running.pop()

    @staticmethod
    def _passed(early: tuple[int, float], late: tuple[int, float]) -> float:
        """Where the early start's cost falls to the late one's."""
        ratio = 2.0 ** (late[1] - early[1])
        return (ratio * late[0] - early[0]) / (ratio - 1) if ratio > 1 else math.inf


def _word_ends(value: str, low: str, ranks: dict[str, int]) -> dict[int, list[tuple[int, float]]]:
    """Per place the (start, bits) of the words that end there."""
    n, plain = len(value), low.translate(LEET)
    forms = ((low, 0.0),) if plain == low else ((low, 0.0), (plain, 2.0))
    ends = defaultdict(list)
    for i in range(n):
        for size in range(min(LONGEST, n - i), 2, -1):
            for form, extra in forms:
                if rank := ranks.get(form[i:i + size]):
                    shape = value[i:i + size]
                    upper = sum(map(str.isupper, shape))
                    case = 0 if not upper else 1 if upper == size or upper == 1 and shape[0].isupper() else upper + 1
                    ends[i + size].append((i, math.log2(rank + 1) + case + extra))
                    break
    return ends


def _bits(value: str, ranks: dict[str, int], words: dict[int, list[tuple[int, float]]] | None = None, at: int = 0) -> float:
    """``words``: the words of a longer value that holds ``value`` at ``at``."""
    n, low = len(value), value.lower()
    if len(low) != n:
        low = value
    if words is None:
        words = _word_ends(value, low, ranks)
    ends, walk = defaultdict(list), 0
    for i in range(n):
        if low[i].isdigit() and (m := DATE.match(low, i)):
            ends[m.end()].append((i, math.log2(365 * 119) if m.end() - i > 4 else math.log2(119)))
        if i and (low[i - 1], low[i]) in _NEXT:
            if i - walk >= 2:
                ends[i + 1].append((walk, math.log2(47) + 1.0 * (i - walk)))
        else:
            walk = i
    blocks: dict[str, float] = {}
    shared = words if value.isascii() else None  # elsewhere a letter's lower case may hang on its neighbours

    def block_bits(j: int, p: int) -> float:
        block = value[j:j + p]
        if block not in blocks:
            cost = _class_bits(block) if p == 1 else _bits(block, ranks, shared, at + j if value.isascii() else 0)
            if p > LONGEST:
                return cost  # each long block is asked for once in its stretch
            blocks[block] = cost
        return blocks[block]

    opened = defaultdict(list)
    for copies in (_Copies(*x) for x in _repeats(value)):
        opened[copies.start + copies.fewest * copies.period].append(copies)
    best, active = [0.0] * (n + 1), []
    for i in range(1, n + 1):
        least = best[i - 1] + _class_bits(value[i - 1])
        for j, cost in words.get(at + i, ()):
            if j >= at:
                least = min(least, best[j - at] + cost + 1.0)
        for j, cost in ends.get(i, ()):
            least = min(least, best[j] + cost + 1.0)
        if i in opened or active:
            active = [c for c in active + opened.pop(i, []) if c.end >= i]
            for c in active:
                least = min(least, c.cheapest(i, best, block_bits))
        best[i] = least
    return best[n]


def general_words() -> list[str]:
    """Words of three letters or more, the commonest first: the whole words that a tokenizer of 49,000
    entries learnt, in the order in which it merged them (the order of frequency)."""
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    ends = ((w.removesuffix("</w>"), w) for w in sorted(vocab, key=vocab.get))
    return [w for w, entry in ends if w != entry and 3 <= len(w) <= LONGEST and w.isascii() and w.isalpha()]


def ranked(*lists) -> dict[str, int]:
    """The best rank of each word in any of the lists."""
    ranks: dict[str, int] = {}
    for words in lists:
        for i, w in enumerate(words):
            ranks[w] = min(ranks.get(w, i + 1), i + 1)
    return ranks


_GENERAL: dict[str, int] = {}


def guess_bits(value: str, ranks: dict[str, int] | None = None) -> float:
    """log2 of the guesses that the cheapest segmentation of ``value`` takes (``ranks``: the general words)."""
    if ranks is None:
        ranks = _GENERAL or _GENERAL.update(ranked(WORDS, general_words())) or _GENERAL
    return _bits(value, ranks)


def _document_words(batches):
    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(found), type=pa.string()), pa.array(list(found.values()), type=pa.int64())], names=["word", "n"])

    found: Counter[str] = Counter()
    for b in batches:
        for text in b.column(0):
            if t := text.as_py():
                found.update(set(WORD.findall(CONTEXT.sub(" ", t).lower())))
                if len(found) >= 1 << 17:
                    yield rows()
                    found.clear()
    yield rows()


def common_words(docs: DataFrame, text_col: str, most: int = MOST_WORDS) -> list[str]:
    """The commonest words of the documents, by the number of documents that hold them.

    What follows a credential key is not counted, so a leaked password is no word for being copied.
    At most ``most`` words reach the driver: the counts are first counted by size (at most 512 rows),
    and only sizes that fit as a whole are read.
    """
    scratch = Scratch(docs.sparkSession, "secret_words")
    counts = docs.select(docs[text_col]).mapInArrow(_document_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    counts = scratch.write(counts.withColumn("size", F.floor(8 * F.log2("n")).cast("int")), "counts")
    least, total = None, 0
    for r in sorted(counts.groupBy("size").count().collect(), key=lambda r: -r["size"]):
        total += r["count"]
        if total > most:
            break
        least = r["size"]
    found = [] if least is None else counts.where(F.col("size") >= least).collect()
    scratch.drop(counts)
    return [r["word"] for r in sorted(found, key=lambda r: (-r["n"], r["word"]))]


def find_secrets(text: str, min_bits: float, ranks: dict[str, int]) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, guess bits) in code points, by start and then kind."""
    out = [("assign", m.start(), m.end(), _bits(m[1], ranks)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [("access", m.start(), m.end(), 0.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), 0.0) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        value = m[m.lastindex] if m.lastindex < 3 else m[3].rstrip(".,;:)]}")
        if len(value) >= 6 and (bits := _bits(value, ranks)) >= min_bits:
            out.append(("guess", m.start(m.lastindex), m.start(m.lastindex) + len(value), bits))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def secret_spans(text: Column, ranks, min_bits: float = 32.0) -> Column:
    """Spans of secrets in a text column, as an array of (kind, start, end, bits); ``ranks`` is a broadcast of the words' ranks."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))

    @F.arrow_udf("array<struct<kind:string,start:long,end:long,bits:double>>")
    def scan(texts: pa.Array) -> pa.Array:
        found = ([] if t is None else find_secrets(t, min_bits, ranks.value) for t in texts.to_pylist())
        return pa.array([[dict(zip(("kind", "start", "end", "bits"), x, strict=True)) for x in xs] for xs in found], type=kind)

    return scan(text)


def scan_secrets(docs: DataFrame, text_col: str = "text", min_bits: float = 32.0, out: str = "secret_spans") -> DataFrame:
    """Adds ``out``, the spans of secrets in the whole text.

    Base kinds are assign, access and hex (always kept); kind ``guess`` marks values of
    credential contexts that cost ``min_bits`` or more to guess.  The words of all documents are
    counted first, in a pass of its own; the ranks broadcast are those of at most 2^16 + 33,000 words
    of up to 32 letters.  Null or empty text has no
    spans; rows are independent, so repeated rows, ties and null ids need nothing; an empty
    table stays empty; an input column named ``out`` is replaced.
    """
    ranks = ranked(WORDS, general_words(), common_words(docs, text_col))
    return docs.withColumn(out, secret_spans(docs[text_col], docs.sparkSession.sparkContext.broadcast(ranks), min_bits))
