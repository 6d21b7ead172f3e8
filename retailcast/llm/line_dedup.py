"""Line dedup with a sharded minimal perfect hash over distinct line hashes.

Blocks of documents name their distinct line keys to hash shards.  A shard counts them as
they stream in and writes one index row: a minimal perfect hash over its distinct keys with
compact arrays of fingerprints, document counts and last documents.  The counted keys are
gone after that.  The blocks' lines then probe the written arrays, shard by shard; a hit is a
line whose fingerprint is the one in its slot and whose count there is large enough.  Rows of
a shard are streamed in both steps, so a line that every block holds costs one entry for each
block and no memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, mix
from .blocks import ASK, Block, arrow_rows, blocks_size, each_block, output_schema, output_table, shard_bounds, shards_for, with_answers, write_blocks
from .shared import Scratch

NAMED = "shard int, block long, payload binary, seen binary"
INDEX = "shard int, sizes array<long>, bits binary, fingerprints binary, counts binary, newest binary"
MERGE = 1 << 20  # entries that a shard's task holds before it adds them up
MOST = 2**32 - 1


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys (pairs of uint64).

    Level by level, keys that are alone in their slot of a bit array get that slot;
    the others go on to the next level.  ``slot`` maps every key to its own number
    below the number of keys; other keys get any number or -1.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, room: float = 1.5):
        levels = []
        while len(a):
            m = max(8, int(room * len(a)))
            at = self._at(a, b, len(levels) + 1, m)
            levels.append(np.bincount(at, minlength=m) == 1)
            rest = ~levels[-1][at]
            a, b = a[rest], b[rest]
        self._rank(levels)

    def _rank(self, levels: list[np.ndarray]) -> None:
        self.levels, self.size = [], 0
        for alone in levels:
            self.levels.append((alone, np.cumsum(alone) - 1 + self.size))
            self.size += int(alone.sum())

    def packed(self) -> tuple[list[int], bytes]:
        """Sizes of the levels and their bits, each level filled up to whole bytes."""
        return [len(alone) for alone, _ in self.levels], b"".join(np.packbits(alone).tobytes() for alone, _ in self.levels)

    @classmethod
    def unpacked(cls, sizes: list[int], bits: bytes) -> "PerfectHash":
        out, levels, begin = cls.__new__(cls), [], 0
        for m in sizes:
            n = (m + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(bits, np.uint8, n, begin), count=m).astype(bool))
            begin += n
        out._rank(levels)
        return out

    @staticmethod
    def _at(a, b, seed, m):
        return (mix(a + b * U64(2 * seed + 1) + U64(seed)) % U64(m)).astype(np.int64)

    def slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, dtype=np.int64)
        left = np.arange(len(a))
        for i, (alone, rank) in enumerate(self.levels):
            at = self._at(a[left], b[left], i + 1, len(alone))
            hit = alone[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


class LineIndex:
    """A perfect hash with the fingerprint, the document count and the last document in each slot."""

    def __init__(self, table: PerfectHash, fingerprints: np.ndarray, counts: np.ndarray, newest: np.ndarray):
        self.table, self.fingerprints, self.counts, self.newest = table, fingerprints, counts, newest

    @classmethod
    def over(cls, a: np.ndarray, b: np.ndarray, n: np.ndarray, last: np.ndarray) -> "LineIndex":
        """Index of distinct keys (a, b) in n documents each, the largest id of them ``last``."""
        table = PerfectHash(a, b)
        slot, size = table.slot(a, b), table.size
        out = cls(table, np.zeros(size, "<u8"), np.zeros(size, "<u4"), np.zeros(size, "<i8"))
        out.fingerprints[slot], out.counts[slot], out.newest[slot] = a ^ b, np.minimum(n, MOST), last
        return out

    def row(self, shard: int) -> tuple:
        return (shard, *self.table.packed(), self.fingerprints.tobytes(), self.counts.tobytes(), self.newest.tobytes())

    @classmethod
    def read(cls, row: dict) -> "LineIndex":
        return cls(PerfectHash.unpacked(row["sizes"], row["bits"]), np.frombuffer(row["fingerprints"], "<u8"), np.frombuffer(row["counts"], "<u4"), np.frombuffer(row["newest"], "<i8"))

    def probe(self, a: np.ndarray, b: np.ndarray, min_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are in ``min_docs`` or more documents, and the last document of each of those."""
        slot = self.table.slot(a, b)
        hit = slot >= 0
        hit[hit] = (self.fingerprints[slot[hit]] == a[hit] ^ b[hit]) & (self.counts[slot[hit]] >= min_docs)
        return hit, self.newest[slot[hit]]


def _keys(raw: bytes, min_chars: int) -> list[bytes | None]:
    """Per line the 16-byte digest of its key, or None if the key is too short to count."""
    out = []
    for line in raw.split(b"\n"):
        k = line.strip()
        if len(k) < min_chars or (len(k) < 4 * min_chars and not k.isascii() and sum((c & 0xC0) != 0x80 for c in k) < min_chars):
            out.append(None)
        else:
            out.append(hashlib.blake2b(k.lower(), digest_size=16).digest())
    return out


def _sorted_digests(found) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    order = sorted(found)
    pairs = np.frombuffer(b"".join(order), dtype=">u8").reshape(-1, 2).astype(np.uint64) if order else np.zeros((0, 2), dtype=np.uint64)
    return order, pairs[:, 0], pairs[:, 1]


def _asker(min_chars: int, shards: int):
    def ask(block: Block, number: int):
        found: dict[bytes, list] = {}
        for raw, doc, known in zip(block.texts(), block.ids.tolist(), block.known.tolist(), strict=True):
            if known:
                for d in set(_keys(raw, min_chars)) - {None}:
                    x = found.setdefault(d, [0, doc])
                    x[0] += 1
                    x[1] = max(x[1], doc)
        order, a, b = _sorted_digests(found)
        n = np.array([found[d][0] for d in order], dtype="<u4")
        last = np.array([found[d][1] for d in order], dtype="<i8")
        at = shard_bounds(a, shards).tolist()
        return [(s, number, a[x:y].tobytes() + b[x:y].tobytes(), n[x:y].tobytes() + last[x:y].tobytes())
                for s, (x, y) in enumerate(zip(at[:-1], at[1:], strict=True)) if y > x]

    return ask


def _named(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(payload) // 16
    return np.frombuffer(payload, "<u8", n), np.frombuffer(payload, "<u8", n, 8 * n)


def _added(held: list[tuple]) -> tuple:
    """Distinct keys of (a, b, n, last) pieces, their counts added up and their largest last."""
    a, b, n, last = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    at = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return a[at], b[at], np.add.reduceat(n[order].astype(np.int64), at), np.maximum.reduceat(last[order], at)


def _index_shards(batches) -> Iterator[pa.RecordBatch]:
    """One index row for each shard, from rows in the order of their shards."""
    shard, held, size, limit = None, [], 0, MERGE
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard and held:
                yield from arrow_rows([LineIndex.over(*_added(held)).row(shard)], INDEX)
                held, size, limit = [], 0, MERGE
            shard = row["shard"]
            a, b = _named(row["payload"])
            held.append((a, b, np.frombuffer(row["seen"], "<u4", len(a)), np.frombuffer(row["seen"], "<i8", len(a), 4 * len(a))))
            size += len(a)
            if size >= limit:
                held = [_added(held)]
                size = len(held[0][0])
                limit = max(MERGE, 2 * size)
    if held:
        yield from arrow_rows([LineIndex.over(*_added(held)).row(shard)], INDEX)


def _probe_shards(min_docs: int):
    """Answers to rows in the order of their shards, after the index row (null block) of each shard."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        index, of = None, None
        for batch in batches:
            out = []
            for shard, rows in groupby(batch.to_pylist(), key=lambda r: r["shard"]):
                rows = list(rows)
                if rows[0]["block"] is None:
                    index, of = LineIndex.read(rows[0]), shard
                    del rows[0]
                if not rows:
                    continue
                if of != shard:
                    raise ValueError(f"shard {shard} has no index")
                keys = [_named(r["payload"]) for r in rows]
                hit, newest = index.probe(*(np.concatenate(c) for c in zip(*keys, strict=True)), min_docs)
                ends = np.cumsum([len(a) for a, _ in keys])
                hits = np.concatenate([[0], np.cumsum(hit)])[ends].tolist()
                begin = first = 0
                for r, end, last in zip(rows, ends.tolist(), hits, strict=True):
                    out.append((shard, r["block"], hit[begin:end].tobytes() + newest[first:last].tobytes()))
                    begin, first = end, last
            yield from arrow_rows(out, ASK)

    return run


def _by_shard(rows: DataFrame) -> DataFrame:
    return rows.repartition("shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first())


def line_index(scratch: Scratch, named: DataFrame) -> DataFrame:
    """The written index of all named keys, a row for each shard that has any."""
    return scratch.write(_by_shard(named).mapInArrow(_index_shards, INDEX), "index", batch_rows=64)


def probed(scratch: Scratch, named: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """To each (shard, block) row which of its keys are in ``min_docs`` documents, and their last ones."""
    rows = index.withColumn("block", F.lit(None).cast("long")).unionByName(named.select("shard", "block", "payload"), allowMissingColumns=True)
    return scratch.write(_by_shard(rows).mapInArrow(_probe_shards(min_docs), ASK), "answers", batch_rows=64)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """Drop lines whose key stands in ``min_docs`` or more documents, but in the largest id.

    A key is the line without white space at its ends, A-Z lower-cased, of at least
    ``min_chars`` code points.  Returns every row of ``docs`` with its other columns, the text
    of the lines that stay (joined by a newline), ``n_lines`` (before) and ``n_dropped``.
    Null text counts as one empty line and comes back empty.  A row with null id keeps all
    its lines and counts for no key.  Rows are documents: repeated rows count each, and all
    rows of the largest id keep their lines.  An empty table gives an empty table.  Input
    columns named like an added one are replaced.
    """
    extra = [("n_lines", "long"), ("n_dropped", "long")]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {"n_lines", "n_dropped"}])
    scratch = Scratch(docs.sparkSession, "line_dedup")
    blocks = write_blocks(scratch, docs, id_col, text_col)
    _, size = blocks_size(blocks)
    shards = shards_for(size / 300)
    named = scratch.write(each_block(blocks, _asker(min_chars, shards), NAMED), "named", batch_rows=4)
    answers = probed(scratch, named, line_index(scratch, named), min_docs)

    def finish(block: Block, _, payloads):
        digests = [_keys(raw, min_chars) for raw in block.texts()]
        order, a, _b = _sorted_digests({d for ks, known in zip(digests, block.known.tolist(), strict=True) if known for d in ks} - {None})
        newest: dict[bytes, int] = {}
        begin, sizes = 0, [x for x in np.diff(shard_bounds(a, shards)).tolist() if x]
        for n, p in zip(sizes, payloads, strict=True):
            hit = np.flatnonzero(np.frombuffer(p, dtype=bool, count=n)) + begin
            newest.update(zip((order[i] for i in hit.tolist()), np.frombuffer(p, dtype=np.int64, offset=n).tolist(), strict=True))
            begin += n
        texts, lines, dropped = [], [], []
        for raw, ks, doc, known in zip(block.texts(), digests, block.ids.tolist(), block.known.tolist(), strict=True):
            kept = [x for x, k in zip(raw.split(b"\n"), ks, strict=True) if not known or newest.get(k, doc) == doc]
            texts.append(b"\n".join(kept))
            lines.append(len(ks))
            dropped.append(len(ks) - len(kept))
        return output_table(block, text_col, pa.array(texts, type=pa.binary()).cast(pa.string()), {"n_lines": np.array(lines, dtype=np.int64), "n_dropped": np.array(dropped, dtype=np.int64)})

    return with_answers(blocks, answers, finish, output_schema(docs, id_col, text_col, extra))
