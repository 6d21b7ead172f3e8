"""Removal of word passages that repeat across documents, on a compacted de Bruijn graph.

The graph is kept sparse: its nodes are the minimizers of 50-word windows, its edges the
spans from a minimizer to the next one, with every distinct content counted over the corpus.
A node whose occurrences all go on with one edge does not branch; paths of such nodes
compact to one repeated span, all of whose windows stand in the same documents, so that one
source document settles them together.  Only windows that reach over a branching node are
looked up one by one.  Node, edge and window identities are checked by a second hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BASES, U64, covered, grams_hash, prefix, runs_of, spans_hash, words_hash, words_of
from .blocks import (ASK, Block, answer, blocks_size, output_schema, output_table, packed, rows_table, shards_for, unpacked,
                     each_block, with_answers, write_blocks)
from .repeats import Windows, grouped, number_of
from .shared import Scratch

GRAM = 10
NODE = [np.uint64, np.int64, np.uint8, np.uint64, np.uint64]
WINDOW = [np.uint64, np.uint64, np.int64, np.uint8]


class Graph:
    """A block's part of the graph: its windows, distinct nodes and their edges."""

    def __init__(self, block: Block, window: int):
        self.window = window
        self.start, self.end, self.bounds = words_of(block.text, block.offsets)
        self.words = words_hash(block.text, self.start, self.end)
        w = self.w = Windows(grams_hash(self.words, GRAM), self.bounds, block.known, GRAM, window)
        self.ids = block.ids[w.doc[w.at]] if len(w.at) else np.zeros(0, np.int64)
        self.order, self.starts = grouped(w.hash)
        self.node = number_of(self.order, self.starts)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Per occurrence of a node the hash of its edge out and of its edge in (0: none)."""
        w = self.w
        out, into = np.zeros(len(w.at), dtype=U64), np.zeros(len(w.at), dtype=U64)
        if len(w.at) > 1:
            next_ = np.flatnonzero(w.doc[w.at][1:] == w.doc[w.at][:-1])
            label = spans_hash(prefix(self.words, BASES[1]), BASES[1], w.at[next_], w.at[next_ + 1] + GRAM) | U64(1)
            out[next_], into[next_ + 1] = label, label
        return out, into

    def ask(self, shards: int, number: int) -> list[tuple]:
        out, into = self.edges()
        o, s = self.order, self.starts
        if not len(s):
            return []
        ids = self.ids[o]
        low, high = np.minimum.reduceat(ids, s), np.maximum.reduceat(ids, s)
        return packed(self.w.hash[o][s], [low, (low != high).astype(np.uint8), _only(out[o], s), _only(into[o], s)], shards, number)

    def settle(self, payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """With the shards' answers: per window its source document's id where that is settled,
        whether it is settled, and whether it must be looked up."""
        w, n = self.w, len(self.w.start)
        flags, source = read_answers(payloads, len(self.starts))
        flags, source = flags[self.node], source[self.node]
        index = np.arange(len(w.at))
        ends = np.minimum.accumulate(np.where(flags & 2, len(w.at), index)[::-1])[::-1]
        begins = np.maximum.accumulate(np.where(flags & 4, 0, index))
        again = (flags & 1).astype(bool)[w.of] if n else np.zeros(0, bool)
        path = (self.w.start >= w.at[begins][w.of]) & (w.start + self.window <= w.at[ends][w.of] + GRAM) if n else again
        return source[w.of] if n else np.zeros(0, np.int64), again & path, again & ~path

    def lookups(self, open_: np.ndarray):
        """Distinct windows to look up -> (hash, second hash, least id, more ids?), and each window's number."""
        at = self.w.start[open_]
        a, b = grams_hash(self.words, self.window)[at], grams_hash(self.words, self.window, 1)[at]
        order, starts = grouped(a, b)
        return at, a, b, order, starts


def _only(labels: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per group its one label, or 0 if there are several."""
    low, high = np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts)
    return np.where(low == high, low, U64(0))


def read_answers(payloads: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Flags of n entries, and the source ids of those with flag 1."""
    flags, source = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.int64)
    at = 0
    for p in payloads:
        size = int(np.frombuffer(p, dtype=np.int64, count=1)[0])
        f = np.frombuffer(p, dtype=np.uint8, count=size, offset=8)
        flags[at:at + size] = f
        source[at + np.flatnonzero(f & 1)] = np.frombuffer(p, dtype=np.int64, offset=8 + size)
        at += size
    assert at == n, "an answer is missing"
    return flags, source


def _written(counts: np.ndarray, flags: np.ndarray, source: np.ndarray) -> list[bytes]:
    out, at = [], 0
    for c in counts.tolist():
        f = flags[at:at + c]
        out.append(np.int64(c).tobytes() + f.tobytes() + source[at:at + c][(f & 1) > 0].tobytes())
        at += c
    return out


def _nodes(_, payloads):
    """Of every node: does it stand in several documents, the least of them, one edge out, one edge in."""
    counts, (h, low, more, out, into) = unpacked(payloads, NODE)
    order, starts = grouped(h)
    number, ids = number_of(order, starts), low[order]
    least = np.minimum.reduceat(ids, starts)
    again = (np.maximum.reduceat(ids, starts) > least) | (np.maximum.reduceat(more[order], starts) > 0)
    flags = again * np.uint8(1) | (_only(out[order], starts) > 0) * np.uint8(2) | (_only(into[order], starts) > 0) * np.uint8(4)
    return _written(counts, flags[number], least[number])


def _windows(_, payloads):
    counts, (a, b, low, more) = unpacked(payloads, WINDOW)
    order, starts = grouped(a, b)
    number, ids = number_of(order, starts), low[order]
    least = np.minimum.reduceat(ids, starts)
    again = (np.maximum.reduceat(ids, starts) > least) | (np.maximum.reduceat(more[order], starts) > 0)
    return _written(counts, again.astype(np.uint8)[number], least[number])


def repeated_windows(blocks: DataFrame, scratch: Scratch, window: int, finish, schema) -> DataFrame:
    """``finish(block, graph, dup windows, their sources)`` of every block, with the windows that
    also start in a document of smaller id."""
    _, size = blocks_size(blocks)
    node_shards, window_shards = shards_for(size / 100), shards_for(size / 40)
    asked = scratch.write(each_block(blocks, lambda b, i: Graph(b, window).ask(node_shards, i), ASK), "nodes", "uncompressed", 4)
    nodes = scratch.write(answer(asked, _nodes), "node_answers")

    def open_windows(block: Block, number: int, payloads: list[bytes]) -> pa.Table:
        g = Graph(block, window)
        _, _, open_ = g.settle(payloads)
        at, a, b, order, starts = g.lookups(open_)
        if not len(at):
            return rows_table([], ASK)
        ids = block.ids[g.w.doc[at]][order]
        low, high = np.minimum.reduceat(ids, starts), np.maximum.reduceat(ids, starts)
        first = order[starts]
        return rows_table(packed(a[first], [b[first], low, (low != high).astype(np.uint8)], window_shards, number), ASK)

    looked = scratch.write(with_answers(blocks, nodes, open_windows, ASK), "windows", "uncompressed")
    found = answer(looked, _windows)
    scratch.drop(asked)
    # Both kinds of answers meet the block once; windows' shards are numbered after the nodes'.
    both = nodes.unionByName(found.withColumn("shard", F.col("shard") + F.lit(node_shards)))

    def last(block: Block, _, payloads: list[bytes]) -> pa.Table:
        g = Graph(block, window)
        n, at = len(g.starts), 0
        for i, p in enumerate(payloads):
            if at == n:
                break
            at += int(np.frombuffer(p, dtype=np.int64, count=1)[0])
        else:
            i = len(payloads)
        source, settled, open_ = g.settle(payloads[:i])
        own = block.ids[g.w.doc[g.w.start]] if len(g.w.start) else source
        dup = settled & (source < own)
        _, _, _, order, starts = g.lookups(open_)
        flags, least = read_answers(payloads[i:], len(starts))
        number = number_of(order, starts)
        source[open_] = least[number]
        dup[open_] = (flags[number] > 0) & (least[number] < own[open_])
        return finish(block, g, dup, source)

    return with_answers(blocks, both, last, schema)


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """Remove the words covered by a ``window``-word passage that also starts in a document of smaller id.

    Words are ``[^\\x20\\x09-\\x0D]+``; all passages are judged on the input.  Returns every row with
    its other columns, the kept words joined by one space, ``n_words``, ``n_removed`` and ``spans``
    (start word, end word, a smaller source document).  Null text has no words.  A row with null
    id neither loses words nor is a source; rows of one id don't remove each other's words,
    whether equal or not.  An empty table gives an empty table; input columns named like an
    added one are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {"n_words", "n_removed", "spans"}])
    scratch = Scratch(docs.sparkSession, "debruijn")
    blocks = write_blocks(scratch, docs, id_col, text_col)
    spans_type = "array<struct<start:long,end:long,source:long>>"
    schema = output_schema(docs, id_col, text_col, [("n_words", "long"), ("n_removed", "long"), ("spans", spans_type)])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("source", pa.int64())]))

    def finish(block: Block, g: Graph, dup: np.ndarray, source: np.ndarray) -> pa.Table:
        n = len(g.words)
        gone = covered(n, g.w.start[dup], window)
        words = np.diff(g.bounds)
        removed = np.bincount(g.w.doc[gone], minlength=len(words)) if n else np.zeros(len(words), np.int64)
        first, end = runs_of(gone, g.bounds) if n else (np.zeros(0, int),) * 2
        starts = g.w.start[dup]
        of = source[dup][np.searchsorted(starts, first)] if len(first) else first
        spans: list[list] = [[] for _ in words]
        for a, b, s in zip(first.tolist(), end.tolist(), of.tolist(), strict=True):
            d = int(g.w.doc[a])
            spans[d].append({"start": a - int(g.bounds[d]), "end": b - int(g.bounds[d]), "source": s})
        texts, raw, stop = [], block.text.tobytes(), g.bounds.tolist()
        at = block.offsets.tolist()
        for d in range(len(words)):
            if not removed[d]:
                texts.append(b" ".join(raw[at[d]:at[d + 1]].split()))
            else:
                mine = raw[at[d]:at[d + 1]].split()
                texts.append(b" ".join([w for w, x in zip(mine, gone[stop[d]:stop[d + 1]].tolist(), strict=True) if not x]))
        return output_table(block, text_col, pa.array(texts, type=pa.binary()).cast(pa.string()), {"n_words": words.astype(np.int64), "n_removed": removed.astype(np.int64)}).append_column("spans", pa.array(spans, type=arrow))

    return repeated_windows(blocks, scratch, window, finish, schema)
