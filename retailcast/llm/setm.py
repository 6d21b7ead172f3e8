"""Phrase collocations by set-oriented (SETM) relational mining.

A phrase is a run of words inside a piece of a text.  Everything is counted per language.

The *occurrence relation* R_k holds (piece, position, w_1 ... w_k) of every place where a phrase of k
words that may be frequent begins, sorted by piece and position.  It is persisted, one row of
packed columns for each block of documents, because pieces never cross blocks:

1. R_1 is read off the texts: position numbers run on over a block, with a gap between two pieces.
2. *Merge-join*: R'_k joins R_(k-1) with itself on the same piece and adjacent positions (two sorted
   columns).
3. *Group-count*: every block sends each of its distinct groups once, with its count, to the task of
   the group's hash range; the task adds up.
4. *Semi-join*: the task answers which groups are frequent; the block keeps those rows: R_k.  Only then
   the next length is built.  This count is by hash and can only be too high, so no frequent phrase is
   lost; it is a filter and not yet a result.
5. The exact counts are of the *phrases*: blocks give (language, phrase, count) rows of R_k, Spark
   adds them up, and those below the least count go.

Steps 3 and 4 move 5 bytes for each distinct group of a block.  A word in a third of all places is
one entry per block.  Rows of packed entries are never more than the entries.

Scores use decimals of 38 digits, so products beyond 64 bits stay exact.

Defined results for odd input: null text is empty; null ``lang`` is ``und``; texts and rows that repeat
count each time; a very long text is cut between two pieces or, within a piece, not at all (a
piece is held by one task); ties in the score go by count, then by the phrase's bytes; no words: no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, pow2_at_least

#: Bytes of text in a block (a task holds a block at a time).
BLOCK_BYTES = 8 << 20
#: Distinct groups of all blocks that meet in a hash range, on average.
PER_SHARD = 4_000_000

PIECE_BREAK = "[.,;:!?\\x0a-\\x0d]+"
WORD = "[ \\t]+"

RELATION = "block long, n long, words binary, at binary, codes binary"
ASK = "shard int, block long, groups binary, counts binary"
ANSWER = "block long, shard int, frequent binary"
COUNTS = "lang string, phrase string, size int, n long"

_RELATION = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("words", pa.binary()), ("at", pa.binary()), ("codes", pa.binary())])
_ASK = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("groups", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("frequent", pa.binary())])
_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _words_bytes(lang: pa.Array, word: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    t = pa.table({"lang": lang, "word": word})
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


class Relation:
    """R_k of a block: distinct words (with their language), positions, and k word codes for each row."""

    def __init__(self, row: dict, k: int):
        t = pa.ipc.open_stream(row["words"]).read_all()
        self.block = row["block"]
        self.lang, self.word = t.column("lang").combine_chunks(), t.column("word").combine_chunks()
        self.at = np.cumsum(_unpacked(row["at"], np.uint32), dtype=np.int64)
        self.codes = _unpacked(row["codes"], np.int32).reshape(k, -1)

    def row(self, keep: np.ndarray) -> tuple:
        """The rows that ``keep`` marks, with the words that they still use."""
        codes = self.codes[:, keep]
        in_use = np.zeros(len(self.word), dtype=bool)
        in_use[codes] = True
        take = pa.array(np.flatnonzero(in_use))
        return _relation_row(self.block, self.lang.take(take), self.word.take(take), self.at[keep], (np.cumsum(in_use) - 1)[codes])

    def joined(self) -> Relation:
        """The merge-join with itself on piece and adjacent position: one word more."""
        near = np.flatnonzero(self.at[1:] == self.at[:-1] + 1)
        out = object.__new__(Relation)
        out.block, out.lang, out.word = self.block, self.lang, self.word
        out.at = self.at[near]
        out.codes = np.concatenate([self.codes[:, near], self.codes[-1:, near + 1]])
        return out

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of (language, phrase): for each row, or of k = 1 for each word."""
        lang = pd.util.hash_array(self.lang.to_numpy(zero_copy_only=False), categorize=True)
        words = mixed(pd.util.hash_array(self.word.to_numpy(zero_copy_only=False), categorize=False) + np.uint64(3) * lang)
        if len(self.codes) == 1:
            return words
        h = words[self.codes[0]]
        for codes in self.codes[1:]:
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[codes])
        return h

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of (language, phrase), for each row the place of its own, and how many rows each has."""
        groups, of_row = np.unique(self.hashes(), return_inverse=True)
        of_row = of_row[self.codes[0]] if len(self.codes) == 1 else of_row
        return groups, of_row, np.bincount(of_row, minlength=len(groups))

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """One row of each distinct phrase, and the phrases' counts (by their words, not by a hash)."""
        of_row = self.codes[0].astype(np.int64)
        for codes in self.codes[1:]:
            _, of_row = np.unique(of_row * len(self.word) + codes, return_inverse=True)
        counts = np.bincount(of_row)
        one = np.empty(len(counts), dtype=np.int64)
        one[of_row] = np.arange(len(of_row))
        return one[counts > 0], counts[counts > 0]


def _relation_row(block: int, lang: pa.Array, word: pa.Array, at: np.ndarray, codes: np.ndarray) -> tuple:
    return block, len(at), _words_bytes(lang, word), _packed(np.diff(at, prepend=0).astype(np.uint32)), _packed(codes.astype(np.int32))


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the hash depends on all the others (so that ranges of it are even)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _first_relation(block_bytes: int):
    """Texts -> R_1 of blocks of about ``block_bytes``."""

    def read(batches):
        task, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal seq, held, size
            rel = _occurrences((task << 24) | seq, held)
            held, size, seq = [], 0, seq + 1
            return rel

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                held.append((lang, text))
                size += len(text)
                if size >= block_bytes:
                    yield flush()
        if held:
            yield flush()

    return read


def _occurrences(block: int, rows: list[tuple[str, str]]) -> pa.RecordBatch:
    langs = pa.array([r[0] for r in rows])
    texts = pc.ascii_lower(pa.array([r[1] for r in rows], type=pa.large_string()))
    pieces = pc.split_pattern_regex(texts, PIECE_BREAK)
    of_piece = pc.list_parent_indices(pieces)
    words = pc.split_pattern_regex(pc.list_flatten(pieces), WORD)
    of_word = pc.list_parent_indices(words).to_numpy()
    flat = pc.list_flatten(words)
    there = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    flat, of_word = flat.filter(pa.array(there)), of_word[there]
    lang = pc.dictionary_encode(langs.take(of_piece.take(pa.array(of_word))))
    word = pc.dictionary_encode(flat)
    # One code for each (language, word) of the block.
    n_words = max(1, len(word.dictionary))
    pair = lang.indices.to_numpy().astype(np.int64) * n_words + word.indices.to_numpy()
    used, codes = np.unique(pair, return_inverse=True)
    at = np.arange(len(codes), dtype=np.int64) + of_word.astype(np.int64)  # a step of 2 or more between pieces
    own = _relation_row(block, lang.dictionary.take(pa.array(used // n_words)).cast(pa.string()), word.dictionary.take(pa.array(used % n_words)).cast(pa.string()), at, codes)
    return _table([own], _RELATION).to_batches()[0]


def _rows(batches, k: int) -> Iterator[Relation]:
    for b in batches:
        for i in range(b.num_rows):
            yield Relation(b.slice(i, 1).to_pylist()[0], k)


def _ask(k: int, joined: bool, shards: int, least: int):
    bits = shards.bit_length() - 1

    def ask(batches):
        for rel in _rows(batches, k - 1 if joined else k):
            rel = rel.joined() if joined else rel
            groups, _, counts = rel.groups()
            cuts = _cuts(groups, bits)
            low = (groups >> np.uint64(32 - bits) & np.uint64(0xFFFFFFFF)).astype(np.uint32)  # the 32 bits below the shard's
            few = np.minimum(counts, min(least, 255)).astype(np.uint8)
            rows = [(s, rel.block, low[a:b].tobytes(), few[a:b].tobytes()) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            for i in range(0, len(rows), 256):
                yield from _table(rows[i:i + 256], _ASK).to_batches()

    return ask


def _cuts(groups: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.array([0, len(groups)])
    return np.concatenate([[0], np.searchsorted(groups, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), [len(groups)]])


def _count(least: int):
    """Add up the counts of a hash range; a bit for each group of each block: frequent or not.

    A block's count is cut off at the least count, above which it no longer matters."""

    def count(t: pa.Table) -> pa.Table:
        blocks = t.column("block").to_pylist()
        sent = [np.frombuffer(x, dtype=np.uint32) for x in t.column("groups").to_pylist()]
        groups = np.concatenate(sent)
        counts = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in t.column("counts").to_pylist()])
        order = np.argsort(groups, kind="stable")
        s = groups[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        enough = np.add.reduceat(counts[order].astype(np.int64), first) >= min(least, 255)
        back = np.empty(len(groups), dtype=bool)
        back[order] = np.repeat(enough, np.diff(np.append(first, len(s))))
        cuts, shard = np.cumsum([0, *map(len, sent)]), t.column("shard")[0].as_py()
        return _table([(b, shard, np.packbits(back[x:y]).tobytes()) for b, x, y in zip(blocks, cuts[:-1], cuts[1:], strict=True)], _ANSWER)

    return count


def _semi_join(k: int, joined: bool, shards: int):
    """A block's rows of frequent groups: R_k."""
    bits = shards.bit_length() - 1

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _RELATION.empty_table()
        rel = Relation(left.to_pylist()[0], k - 1 if joined else k)
        rel = rel.joined() if joined else rel
        groups, of_row, _ = rel.groups()
        cuts, frequent = _cuts(groups, bits), np.zeros(len(groups), dtype=bool)
        for shard, marks in zip(right.column("shard").to_pylist(), right.column("frequent").to_pylist(), strict=True):
            a, b = cuts[shard], cuts[shard + 1]
            frequent[a:b] = np.unpackbits(np.frombuffer(marks, dtype=np.uint8), count=b - a)
        return _table([rel.row(frequent[of_row])], _RELATION)

    return keep


def _phrases(k: int):
    """Counts of a block's phrases of k words."""

    def count(batches):
        for rel in _rows(batches, k):
            if not len(rel.at):
                continue
            one, counts = rel.phrases()
            columns = [rel.word.take(pa.array(codes[one])) for codes in rel.codes]
            phrase = pc.binary_join_element_wise(*columns, " ") if k > 1 else columns[0]
            t = pa.table([rel.lang.take(pa.array(rel.codes[0][one])), phrase, pa.array(np.full(len(one), k), type=pa.int32()), pa.array(counts.astype(np.int64))], schema=_COUNTS)
            yield from t.to_batches(max_chunksize=10_000)

    return count


def _lang_words(batches):
    """Words of a block by language."""
    for rel in _rows(batches, 1):
        lang = rel.lang.take(pa.array(rel.codes[0]))
        for x in pc.value_counts(lang).to_pylist():
            yield _table([(x["values"], "", 0, x["counts"])], _COUNTS).to_batches()[0]


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 4, least: int = 30, block_bytes: int = BLOCK_BYTES, per_shard: int = PER_SHARD) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with ``least`` occurrences or more, as ``lang, phrase, size, n``
    (exact), and the number of words of each language, as ``lang, n``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "setm")
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    relation = scratch.write(texts.mapInArrow(_first_relation(block_bytes), RELATION), "occurrences", codec="uncompressed", batch_rows=256)
    words = relation.mapInArrow(_lang_words, COUNTS).groupBy("lang").agg(F.sum("n").alias("n"))
    counts = None
    for k in range(1, longest + 1):
        # Groups are at most the rows of the relation that is joined.
        rows = relation.agg(F.sum("n")).first()[0] or 0
        shards = pow2_at_least(rows / per_shard)
        asked = relation.mapInArrow(_ask(k, k > 1, shards, least), ASK)
        answers = asked.groupBy("shard").applyInArrow(_count(least), ANSWER)
        kept = relation.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_semi_join(k, k > 1, shards), RELATION)
        relation = scratch.write(kept, f"relation_{k}", codec="uncompressed")
        found = relation.mapInArrow(_phrases(k), COUNTS)
        counts = found if counts is None else counts.unionByName(found)
    phrases = counts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return scratch.write(phrases, "phrases"), words


def _part(words: Column, start: int, size: int) -> Column:
    """Words ``start`` (from 1) to ``start + size - 1``, joined."""
    return F.array_join(F.slice(words, start, size), " ")


def score_cuts(phrases: DataFrame, longest: int = 4) -> DataFrame:
    """Candidates (two words and more) with their lowest-scoring cut: ``lang, phrase, size, a, k, l, r, score``.

    Every part of a frequent phrase is frequent, so both parts' counts are found in ``phrases``.
    """
    words = F.split("phrase", " ")
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cuts = phrases.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": _part(words, 1, F.col("k")), "rest": _part(words, F.col("k") + 1, F.col("size"))})
    both = (cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    big = "cast({} AS decimal(20,0))".format
    score = F.expr(f"({big('a')} * cast(2000000 AS decimal(7,0))) div ({big('l')} + {big('r')})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "size", "a").agg(best).select("lang", "phrase", "size", "a", "cut.k", "cut.l", "cut.r", "cut.score")


def covered(phrases: DataFrame) -> DataFrame:
    """Phrases that a longer one with 80 % of their count or more holds: ``lang, phrase``."""
    words = F.split("phrase", " ")
    inner = [(start, size) for size in (2, 3) for start in (1, 2, 3)]
    spans = F.filter(F.array(*[F.struct(F.lit(a).alias("start"), F.lit(s).alias("len")) for a, s in inner]),
                     lambda x: (x["start"] + x["len"] - 1 <= F.col("size")) & (x["len"] < F.col("size")))
    held = phrases.where("size > 2").select("lang", "phrase", "n", F.explode(spans).alias("s")).select("lang", F.array_join(F.slice(words, F.col("s.start"), F.col("s.len")), " ").alias("phrase"), "n")
    most = held.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    return phrases.join(most, ["lang", "phrase"]).where("cast(longer AS decimal(20,0)) * 100 >= cast(n AS decimal(20,0)) * 80").select("lang", "phrase")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000, **sizes) -> DataFrame:
    """Each language's first ``top`` collocations: ``lang, rank, phrase, a, l, r, n, score``."""
    phrases, words = mine(docs, text_col, lang_col, 4, least, **sizes)
    left = score_cuts(phrases).join(covered(phrases), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    first = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
