"""Best-fit packing of token sequences, certified by dual-feasible lower bounds.

Pieces are dealt into partitions of bounded size; each packs its own by best-fit
decreasing and bounds its bin count from below by dual-feasible functions.  A partition
that meets its bound is done.  The others hand over their bins with room; these are dealt
anew, whole bins together, and packed again with strangers' documents; a group that saves
no bin keeps the bins it got.
"""

from __future__ import annotations

import os
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

PIECE = [("doc_id", "long"), ("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")]
PLACED = [("sequence_id", "long"), ("offset", "long"), ("gap", "long"), ("open", "boolean"), ("saved", "long")]
_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
KEEP_WORDS = 1_600_000  # in a worker: some 300 MB


def _schema(columns) -> str:
    return ", ".join(f"{n} {k}" for n, k in columns)


class _Words:
    """Token ids (little-endian uint32) of words, kept in two generations of the words seen last."""

    def __init__(self, text: str):
        import tokenizers
        self.tokenizer = tokenizers.Tokenizer.from_str(text)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a piece
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # The rarest short word of one id: it stands between others, to tell them apart again.
        whole = sorted((-i, t[:-4]) for t, i in vocabulary.items() if len(t) == 8 and t.endswith("</w>") and t[:4].isascii() and t[:4].isalpha() and t[:4].islower())
        self.mark, self.mark_id = next(((f" {t} ", int(ids[0])) for _, t in whole if len(ids := self._ids([t])[0]) == 1), ("", -1))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[bytes], between: str) -> list[bytes]:
        """Learn words, many at a time -> those that are still to do.

        White space separates words, so each has the ids that it has alone.  Words of letters alone
        are one piece each, and the count of ids that end a piece proves it; between others stands
        the mark, and the count of marks proves that none of them holds it.
        """
        left: list[bytes] = []
        chunks = [words[i:i + 256] for i in range(0, len(words), 256)]
        for chunk, ids in zip(chunks, self._ids([b"\n".join(c).decode().replace("\n", between) for c in chunks]), strict=True):
            if between == " ":
                ends = np.flatnonzero(self.ends[ids]) + 1
                starts = ends - np.diff(ends, prepend=0)
                proved = len(ends) == len(chunk) and ends[-1] == len(ids)
            else:
                marks = np.flatnonzero(ids == self.mark_id)
                starts, ends = np.append(0, marks + 1), np.append(marks, len(ids))
                proved = len(ends) == len(chunk)
            if proved:
                raw = ids.tobytes()
                self.young.update((w, raw[i:j]) for w, i, j in zip(chunk, (4 * starts).tolist(), (4 * ends).tolist(), strict=True))
            else:
                left += chunk
        return left

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of all ``words`` (and of others)."""
        if len(self.young) > KEEP_WORDS // 2:
            self.old, self.young = self.young, {}
        new = words - self.young.keys()
        again = new & self.old.keys()
        self.young.update(zip(again, map(self.old.__getitem__, again), strict=True))
        letters: list[bytes] = []
        others: list[bytes] = []
        for w in new - again:
            (letters if w.isalpha() or w.decode().isalpha() else others).append(w)
        alone = self._together(letters, " ")
        alone += self._together(others, self.mark) if self.mark else others
        self.young.update((w, ids.tobytes()) for w, ids in zip(alone, self._ids([w.decode() for w in alone]), strict=True))
        return self.young


def _loaded(text: str) -> _Words:
    """The tokenizer of this worker process, built once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers
    kept = tokenizers.__dict__.setdefault("_loaded_by_text", {})
    key = zlib.crc32(text.encode())
    if key not in kept:
        kept[key] = _Words(text)
    return kept[key]


def forget_words() -> None:
    """Give up the tokenizers and words that this worker process keeps; they are built again when asked for."""
    if "tokenizers" in sys.modules:
        sys.modules["tokenizers"].__dict__.pop("_loaded_by_text", None)


def _by_bytes(texts: pa.Array, most: int) -> list[tuple[int, int]]:
    """Ranges of rows whose texts have some ``most`` bytes together (one text at least)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    part = ends // most
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(ends)]
    return [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def _cutter(spec, most: int, end_id: int, with_ids: bool):
    """Token ids of documents, cut into pieces of at most ``most``.

    The tokenizer drops white space and never joins across it, so a text's ids are its words'
    ids end to end.  It drops case, too, and a mark after letters is a piece of its own, so marks
    are set apart first: fewer words differ.
    """
    columns = PIECE + [("ids", "binary")] * with_ids
    ending = re.compile(rb"([.,])(?<=[a-z].)(?=[\x20\x09-\x0D]|\Z)")

    def cut(batches):
        words = _loaded(spec.value)
        last = np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            for first, end in _by_bytes(texts, 4 << 20):
                own = [t or b"" for t in texts.slice(first, end - first).to_pylist()]
                # Special tokens look like <|this|>, in one case only.
                raw = [ending.sub(rb" \1", t if b"<|" in t else t.lower()).split() for t in own]
                known = words.learn(set().union(*raw))
                rows: list[tuple] = []
                for doc, ws in zip(b.column("doc_id").slice(first, end - first).to_pylist(), raw, strict=True):
                    ids = b"".join(map(known.__getitem__, ws)) + last
                    for i in range(0, len(ids), 4 * most):
                        piece = ids[i:i + 4 * most]
                        rows.append((doc, i // (4 * most), i // 4, len(piece) // 4, zlib.crc32(piece), piece)[:len(columns)])
                yield pa.RecordBatch.from_arrays([pa.array(c, type=_ARROW[k]) for c, (_, k) in zip(zip(*rows, strict=True), columns, strict=True)], names=[n for n, _ in columns])

    return cut, columns


def lower_bound(lengths: np.ndarray, most: int) -> int:
    """Bins that any packing needs: the best of two families of dual-feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=most + 1).astype(np.int64)
    sizes = np.arange(most + 1)
    number, total = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * sizes)])
    e = np.arange(most // 2 + 1)  # below e: 0, above most - e: a whole bin
    best = int((number[-1] - number[most - e + 1] + -(-(total[most - e + 1] - total[e]) // most)).max())
    for k in range(1, 30):  # x -> floor((k + 1) x) / k, and x itself where (k + 1) x is whole
        whole, rest = np.divmod((k + 1) * sizes, most)
        value = np.where(rest == 0, sizes * k, whole * most)  # times k * most
        best = max(best, -(-int((value * count).sum()) // (k * most)))
    return best


def best_fit_decreasing(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every piece, and the number of bins; longest first, into the fullest bin with room."""
    bins, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    free: list[list[int]] = [[] for _ in range(most + 1)]  # bins by room
    have, used = 0, 0  # bit r: there are bins with room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = have >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                have &= ~(1 << room)
        else:
            b, used, room = used, used + 1, most
        bins[i], offset[i] = b, most - room
        room -= n
        if room:
            free[room].append(b)
            have |= 1 << room
    return bins, offset, used


def _packer(most: int, round_: int):
    """Pack a group again; bins that got no better stay as they came."""

    def pack(t: pa.Table) -> pa.Table:
        lengths = t.column("length").to_numpy()
        had = t.column("sequence_id").to_numpy()
        group = int(t.column("group")[0].as_py())
        bins, offset, used = best_fit_decreasing(lengths, most)
        sequence = (round_ << 54) + (group << 28) + bins
        least = lower_bound(lengths, most)
        before = len(np.unique(had)) if round_ else used + 1
        saved = np.zeros(len(lengths), dtype=np.int64)
        if used >= before:
            sequence, offset, used = had, t.column("offset").to_numpy(), before
        else:
            saved[0] = before - used
        open_ = np.zeros(len(lengths), dtype=bool)
        if used > least:
            _, at = np.unique(sequence, return_inverse=True)
            open_ = (np.bincount(at, weights=lengths) < most)[at]
        # A full bin wastes nothing, so the gap is that of the bins with room.
        gap = np.where(open_, used - least, 0)
        out = t.select([c for c in t.column_names if c not in ("group", "sequence_id", "offset")])
        for (n, _), v in zip(PLACED, (sequence, offset, gap, open_, saved), strict=True):
            out = out.append_column(n, pa.array(v))
        return out

    return pack


def pack_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048, end_id: int = 0, with_ids: bool = True, group_size: int = 25_000) -> DataFrame:
    """Pack every document's token ids (and ``end_id`` at its end) into sequences of at most ``max_tokens``.

    Only documents longer than that are cut, into pieces of ``max_tokens``; the last may be
    shorter.  Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, gap, and with ``with_ids`` the ids (little-endian uint32).  ``gap`` is the number of bins
    by which the group that placed the piece's bin exceeds its lower bound; 0: the bin is full, or its
    group is certified to have as few as any packing.  Null text is empty: a piece of ``end_id`` alone.  Null or repeated ids are documents of their own; equal lengths go in
    any order.  An empty table gives an empty table; other columns are not read.
    ``group_size`` bounds what one task packs.  Groups with a gap exchange their bins with room until
    an exchange saves no bin.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    cut, columns = _cutter(spec, max_tokens, end_id, with_ids)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    pieces = texts.mapInArrow(cut, _schema(columns)).withColumn("row", F.monotonically_increasing_id())
    pieces = scratch.write(pieces, "pieces", batch_rows=1000)
    out = [n for n, _ in columns]
    placed = _schema(columns + PLACED)
    zero = F.lit(0).cast("long")
    whole = pieces.where(F.col("length") == max_tokens).select(*out, (-1 - F.col("row")).alias("sequence_id"), zero.alias("offset"), zero.alias("gap"))
    pool = pieces.where(F.col("length") < max_tokens).select(*out, F.col("row").alias("sequence_id"), zero.alias("offset"))
    done, n, round_ = [whole], pool.count(), 0
    while True:
        groups = max(1, -(-n // group_size))
        dealt = pool.withColumn("group", F.pmod(F.xxhash64("sequence_id", F.lit(round_)), F.lit(groups)))
        packed = scratch.write(dealt.groupBy("group").applyInArrow(_packer(max_tokens, round_), placed), f"round_{round_}")
        saved, n = packed.agg(F.sum("saved"), F.count_if("open")).first()
        closed = packed.drop("open", "saved")
        if not (n and saved and groups > 1):
            done.append(closed)
            break
        done.append(closed.where(~packed["open"]))
        pool, round_ = packed.where("open").drop("open", "saved", "gap"), round_ + 1
        assert round_ < 512, "the sequence ids have no room for another round"
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result
