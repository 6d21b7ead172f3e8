"""Exact dedup by a tree-merge of sorted digest runs.

Two texts are equal when they are identical after replacing each ``[\\x20\\x09-\\x0D]+``
by one space (a null text is an empty one).

* Every task turns its documents into *runs*: at most ``run_rows`` digests, sorted, equal ones
  merged into one entry (smallest id, its row, number of rows).  A text that a third of all
  documents share is one entry of each run.
* The runs are exchanged in rounds of a binomial tree with ``FAN`` branches.  There are ``FAN ** n``
  places.  In round i, the places that differ only in their i-th digit exchange: each splits its run
  by the i-th digit of the digest, keeps its own part and sends the other parts on; what
  arrives is merged, several ways at once.  After n rounds every place holds the entries of one
  digest range, merged over all runs, and each entry has moved n times.  A round makes
  ``FAN`` rows for a place, so the rows grow with the number of runs and not with its square.
* Entries merge only if they are *verified*: the whole SHA-256, a second 64-bit hash and the
  length in bytes must agree.  The smallest identifier of the verified entries stays.
* The answers (smallest id, its row, number of rows) go back down the same tree, so no row is
  joined by digest and no digest is hot.

Every level is written to the shared folder, in the form of packed rows.

Defined results for odd input: a null id sorts after all others (``keep_id`` is null only if all
rows of a group have none); of several rows with the smallest id (repeated rows) exactly one is
kept; null, empty and white-space-only texts are texts like others (null and '' are equal, ' ' is
another one); texts of any length are hashed whole inside Spark; an empty table gives an empty
result; other columns may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, free_name

#: Branches of the exchange tree.
FAN = 8
#: Documents in a run.
RUN_ROWS = 1 << 17

#: An entry: four words of the SHA-256 (big-endian, so that they sort as its bytes), second hash,
#: length, then id (null: the largest), whether it is known, the row, and how many rows.
ENTRY = np.dtype([("a", "<u8"), ("b", "<u8"), ("c", "<u8"), ("d", "<u8"), ("x", "<u8"), ("n", "<i8"), ("id", "<i8"), ("no_id", "u1"), ("row", "<i8"), ("count", "<i8")])
ANSWER = np.dtype([("id", "<i8"), ("no_id", "u1"), ("row", "<i8"), ("count", "<i8")])
VERIFIED = ("a", "b", "c", "d", "x", "n")

MEMBERS = "run long, rows binary"
PIECES = "place long, sender long, part int, entries binary"
ANSWERS = "receiver long, part int, entries binary"


def normalised(text: Column | str) -> Column:
    """The text with each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _runs(run_rows: int):
    """Digest rows -> packed runs; a run's number is its task's number, times 2^24, plus its place in the task."""

    def pack(batches):
        task, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal seq, held, size
            t = pa.Table.from_batches(held)
            sha = np.frombuffer(b"".join(t.column("sha").to_pylist()), dtype=">u8").reshape(-1, 4)
            rows = np.zeros(t.num_rows, dtype=ENTRY)
            for i, name in enumerate("abcd"):
                rows[name] = sha[:, i]
            rows["x"] = t.column("second").to_numpy().view(np.uint64)
            rows["n"] = t.column("bytes").to_numpy()
            ids = t.column("id").combine_chunks()
            rows["no_id"] = ids.is_null().to_numpy(zero_copy_only=False)
            rows["id"] = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            run = (task << 24) | seq
            rows["row"] = t.column("row").to_numpy()
            rows["count"] = 1
            held, size, seq = [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([run], type=pa.int64()), pa.array([rows.tobytes()], type=pa.binary())], names=["run", "rows"])

        for b in batches:
            at = 0
            while at < b.num_rows:
                part = b.slice(at, run_rows - size)
                held.append(part)
                size += part.num_rows
                at += part.num_rows
                if size == run_rows:
                    yield flush()
        if held:
            yield flush()

    return pack


def merge(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted entries without repeats, and for each input entry the place of the one it went into.

    Sorted runs laid end to end are merged by a sort that uses them.  Equal neighbours must
    agree in everything that is verified.
    """
    order = np.lexsort((entries["row"], entries["id"], entries["no_id"], *(entries[k] for k in reversed(VERIFIED))))
    s = entries[order]
    first = np.ones(len(s), dtype=bool)
    if len(s):
        first[1:] = np.any([s[k][1:] != s[k][:-1] for k in VERIFIED], axis=0)
    starts = np.flatnonzero(first)
    out = s[starts]
    if len(s):
        out["count"] = np.add.reduceat(s["count"], starts)
    at = np.empty(len(s), dtype=np.int64)
    at[order] = np.cumsum(first) - 1
    return out, at


def digit(entries: np.ndarray, level: int, fan: int) -> np.ndarray:
    """The digest's digit that decides level ``level`` (from the upper bits)."""
    bits = fan.bit_length() - 1
    return (entries["a"] >> np.uint64(64 - bits * (level + 1))).astype(np.int64) & (fan - 1)


def target(place: int, part: int, level: int, fan: int) -> int:
    """The place whose digit of ``level`` is ``part`` and whose others are those of ``place``."""
    unit = fan ** level
    return place + (part - place // unit % fan) * unit


def _sent(entries: np.ndarray, place: int, sender: int, level: int, fan: int) -> list[tuple]:
    """Pieces of a merged run for the places of its group; a piece for every digit, also an empty one."""
    # The digits before this one are those of the place, so this digit is sorted too.
    cuts = np.searchsorted(digit(entries, level, fan), np.arange(fan + 1))
    return [(target(place, part, level, fan), sender, part, entries[cuts[part]:cuts[part + 1]].tobytes()) for part in range(fan)]


_PIECES = pa.schema([("place", pa.int64()), ("sender", pa.int64()), ("part", pa.int32()), ("entries", pa.binary())])
_ANSWERS = pa.schema([("receiver", pa.int64()), ("part", pa.int32()), ("entries", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _start(places: int, fan: int):
    """Runs -> the pieces of the first round."""

    def start(batches):
        for b in batches:
            for row in b.to_pylist():
                run = row["run"]
                entries, _ = merge(np.frombuffer(row["rows"], dtype=ENTRY))
                # One run of a task: the task's number; more of them are spread by an odd step.
                place = ((run >> 24) + (run & 0xFFFFFF) * 5381) % places
                yield from _table(_sent(entries, place, run, 0, fan), _PIECES).to_batches()

    return start


def _pieces(t: pa.Table) -> tuple[list, list, list, np.ndarray]:
    """Senders, parts and sizes of a place's pieces, in a fixed order, and their entries end to end."""
    rows = sorted(t.select(["sender", "part", "entries"]).to_pylist(), key=lambda r: (r["sender"], r["part"]))
    arrays = [np.frombuffer(r["entries"], dtype=ENTRY) for r in rows]
    return [r["sender"] for r in rows], [r["part"] for r in rows], [len(a) for a in arrays], np.concatenate(arrays) if arrays else np.zeros(0, dtype=ENTRY)


def _round(level: int, fan: int):
    """Merge what a place got and send it on in round ``level``."""

    def step(t: pa.Table) -> pa.Table:
        place = t.column("place")[0].as_py()
        entries, _ = merge(_pieces(t)[3])
        return _table(_sent(entries, place, place, level, fan), _PIECES)

    return step


def _answers(senders: list, parts: list, sizes: list, at: np.ndarray, known: np.ndarray) -> pa.Table:
    cuts = np.cumsum([0, *sizes])
    return _table([(s, p, known[at[a:b]].tobytes()) for s, p, a, b in zip(senders, parts, cuts[:-1], cuts[1:], strict=True)], _ANSWERS)


def _last(t: pa.Table) -> pa.Table:
    """The last merge: answers to all who sent."""
    senders, parts, sizes, entries = _pieces(t)
    merged, at = merge(entries)
    return _answers(senders, parts, sizes, at, _answer_of(merged))


def _answer_of(merged: np.ndarray) -> np.ndarray:
    known = np.zeros(len(merged), dtype=ANSWER)
    for k in ANSWER.names:
        known[k] = merged[k]
    return known


def _received(t: pa.Table) -> list[np.ndarray]:
    """Answers of one receiver by part."""
    return [np.frombuffer(r["entries"], dtype=ANSWER) for r in sorted(t.select(["part", "entries"]).to_pylist(), key=lambda r: r["part"])]


def _back(level: int, fan: int):
    """Answers to what a place sent in round ``level`` + 1 become answers to what it had got in round ``level``."""

    def step(got: pa.Table, answers: pa.Table) -> pa.Table:
        if not got.num_rows:
            return _table([], _ANSWERS)
        senders, parts, sizes, entries = _pieces(got)
        merged, at = merge(entries)
        known, digits = np.zeros(len(merged), dtype=ANSWER), digit(merged, level + 1, fan)
        for part, values in enumerate(_received(answers)):
            known[digits == part] = values
        return _answers(senders, parts, sizes, at, known)

    return step


RESULT = "id long, keep_id long, group_size long, kept boolean, sha binary, row long"
_RESULT = pa.schema([("id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("kept", pa.bool_()), ("sha", pa.binary()), ("row", pa.int64())])


def _resolve(members: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of a run with the answers to its entries."""
    if not members.num_rows:
        return _RESULT.empty_table()
    rows = np.frombuffer(members.column("rows")[0].as_py(), dtype=ENTRY)
    _, at = merge(rows)
    known = np.concatenate(_received(answers))[at]
    sha = np.stack([rows[k] for k in "abcd"], axis=1).astype(">u8").tobytes()
    hashes = pa.Array.from_buffers(pa.binary(32), len(rows), [None, pa.py_buffer(sha)]).cast(pa.binary())
    return pa.table([pa.array(rows["id"], mask=rows["no_id"].astype(bool)), pa.array(known["id"], mask=known["no_id"].astype(bool)), pa.array(known["count"]),
                     pa.array(rows["row"] == known["row"]), hashes, pa.array(rows["row"])], schema=_RESULT)


def tree_merge(digests: DataFrame, scratch: Scratch, fan: int = FAN, run_rows: int = RUN_ROWS) -> DataFrame:
    """``id, sha, second, bytes, row`` -> ``id, keep_id, group_size, kept, sha, row``."""
    members = scratch.write(digests.mapInArrow(_runs(run_rows), MEMBERS), "runs", codec="uncompressed", batch_rows=10_000)
    rounds, places = 1, fan
    n = members.select("run").count()
    while places < n:
        rounds, places = rounds + 1, places * fan
    # As many partitions as the places can fill; each place is one task's small piece of work.
    levels = [scratch.write(members.mapInArrow(_start(places, fan), PIECES), "level_0", codec="uncompressed")]
    for level in range(1, rounds):
        levels.append(scratch.write(levels[-1].groupBy("place").applyInArrow(_round(level, fan), PIECES), f"level_{level}", codec="uncompressed"))
    answers = levels[-1].groupBy("place").applyInArrow(_last, ANSWERS)
    for level in range(rounds - 2, -1, -1):
        answers = scratch.write(answers, f"answers_{level + 1}", codec="uncompressed")
        answers = levels[level].groupBy("place").cogroup(answers.groupBy("receiver")).applyInArrow(_back(level, fan), ANSWERS)
    return members.groupBy("run").cogroup(answers.groupBy("receiver")).applyInArrow(_resolve, RESULT)


def _digests(docs: DataFrame, id_col: str, text_col: str, row: Column) -> DataFrame:
    text = normalised(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), row.alias("row")).select(
        "id", F.unhex(F.sha2("text", 256)).alias("sha"), F.xxhash64("text").alias("second"), F.octet_length("text").cast("long").alias("bytes"), "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = FAN, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    scratch = Scratch(docs.sparkSession, "exact")
    found = tree_merge(_digests(docs, id_col, text_col, F.monotonically_increasing_id()), scratch, fan, run_rows)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = FAN, run_rows: int = RUN_ROWS) -> DataFrame:
    """The documents (all their columns) without those whose text stands in a kept one.

    The rows are numbered in a written copy, so that a task that runs again can't number them
    otherwise; the join that drops rows is by that number, which no two rows share.
    """
    scratch, row = Scratch(docs.sparkSession, "exact"), free_name(docs.columns, "row")
    numbered = scratch.write(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = tree_merge(_digests(numbered, id_col, text_col, F.col(f"`{row}`")), scratch, fan, run_rows)
    return numbered.join(found.where("kept").select(F.col("row").alias(row)), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
