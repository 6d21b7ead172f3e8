"""Conversation structure repair: a rank-convergence parallel Viterbi.

A conversation must have role initials ``(s?(ua)+)?``.  The cheapest edits are a shortest path
through four states (0: nothing yet, S: after the system row, U: after a user row, A: after an
assistant row), row by row.  A conversation may be longer than a task can hold, so:

* Rows are sorted over the whole table by ranges of (conversation, turn, ...), and a task packs
  what it gets into *chunks* of at most ``chunk_rows`` rows.  A conversation that lies
  inside one task and one chunk is solved there and then.
* Of all other conversations, each chunk computes its vectors of costs to go from its end, with
  a *speculative* vector in place of the next chunk's (the vector at a conversation's end).
* *Fix-up passes*: a chunk whose true end vector differs from the one it ran with by more than a
  constant runs again, from its end until its vector differs from the earlier one by a constant
  only; the rest of it stays valid.  Passes are repeated until no end vector changes.  Vectors differ by
  a few units, so chunks of usual rows converge in a few rows.  Rows that must go (blank, repeated) add 4 to
  every state, and rows that fit nowhere (initial neither s, u nor a) swap states, so long runs of these
  may hand a difference on from chunk to chunk.  Chunks that are still open after ``most_passes``
  passes give the costs between all pairs of states (16 numbers a chunk), and the products of these along a
  conversation give the end vectors.
* *Stitched backward costs drive the trace*: with the true end vectors every chunk traces the
  least audit from each start state; along a conversation these pieces are put together by the state
  in which the one before ends.  Each letter leads from one state to one other, so the least letter
  whose cost keeps to the cost to go gives the ASCII-least audit.

Order of rows with the same turn: role, then the first 256 characters of the text, then its SHA-256; rows
that are equal in all of these are alike.  Nulls: conv_id, turn, role and text are one space where they
are text (and so an illegal role, a blank text); a null conv_id is a conversation of its own; null turns come
first.  Empty and white-space-only texts are blank.  An empty table gives no rows; a conversation of
which nothing is left has zeros, an empty audit and the hash of the empty string.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

#: Rows of a chunk, and characters of text (a longer row is a chunk of its own).
CHUNK_ROWS, CHUNK_CHARS = 4096, 1 << 22
#: Fix-up passes before open chunks are settled by products.
MOST_PASSES = 4

DELETE, INSERT, RELABEL, TRUNCATED = 4, 3, 3, 3
EMPTY, S, U, A = range(4)
#: The state after a row with initial u or a is added; none where that is not allowed.
ADDED = {EMPTY: U, S: U, U: A, A: U}
#: Costs to go at the end of a conversation: a user row lacks an assistant row, a system row lacks both.
END = (0, 6, 3, 0)
_KEPT = {("s", EMPTY): S, ("u", EMPTY): U, ("u", S): U, ("u", A): U, ("a", U): A}

#: Kinds of rows: must go; else initial (s, u, a or other) and whether it is truncated.
GONE = 8
INITIALS = "sua?"


def _choices(kind: int, state: int) -> list[tuple[str, int, int, bool]]:
    """Edits at a row: letter, cost, next state, whether the row is used up; in ASCII order."""
    out = [("D", DELETE, state, True), ("I", INSERT, ADDED[state], False)]
    if kind != GONE:
        initial, extra = INITIALS[kind >> 1], TRUNCATED * (kind & 1)
        if (initial, state) in _KEPT:
            out.append(("K", extra, _KEPT[initial, state], True))
        out.append(("R", RELABEL + extra, ADDED[state], True))
    return out


@lru_cache(maxsize=None)
def step(kind: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs to go before a row from those after it: relative to state A, and A's own."""
    costs = [min(c + after[q] for _, c, q, used in _choices(kind, state) if used) for state in range(4)]
    for _ in range(2):  # inserts lead from 0 and S to U, and from U to A and back
        costs = [min(c, INSERT + costs[ADDED[state]]) for state, c in enumerate(costs)]
    return tuple(c - costs[A] for c in costs), costs[A]


@lru_cache(maxsize=None)
def edits(kind: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The least letters from ``state`` until the row is used up, and the state then."""
    before, base = step(kind, after)
    letters = ""
    while True:
        to_go = before[state] + base
        for letter, cost, nxt, used in _choices(kind, state):
            if cost + (after[nxt] if used else before[nxt] + base) == to_go:
                letters, state = letters + letter, nxt
                break
        if used:
            return letters, state


def relative(vector) -> tuple[int, ...]:
    return tuple(int(v) - int(vector[A]) for v in vector)


def run_back(kinds: bytes, end: tuple[int, ...], earlier: list | None = None) -> tuple[list, list, int]:
    """Vectors before each row and at the end (relative to A), what each row adds to A, and how many rows were run.

    With the vectors of an earlier run, it ends where they are the same again (the full costs
    then differ by a constant), and the earlier ones hold from there on.
    """
    n = len(kinds)
    vectors, added = [()] * n + [end], [0] * n
    for t in range(n - 1, -1, -1):
        vectors[t], added[t] = step(kinds[t], vectors[t + 1])
        if earlier is not None and vectors[t] == earlier[0][t]:
            vectors[:t], added[:t] = earlier[0][:t], earlier[1][:t]
            return vectors, added, n - t
    return vectors, added, n


def trace(kinds: bytes, vectors: list, state: int, last: bool) -> tuple[str, int]:
    """The least audit from ``state``, and the state after the rows (and, at the very end, what is still inserted)."""
    out = []
    for kind, after in zip(kinds, vectors[1:], strict=True):
        letters, state = edits(kind, state, after)
        out.append(letters)
    while last and END[state]:
        out.append("I")
        state = ADDED[state]
    return "".join(out), state


def repaired(audit: str, roles: list, texts: list, state: int):
    """The lines that an audit leaves, from ``state`` on."""
    at = 0
    for letter in audit:
        if letter == "I":
            state = ADDED[state]
            yield ("user:" if state == U else "assistant:")
            continue
        role, text = roles[at], texts[at]
        at += 1
        if letter == "K":
            state = _KEPT[role[:1], state]
            yield f"{role}:{text}"
        elif letter == "R":
            state = ADDED[state]
            yield ("user:" if state == U else "assistant:") + text


# -- rows ------------------------------------------------------------------------------------------

WORD = "[^\\x20\\x09-\\x0D]"


def damaged(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text, copies`` after damage; rows that the damage drops stay with 0 copies and no text."""
    def or_space(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    damage = F.crc32(F.concat(or_space(conv_col), F.lit(":"), or_space(turn_col)).cast("binary")) % 20
    text = or_space(text_col)
    return conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.when(damage == 4, "user").when(damage == 0, "").otherwise(or_space(role_col)).alias("role"),
        F.when(damage.isin(0, 1), "").when(damage == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(damage == 0, 0).when(damage == 3, 2).otherwise(1).alias("copies"))


def undamaged(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The same columns with every row once, as it is."""
    def or_space(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    return conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                                or_space(role_col).alias("role"), or_space(text_col).alias("text"), F.lit(1).alias("copies"))


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows with their own faults and whether role and text stand at an earlier turn, in ranges by conversation and place."""
    of_turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    own = rows.withColumns({"same": F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256),
                            "blank": ~F.col("text").rlike(WORD),
                            "truncated": ~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z"),
                            "present": F.col("copies") > 0})
    first = own.where("present").groupBy("conv", "same").agg(F.min(of_turn).alias("first"))
    first = first.select(F.col("conv").alias("c"), F.col("same").alias("s"), "first")
    marked = (own.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
              .select("conv", "turn", "role", "text", "same", "blank", "truncated", "copies",
                      (F.col("present") & (F.col("first") < of_turn)).alias("seen"),
                      F.col("conv").isNull().alias("no_conv"), F.substring("text", 1, 256).alias("begin"), F.monotonically_increasing_id().alias("any")))
    order = [F.col("no_conv"), F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("begin"), F.col("same")]
    # `any` spreads rows that are alike over several ranges; their order doesn't matter.
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return marked.repartitionByRange(n, *order, F.col("any")).sortWithinPartitions(*order, F.col("any"))


CHUNK = ("conv long, span int, part int, whole boolean, kinds binary, roles array<string>, texts array<string>, first_same string, last_same string, "
         "initials string, min_turn long, max_turn long, n_turns long, n_blank long, n_duplicate long, n_truncated long")
_CHUNK = pa.schema([("conv", pa.int64()), ("span", pa.int32()), ("part", pa.int32()), ("whole", pa.bool_()), ("kinds", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                    ("first_same", pa.string()), ("last_same", pa.string()), ("initials", pa.string()), ("min_turn", pa.int64()), ("max_turn", pa.int64()), ("n_turns", pa.int64()),
                    ("n_blank", pa.int64()), ("n_duplicate", pa.int64()), ("n_truncated", pa.int64())])


class _Chunk:
    """Rows of one conversation, in order, gathered by one task."""

    def __init__(self, conv, part: int):
        self.conv, self.part, self.chars = conv, part, 0
        self.kinds, self.roles, self.texts, self.marks = bytearray(), [], [], []
        self.first_same = self.last_same = None
        self.n = [0, 0, 0]
        self.min = self.max = None
        self.turns = 0

    def add(self, row: dict, repeated: bool, fresh_turn: bool) -> None:
        turn = row["turn"]
        if turn is not None:
            self.min, self.max = turn if self.min is None else self.min, turn
            self.turns += fresh_turn
        role, initial = row["role"], row["role"][:1]
        fault = 0 if row["blank"] else 1 if repeated else 2 if row["truncated"] else None
        if fault is not None:
            self.n[fault] += 1
        place = "sua".find(initial) if initial else -1
        self.kinds.append(GONE if fault in (0, 1) else (place if place >= 0 else 3) * 2 + (fault == 2))
        self.roles.append(role)
        self.texts.append(row["text"])
        self.marks.append("sua"[place] if place >= 0 else "?")
        self.chars += len(row["text"]) + 64

    def row(self, span: int, whole: bool) -> tuple:
        return (self.conv, span, self.part, whole, bytes(self.kinds), self.roles, self.texts, self.first_same, self.last_same, "".join(self.marks), self.min, self.max, self.turns, *self.n)


def _chunker(chunk_rows: int, chunk_chars: int):
    """Sorted rows of a range -> chunks.  ``whole``: the conversation neither touches an end of the range nor
    is split, so no other chunk belongs to it.

    Copies of a row are alike and stand side by side, so all but the first are repeats; across the ends of ranges
    ``first_same`` and ``last_same`` (turn, role and text of the first and last row) tell them.
    """
    from pyspark import TaskContext

    def pack(batches):
        span = TaskContext.get().partitionId()
        chunk, out, size, last, first_conv = None, [], 0, None, True

        def close(whole: bool):
            nonlocal chunk, size
            out.append(chunk.row(span, whole))
            size += chunk.chars
            chunk = None

        for b in batches:
            for row in b.to_pylist():
                if chunk is None or row["conv"] != chunk.conv:
                    if chunk is not None:
                        close(whole=chunk.part == 0 and not first_conv)
                        first_conv = False
                    chunk, last = _Chunk(row["conv"], 0), None
                same = f"{row['turn']}:{row['same']}"
                for _ in range(row["copies"]):
                    if len(chunk.kinds) >= chunk_rows or chunk.chars > chunk_chars:
                        part = chunk.part
                        close(whole=False)
                        chunk = _Chunk(row["conv"], part + 1)
                    chunk.add(row, row["seen"] or same == last, last is None or row["turn"] != turn)
                    chunk.first_same = chunk.first_same or same
                    chunk.last_same = last = same
                    turn = row["turn"]
                if size >= 1 << 22 or len(out) >= 1000:
                    yield from _batch(out)
                    out, size = [], 0
        if chunk is not None:
            close(whole=False)
        if out:
            yield from _batch(out)

    return pack


def _batch(rows: list[tuple], schema: pa.Schema = _CHUNK) -> list[pa.RecordBatch]:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema).to_batches()


# -- results ---------------------------------------------------------------------------------------

NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
RESULT = "conv long, " + ", ".join(f"{c} long" for c in NUMBERS) + ", audit string, repaired_sha256 string"
_RESULT = pa.schema([("conv", pa.int64()), *[(c, pa.int64()) for c in NUMBERS], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _illegal(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


class _Sum:
    """Adds up the chunks of a conversation in order."""

    def __init__(self, conv):
        self.conv, self.state, self.audit, self.hash, self.lines = conv, EMPTY, [], hashlib.sha256(), 0
        self.n, self.cost, self.illegal = [0, 0, 0], 0, 0
        self.min = self.max = None
        self.turns, self.initial, self.last_turn = 0, "", None

    def add(self, row: dict, audit: str, added: int) -> None:
        for line in repaired(audit, row["roles"], row["texts"], self.state):
            self.hash.update((b"\n" if self.lines else b"") + line.encode("utf-8", "surrogatepass"))
            self.lines += 1
        self.audit.append(audit)
        self.cost += added
        for i, c in enumerate(("n_blank", "n_duplicate", "n_truncated")):
            self.n[i] += row[c]
        if row["initials"]:
            self.illegal += _illegal(self.initial + row["initials"])
            self.initial = row["initials"][-1]
        if row["min_turn"] is not None:
            # The first range of a turn has counted it already; chunks of one range don't count it twice.
            self.turns += row["n_turns"] - (self.max is not None and row["min_turn"] == self.max and row["part"] == 0)
            self.min, self.max = row["min_turn"] if self.min is None else self.min, row["max_turn"]

    def result(self) -> tuple:
        gaps = 0 if self.min is None else self.max - self.min + 1 - self.turns
        return (self.conv, gaps, *self.n, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _solve_whole(batches):
    """Conversations of one chunk."""
    for b in batches:
        out = []
        for row in b.to_pylist():
            vectors, added, _ = run_back(row["kinds"], relative(END))
            one = _Sum(row["conv"])
            one.add(row, trace(row["kinds"], vectors, EMPTY, True)[0], sum(added) + vectors[0][EMPTY] + END[A])
            out.append(one.result())
        yield from _batch(out, _RESULT)


VECTORS = "conv long, span int, part int, kinds binary, end_with array<int>, vectors binary, added binary, rerun int"
_VECTORS = pa.schema([("conv", pa.int64()), ("span", pa.int32()), ("part", pa.int32()), ("kinds", pa.binary()), ("end_with", pa.list_(pa.int32())), ("vectors", pa.binary()), ("added", pa.binary()), ("rerun", pa.int32())])
KEY = ["conv", "span", "part"]


def _run(batches):
    """Chunks with an end vector (``end_true``) -> their vectors; what an earlier run left is used where it is there."""
    for b in batches:
        out = []
        for row in b.to_pylist():
            earlier = None
            if row.get("vectors") is not None:
                old = np.frombuffer(row["vectors"], dtype=np.int8).reshape(-1, 4).tolist()
                earlier = [tuple(v) for v in old], np.frombuffer(row["added"], dtype=np.int8).tolist()
            end = tuple(row["end_true"])
            vectors, added, n = run_back(row["kinds"], end, earlier)
            out.append((row["conv"], row["span"], row["part"], row["kinds"], list(end), np.array(vectors, dtype=np.int8).tobytes(), np.array(added, dtype=np.int8).tobytes(), n))
        yield from _batch(out, _VECTORS)


def _start_vector() -> Column:
    """The vector before a chunk's first row, as four numbers."""
    byte = F.conv(F.hex(F.substring("vectors", 1, 4)), 16, 10).cast("long")
    parts = [F.shiftright(byte, 8 * (3 - i)).bitwiseAND(255).cast("int") for i in range(4)]
    return F.array(*[F.when(p > 127, p - 256).otherwise(p) for p in parts])


PRODUCTS = "conv long, span int, part int, end_true array<int>"
_PRODUCTS = pa.schema([("conv", pa.int64()), ("span", pa.int32()), ("part", pa.int32()), ("end_true", pa.list_(pa.int32()))])


def _transfer(kinds: bytes) -> list[list[int]]:
    """Costs from each state before the rows to each state after them."""
    far = 1 << 40
    columns = []
    for state in range(4):
        vector = tuple(0 if q == state else far for q in range(4))
        for kind in reversed(kinds):
            costs = [min(c + vector[q] for _, c, q, used in _choices(kind, s) if used) for s in range(4)]
            for _ in range(2):
                costs = [min(c, INSERT + costs[ADDED[s]]) for s, c in enumerate(costs)]
            vector = tuple(min(c, far) for c in costs)
        columns.append(vector)
    return [[columns[q][s] for q in range(4)] for s in range(4)]


_TRANSFER = pa.schema([("conv", pa.int64()), ("span", pa.int32()), ("part", pa.int32()), ("costs", pa.list_(pa.int64()))])


def _transfers(batches):
    for b in batches:
        yield from _batch([(r["conv"], r["span"], r["part"], [c for line in _transfer(r["kinds"]) for c in line]) for r in b.to_pylist()], _TRANSFER)


def _products(t: pa.Table) -> pa.Table:
    """End vectors of a conversation's chunks from the costs between states (16 numbers for each chunk)."""
    rows = sorted(t.to_pylist(), key=lambda r: (r["span"], r["part"]), reverse=True)
    end, out = relative(END), []
    for r in rows:
        out.append((r["conv"], r["span"], r["part"], list(end)))
        end = relative([min(r["costs"][4 * s + q] + end[q] for q in range(4)) for s in range(4)])
    return pa.Table.from_batches(_batch(out, _PRODUCTS), _PRODUCTS)


TRACES = "conv long, span int, part int, audits array<string>, ends array<int>, added long, from_empty int"
_TRACES = pa.schema([("conv", pa.int64()), ("span", pa.int32()), ("part", pa.int32()), ("audits", pa.list_(pa.string())), ("ends", pa.list_(pa.int32())), ("added", pa.int64()), ("from_empty", pa.int32())])


def _trace_all(batches):
    """The least audit of a chunk from each of the four states."""
    for b in batches:
        out = []
        for row in b.to_pylist():
            vectors = [tuple(v) for v in np.frombuffer(row["vectors"], dtype=np.int8).reshape(-1, 4).tolist()]
            found = [trace(row["kinds"], vectors, state, row["is_last"]) for state in range(4)]
            out.append((row["conv"], row["span"], row["part"], [a for a, _ in found], [q for _, q in found], int(np.frombuffer(row["added"], dtype=np.int8).astype(np.int64).sum()), vectors[0][EMPTY]))
        yield from _batch(out, _TRACES)


def _put_together(batches):
    """Chunks in order, conversation by conversation, as a stream: nothing of a conversation but its audit is held."""
    one = None
    for b in batches:
        out = []
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            if one is None or row["conv"] != one.conv:
                if one is not None:
                    out.append(one.result())
                one = _Sum(row["conv"])
                row["added"] += row["from_empty"] + END[A]
            one.add(row, row["audits"][one.state], row["added"])
            one.state = row["ends"][one.state]
        yield from _batch(out, _RESULT)
    if one is not None:
        yield from _batch([one.result()], _RESULT)


def solve(chunks: DataFrame, scratch: Scratch, most_passes: int = MOST_PASSES) -> tuple[DataFrame, list[int]]:
    """Results of conversations in several chunks, and how many chunks ran in each pass."""
    order = Window.partitionBy("conv").orderBy("span", "part")
    light = scratch.write(chunks.select(*KEY, "kinds").withColumn("is_last", F.lead("span").over(order).isNull()), "kinds")
    ends = light.select(*KEY, "is_last")
    end = F.array(*[F.lit(v) for v in relative(END)]).cast("array<int>")
    vectors = scratch.write(light.withColumn("end_true", end).mapInArrow(_run, VECTORS), "pass_0")
    passes = [vectors.count()]

    def with_true_ends(v: DataFrame) -> DataFrame:
        nxt = F.lead(_start_vector()).over(order)
        return v.withColumn("end_true", F.coalesce(nxt, end)).withColumn("open", F.col("end_true") != F.col("end_with"))

    while True:
        now = with_true_ends(vectors)
        n_open = now.where("open").count()
        if not n_open:
            break
        if len(passes) > most_passes:
            costs = scratch.write(light.mapInArrow(_transfers, "conv long, span int, part int, costs array<long>"), "costs")
            true = costs.groupBy("conv").applyInArrow(_products, PRODUCTS)
            vectors = scratch.write(_by_key(light.select(*KEY, "kinds"), true, ["end_true"]).mapInArrow(_run, VECTORS), "products")
            passes.append(light.count())
            break
        passes.append(n_open)
        again = now.where("open").mapInArrow(_run, VECTORS)
        vectors = scratch.write(now.where("NOT open").drop("open", "end_true").unionByName(again), f"pass_{len(passes) - 1}")
    traced = scratch.write(_by_key(vectors, ends, ["is_last"]).mapInArrow(_trace_all, TRACES), "traces")
    rows = _by_key(chunks, traced, ["audits", "ends", "added", "from_empty"])
    # Chunks may hold some MB of text each, so few of them travel at a time.
    return scratch.write(rows.repartition("conv").sortWithinPartitions("conv", "span", "part").mapInArrow(_put_together, RESULT), "split_results", batch_rows=4), passes


def _by_key(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """``left`` with ``columns`` of the same chunk (a conversation's id may be null)."""
    r = right.select(F.col("conv").alias("c"), F.col("span").alias("s"), F.col("part").alias("p"), *columns)
    return left.join(r, F.col("conv").eqNullSafe(F.col("c")) & (F.col("span") == F.col("s")) & (F.col("part") == F.col("p"))).drop("c", "s", "p")


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS, most_passes: int = MOST_PASSES, passes: list | None = None) -> DataFrame:
    """One row per conversation of ``conv, turn, role, text, copies``: ``conv``, the counts, ``cost``, ``audit``, ``repaired_sha256``.

    ``passes`` gets the number of chunks that ran in each pass, where conversations were split.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    chunks = scratch.write(_sorted_rows(rows).mapInArrow(_chunker(chunk_rows, chunk_chars), CHUNK), "chunks", batch_rows=512)
    whole = scratch.write(chunks.where("whole").mapInArrow(_solve_whole, RESULT), "whole_results", batch_rows=256)
    rest = _repeats_across(chunks.where("NOT whole"), scratch)
    split, ran = solve(rest, scratch, most_passes)
    if passes is not None:
        passes += ran
    return whole.unionByName(split)


_FIXED = "kinds binary, n_blank long, n_duplicate long, n_truncated long"


def _repeats_across(chunks: DataFrame, scratch: Scratch) -> DataFrame:
    """A chunk whose first row is the same (turn, role, text) as the row before it, in another range, begins with a repeat."""
    filled = F.last("last_same", ignorenulls=True).over(Window.partitionBy("conv").orderBy("span", "part").rowsBetween(Window.unboundedPreceding, -1))
    repeat = F.coalesce(filled == F.col("first_same"), F.lit(False))
    first = F.conv(F.hex(F.substring("kinds", 1, 1)), 16, 10).cast("int")
    mend = chunks.select(*KEY, repeat.alias("repeat"), first.alias("kind")).where("repeat AND kind <> 8").select(*KEY, F.lit(True).alias("mend"), F.col("kind").bitwiseAND(1).alias("was_truncated"))
    r = mend.select(F.col("conv").alias("c"), F.col("span").alias("s"), F.col("part").alias("p"), "mend", "was_truncated")
    both = chunks.join(r, F.col("conv").eqNullSafe(F.col("c")) & (F.col("span") == F.col("s")) & (F.col("part") == F.col("p")), "left").drop("c", "s", "p")
    rest = F.expr("substring(kinds, 2)")
    fixed = both.withColumns({"kinds": F.when(F.col("mend"), F.concat(F.unhex(F.lit("08")), rest)).otherwise(F.col("kinds")),
                              "n_duplicate": F.col("n_duplicate") + F.coalesce(F.col("mend").cast("long"), F.lit(0)),
                              "n_truncated": F.col("n_truncated") - F.coalesce(F.col("was_truncated").cast("long"), F.lit(0))})
    return scratch.write(fixed.drop("mend", "was_truncated"), "split")


def repair_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damage: bool = False, **sizes) -> DataFrame:
    """Every conversation with its faults, the least edits and the hash of what they leave."""
    rows = (damaged if damage else undamaged)(conversations, conv_col, turn_col, role_col, text_col)
    return repair(rows, **sizes).withColumnRenamed("conv", conv_col)
