"""Documents in blocks, and packed exchanges between blocks and hash shards.

Corpus-wide questions about grams or lines ("does this content also stand in another
document?") would take a row for each gram.  Here documents are first written in
blocks of about 1 MB; a block asks about its *distinct* hashes in packed arrays, one
small binary row for each (block, shard).  The shard's task sorts what it got (about
half a million hashes, however hot one of them is: a block names it once) and answers
in the same order.  Shuffles carry a few bytes per hash, Spark splits and retries them
as usual, and nothing of corpus size is broadcast or collected.  The blocks' table is
bucketed by block, so answers meet the texts without the texts being shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, pow2_at_least

BLOCK_BYTES = 1 << 20
BLOCK = "block long, n_rows long, n_bytes long, id_sum long, ids binary, known binary, offsets binary, text binary, rest binary"
ASK = "shard int, block long, payload binary"


class Block:
    """A block's documents: ids, text bytes laid end to end, and the other columns."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.known = np.frombuffer(row["known"], dtype=bool)
        self.offsets = np.frombuffer(row["offsets"], dtype=np.int64)
        self.text = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=max(1, int(row["n_bytes"]))), dtype=np.uint8)
        self._rest = row["rest"]

    def rest(self) -> pa.Table:
        return pa.ipc.open_stream(self._rest).read_all()

    def texts(self) -> Iterator[bytes]:
        raw, at = self.text.tobytes(), self.offsets.tolist()
        return (raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True))


def text_arrays(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the rows' offsets."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.fill_null("").cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[off[0]:off[-1]] if len(off) else data[:0], off - off[0] if len(off) else np.zeros(1, dtype=np.int64)


def _packer(id_col: str, text_col: str, block_bytes: int) -> Callable:
    def pack(batches):
        part, seq, press = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
        held, size = [], 0

        def flush():
            nonlocal held, size, seq
            t = pa.Table.from_batches(held)
            text, off = text_arrays(t.column(text_col))
            ids = t.column(id_col).cast(pa.int64())
            known = np.asarray(ids.is_valid().to_numpy(), dtype=bool)
            ids = ids.fill_null(0).to_numpy().astype(np.int64)
            sink = pa.BufferOutputStream()
            rest = t.drop_columns([text_col])
            with pa.ipc.new_stream(sink, rest.schema) as w:
                w.write_table(rest)
            row = [(part << 24) | seq, len(ids), len(text), int(known.sum()), ids.tobytes(), known.tobytes(), off.tobytes(), press.compress(text.tobytes()), sink.getvalue().to_pybytes()]
            held, size, seq = [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([v], type=ty) for v, ty in zip(row, [pa.int64()] * 4 + [pa.binary()] * 5, strict=True)], names=["block", "n_rows", "n_bytes", "id_sum", "ids", "known", "offsets", "text", "rest"])

        for b in batches:
            if not b.num_rows:
                continue
            _, off = text_arrays(b.column(b.schema.get_field_index(text_col)))
            begin = 0
            while begin < b.num_rows:
                room = max(1, block_bytes - size)
                end = max(begin + 1, int(np.searchsorted(off, off[begin] + room, side="right")) - 1)
                end = min(end, b.num_rows)
                held.append(b.slice(begin, end - begin))
                size += int(off[end] - off[begin]) + 64 * (end - begin)
                begin = end
                if size >= block_bytes or begin < b.num_rows:
                    yield flush()
        if held:
            yield flush()

    return pack


def write_blocks(scratch: Scratch, docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write ``docs`` (all its columns) as blocks of at most 2^14 rows; rows keep their identity by place, so repeated or null ids do no harm."""
    packed = docs.withColumn(id_col, F.col(id_col).cast("long")).mapInArrow(_packer(id_col, text_col, block_bytes), BLOCK)
    return scratch.write_bucketed(packed, "blocks", "block", batch_rows=512)


def blocks_size(blocks: DataFrame) -> tuple[int, int]:
    n, size = blocks.agg(F.count("*"), F.sum("n_bytes")).first()
    return int(n), int(size or 0)


def shards_for(entries: float, per_shard: int = 400_000, least: int = 16) -> int:
    """A power of two of shards, in proportion to the entries."""
    return pow2_at_least(entries / per_shard, least)


def each_block(blocks: DataFrame, f: Callable[[Block, int], list[tuple]], schema: str) -> DataFrame:
    """``f(block, id)`` -> rows of ``schema``, over all blocks, without a shuffle."""
    arrow = _arrow_schema(schema)

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                out = f(Block(row), row["block"])
                yield from _rows(out, arrow)

    return blocks.mapInArrow(run, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(p.split()[0], kinds[p.split()[1]]) for p in schema.split(", ")])


def _rows(rows: list[tuple], schema: pa.Schema, per: int = 64) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), per):
        cols = list(zip(*rows[i:i + per], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def arrow_rows(rows: list[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of ``schema``."""
    return _rows(rows, _arrow_schema(schema))


def shard_bounds(sorted_hashes: np.ndarray, shards: int) -> np.ndarray:
    """Bounds of the shards (by the upper bits) in a sorted array of hashes."""
    bits = shards.bit_length() - 1
    if not bits:
        return np.array([0, len(sorted_hashes)])
    cuts = np.arange(1, shards, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, cuts), [len(sorted_hashes)]])


def packed(sorted_hashes: np.ndarray, columns: list[np.ndarray], shards: int, block: int) -> list[tuple]:
    """(shard, block, payload) rows; columns[i] belongs to sorted_hashes[i]."""
    at = shard_bounds(sorted_hashes, shards)
    return [(s, block, b"".join(np.ascontiguousarray(c[a:b]).tobytes() for c in (sorted_hashes, *columns)))
            for s, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]


def unpacked(payloads: list[bytes], kinds: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Entries per payload, and the columns of all payloads end to end."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    counts = np.array([len(p) // width for p in payloads], dtype=np.int64)
    cols, skip = [], 0
    for k in kinds:
        size = np.dtype(k).itemsize
        cols.append(np.concatenate([np.frombuffer(p, dtype=k, count=n, offset=skip * n) for p, n in zip(payloads, counts.tolist(), strict=True)]) if payloads else np.zeros(0, dtype=k))
        skip += size
    return counts, cols


def answer(asked: DataFrame, f: Callable[[np.ndarray, list[bytes]], list[bytes]]) -> DataFrame:
    """One answer to each (shard, block) row: f(blocks, payloads) -> payloads, over a whole shard."""

    def run(t: pa.Table) -> pa.Table:
        block = t.column("block").to_numpy()
        got = f(block, t.column("payload").to_pylist())
        return pa.table({"shard": t.column("shard"), "block": t.column("block"), "payload": pa.array(got, type=pa.binary())})

    return asked.groupBy("shard").applyInArrow(run, ASK)


def with_answers(blocks: DataFrame, answers: DataFrame, f: Callable[[Block, int, list[bytes]], pa.Table], schema) -> DataFrame:
    """``f(block, id, payloads in order of shards)`` for every block, also those without answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = sorted(zip(right.column("shard").to_pylist(), right.column("payload").to_pylist(), strict=True), key=lambda x: x[0])
        row = left.to_pylist()[0]
        return f(Block(row), row["block"], [p for _, p in got])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def rows_table(rows: list[tuple], schema: str) -> pa.Table:
    arrow = _arrow_schema(schema)
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
    return pa.table([pa.array(c, type=f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)


def output_schema(docs: DataFrame, id_col: str, text_col: str, extra: list[tuple[str, str]], text_type: str = "string") -> T.StructType:
    """All columns but the text (id as long), then the text, then ``extra``."""
    out = T.StructType()
    for f in docs.schema.fields:
        if f.name != text_col:
            out.add(f.name, "long" if f.name == id_col else f.dataType)
    out.add(text_col, text_type)
    for name, kind in extra:
        out.add(name, T.DataType.fromDDL(kind))
    return out


def output_table(block: Block, text_col: str, texts: pa.Array, extra: dict) -> pa.Table:
    t = block.rest().append_column(text_col, texts)
    for name, values in extra.items():
        t = t.append_column(name, pa.array(values))
    return t
