"""Quality rules: base counts of a text, and cross-document line frequency per host.

Normalised lines are hashed; the distinct texts that hold a line are counted per host.
Lines above the host's limit are boilerplate and are removed; a document that they leave
depleted is rejected.  One scan of the texts yields the counts and the line hashes; the
rest are aggregates and joins of hashes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import U64, grams_hash, mix, per_item, words_hash, words_of
from .blocks import text_arrays
from .shared import Scratch, free_name

SYMBOLS = "#*$%&|<>"  # fixed value
SPACES = " \t\n\x0b\x0c\r"
REPEAT_WORDS = 8
CHUNK = 1 << 20
_DIGITS = re.compile(rb"[0-9]+")

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = "doc_id long, host string, content long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, chars array<int>"


def line_hash(line: bytes) -> int:
    """Hash of a line without regard to case, spacing or digits (signed 64 bits)."""
    return xxhash.xxh3_64_intdigest(_DIGITS.sub(b"0", b" ".join(line.split()).lower())) - (1 << 63)


def repeated_words(text: np.ndarray, offsets: np.ndarray, k: int = REPEAT_WORDS) -> np.ndarray:
    """Per document the words that lie in ``k``-word windows found twice or more in it."""
    start, end, bounds = words_of(text, offsets)
    doc, n = per_item(bounds), len(start)
    out = np.zeros(len(offsets) - 1, dtype=np.int64)
    if n < k:
        return out
    grams = grams_hash(words_hash(text, start, end), k)
    whole = np.flatnonzero(doc[:len(grams)] == doc[k - 1:])
    key = mix(grams[whole] + doc[whole].astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, whole[again], 1)
    np.add.at(delta, whole[again] + k, -1)
    return np.bincount(doc[np.cumsum(delta[:-1]) > 0], minlength=len(out)).astype(np.int64)


def _measure(batches):
    for b in batches:
        texts, ids, hosts = b.column("text"), b.column("doc_id"), b.column("host")
        text, off = text_arrays(texts)
        begin = 0
        while begin < b.num_rows:
            end = max(begin + 1, int(np.searchsorted(off, off[begin] + CHUNK, side="right")) - 1)
            part, at = text[off[begin]:off[end]], off[begin:end + 1] - off[begin]
            repeats, raw = repeated_words(part, at), part.tobytes()
            rows = {c: [] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "lines", "chars")}
            for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                doc = raw[x:y]
                lines = [s for s in doc.split(b"\n") if s.strip()]
                chars = [len(s) if s.isascii() else len(s.decode()) for s in lines]
                rows["n_words"].append(len(doc.split()))
                rows["word_chars"].append(_solid_chars(doc))
                rows["n_symbols"].append(sum(doc.count(c) for c in _SYMBOL_BYTES))
                rows["n_dup_lines"].append(len(lines) - len(set(lines)))
                rows["lines"].append([line_hash(s) for s in lines])
                rows["chars"].append(chars)
            yield pa.RecordBatch.from_arrays([
                ids.slice(begin, end - begin).cast(pa.int64()), hosts.slice(begin, end - begin).cast(pa.string()), b.column("content").slice(begin, end - begin),
                pa.array(rows["n_words"], type=pa.int64()), pa.array(rows["word_chars"], type=pa.int64()), pa.array(rows["n_symbols"], type=pa.int64()),
                pa.array(rows["n_dup_lines"], type=pa.int64()), pa.array(repeats, type=pa.int64()),
                pa.array(rows["lines"], type=pa.list_(pa.int64())), pa.array(rows["chars"], type=pa.list_(pa.int32()))],
                names=["doc_id", "host", "content", *_COUNTS, "lines", "chars"])
            begin = end


_SYMBOL_BYTES = [c.encode() for c in SYMBOLS]


def _solid_chars(doc: bytes) -> int:
    """Code points of a UTF-8 text that are not white space."""
    solid = doc.translate(None, SPACES.encode())
    return len(solid) if solid.isascii() else len(solid.decode())


def measure(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per document: base counts, a hash of the whole text, and its lines' hashes and lengths."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[host_col].cast("string").alias("host"), docs[text_col].alias("text"), _content(docs[text_col]).alias("content")).mapInArrow(_measure, _SCHEMA)


def frequent_lines(measured: DataFrame, least: int, share: float) -> DataFrame:
    """(host, line) that more than ``least`` distinct texts of the host hold, and more than ``share`` of them.

    Copies of a text count once.  The counts are partial sums before the shuffle, so a hot
    line or host costs a task one row.
    """
    texts = measured.select("host", "content", F.array_distinct("lines").alias("lines")).dropDuplicates(["host", "content"])
    hosts = texts.groupBy("host").agg(F.count("*").alias("n_texts")).withColumnRenamed("host", "of")
    counts = texts.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > least)
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("of"))).where(F.col("n") > share * F.col("n_texts")).select("host", "line")


def judge(spark, docs: DataFrame, id_col: str, text_col: str, host_col: str, least: int, share: float, keep_share: float, min_words: int, max_repeat: int) -> DataFrame:
    """Measured documents with ``removed_lines`` (hashes of their frequent lines), ``base_failed`` and ``kept``."""
    scratch = Scratch(spark, "line_freq")
    measured = scratch.write(measure(docs, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id()), "measured", batch_rows=TEXTS)
    bad = scratch.write(frequent_lines(measured, least, share), "frequent").select(F.col("host").alias("of"), F.col("line").alias("bad"))
    lines = measured.select("row", "host", F.explode(F.arrays_zip("lines", "chars")).alias("x")).select("row", "host", F.col("x.lines").alias("line"), F.col("x.chars").alias("chars"))
    hit = lines.join(bad, lines["host"].eqNullSafe(bad["of"]) & (lines["line"] == bad["bad"])).groupBy(F.col("row").alias("in")).agg(F.sum("chars").alias("removed_chars"), F.collect_set("line").alias("removed_lines"))
    out = measured.join(hit, F.col("row") == F.col("in"), "left")
    total = F.aggregate("chars", F.lit(0).cast("long"), lambda a, c: a + c)
    depleted = F.coalesce("removed_chars", F.lit(0)) > (1 - keep_share) * total
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


#: Texts of an Arrow batch.
TEXTS = 500

# The share of the host decides at every size; ``least`` only keeps a few chance repeats in a host
# of under 500 texts from counting as boilerplate.
LIMITS = {"least": 5, "share": 0.01, "keep_share": 0.2, "min_words": 20, "max_repeat": 30}


def keep_good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The documents that ``quality_rules`` keeps, with all their columns and without frequent lines.

    A text that loses lines is the rest joined by a newline; ``n_chars`` follows the text if
    there is such a column.  Rows are matched by id and content, so repeated rows go or stay
    together.
    """
    docs = docs.withColumn(id_col, F.col(f"`{id_col}`").cast("long"))
    judged = judge(docs.sparkSession, docs, id_col, text_col, host_col, **(LIMITS | limits)).where("kept")
    kept = judged.groupBy("doc_id", "host", "content").agg(F.first(F.coalesce("removed_lines", F.array().cast("array<long>"))).alias("removed"))
    own = {c: free_name(docs.columns, f"kept_{c}") for c in ("doc_id", "host", "content", "removed", "hash")}
    kept = kept.select(*[F.col(c).alias(own[c]) for c in ("doc_id", "host", "content", "removed")])
    col = {c: F.col(f"`{c}`") for c in docs.columns}
    marked = docs.withColumn(own["hash"], _content(col[text_col]))
    met = marked.join(kept, col[id_col].eqNullSafe(F.col(own["doc_id"])) & col[host_col].cast("string").eqNullSafe(F.col(own["host"])) & (F.col(own["hash"]) == F.col(own["content"])))
    # Written a few hundred texts at a time: an Arrow batch of the session's size may hold 10,000 long ones.
    out = met.withColumn(text_col, _without(F.coalesce(col[text_col], F.lit("")), F.col(own["removed"]))).select(*col.values())
    out = Scratch(docs.sparkSession, "line_freq").write(out, "kept", batch_rows=TEXTS)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast("long"))
    return out.select(*[col[c] for c in docs.columns])


def _content(text: Column) -> Column:
    """A hash of the whole text (null is the empty text)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _without(text: Column, removed: Column) -> Column:
    @F.arrow_udf("string")
    def without(texts: pa.Array, hashes: pa.Array) -> pa.Array:
        out = []
        for t, gone in zip(texts.to_pylist(), map(set, hashes.to_pylist()), strict=True):
            out.append("\n".join(s for s in t.split("\n") if not s.strip(SPACES) or line_hash(s.encode()) not in gone) if gone else t)
        return pa.array(out, type=pa.string())

    return without(text, removed)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """Base counts and the line-frequency verdict of every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept.  ``limits``: a line is boilerplate if more than ``least`` distinct texts of its host
    hold it and these are more than ``share`` of the host's texts; a document is depleted if
    such lines hold more than 1 - ``keep_share`` of its characters; ``min_words`` and
    ``max_repeat`` (percent) bound the base counts.  Null text has no words and fails; a null
    host is a host of its own; null and repeated ids are judged row by row; equal texts of a host
    count once.  An empty table gives an empty table; other columns are not read.
    """
    judged = judge(docs.sparkSession, docs, id_col, text_col, host_col, **(LIMITS | limits))
    return judged.select("doc_id", *_COUNTS, "base_failed", "kept")
