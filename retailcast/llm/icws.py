"""Near-duplicate documents by weighted MinHash (improved consistent weighted sampling).

Shingles of five words weigh their count times an inverse document frequency.  The
frequencies of hashed shingle features are counted over all documents in a table of fixed
size.  Each sample of a document is a shingle drawn in proportion to its weight, equal in two
documents with the probability of their weighted Jaccard similarity.  Bands of samples put
similar documents into common buckets; in a bucket everyone is compared with one leader
first, and only components that are still apart look for further partners, among those that
share one of their rarest shingles.  Every link is verified on the documents' whole shingle weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import BASES, SEEDS, U64, grams_hash, mix, mix_in_place, per_item, prefix, spans_hash, words_hash, words_of
from .blocks import Block, blocks_size, each_block, output_schema, rows_table, write_blocks
from .components import components, joined
from .shared import Scratch

SHINGLE = 5
FEATURE_BITS = 20  # size of the document-frequency table: 2^20 counts, 4 MB, whatever the corpus
SLICE_BITS = 13
RARE = 10  # shingles in fewer than one of so many documents weigh alike
BANDS, ROWS = 10, 3
SIMILAR = 0.8
AGREE = 15  # of BANDS x ROWS samples; at similarity 0.8 fewer agree once in 10,000 times
CHUNK = 4096
TOGETHER = 1 << 16
TASK_BLOCKS = 4
SIGNATURE = "row long, doc_id long, n_words long, a long, b long, bands array<long>, samples binary"


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(document, hash) of every shingle of five words; a shorter text is one shingle of all its words."""
    start, end, bounds = words_of(block.text, block.offsets)
    words = words_hash(block.text, start, end)
    doc, count = per_item(bounds), np.diff(bounds)
    grams = grams_hash(words, SHINGLE)
    whole = np.flatnonzero(doc[:len(grams)] == doc[SHINGLE - 1:])
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    tail = spans_hash(prefix(words, BASES[1]), BASES[1], bounds[short], bounds[short + 1], SEEDS[1])
    return np.concatenate([doc[whole], short]), np.concatenate([grams[whole], tail]), (words, bounds, count)


def by_document(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Order by document, then hash; a block has at most 2^14 documents."""
    order = np.argsort(h)
    return order[np.argsort(doc[order].astype(np.uint16), kind="stable")]


def distinct_shingles(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, shingle) sorted, and how often each occurs."""
    order = by_document(doc, h)
    d, s = doc[order], h[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(new)
    return d[at], s[at], np.diff(np.append(at, len(d)))


def feature(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - FEATURE_BITS)).astype(np.int64)


def frequencies(scratch: Scratch, blocks: DataFrame) -> np.ndarray:
    """Documents that hold a shingle of each feature, over all documents.

    A task adds up its blocks in one table and passes it on in slices; each slice is summed
    as it streams in.  The result has a fixed size.
    """
    width = 1 << SLICE_BITS

    def count(batches):
        total = np.zeros(1 << FEATURE_BITS, dtype=np.int64)
        for b in batches:
            for row in b.to_pylist():
                doc, h, _ = shingles(Block(row))
                key = np.sort((doc.astype(np.int64) << FEATURE_BITS) | feature(h))
                key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
                total += np.bincount(key & ((1 << FEATURE_BITS) - 1), minlength=len(total))
        for i in range(0, len(total), width):
            if (part := total[i:i + width]).any():
                yield pa.RecordBatch.from_arrays([pa.array([i // width], type=pa.int32()), pa.array([part.astype("<i4" if part.max() < 2**31 else "<i8").tobytes()], type=pa.binary())], names=["slice", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column("slice").to_pylist(), b.column("counts").to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(raw, dtype="<i4" if len(raw) == 4 * width else "<i8").astype(np.int64)
        for i, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], type=pa.int32()), pa.array([s.astype("<i8").tobytes()], type=pa.binary())], names=["slice", "counts"])

    kind = "slice int, counts binary"
    counted = scratch.write(blocks.mapInArrow(count, kind), "features", batch_rows=4)
    summed = scratch.write(counted.repartition("slice").mapInArrow(add, kind), "frequencies", batch_rows=64)
    out = np.zeros(1 << FEATURE_BITS, dtype=np.int64)
    for r in summed.collect():  # 2^20 counts in all
        out[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["counts"], dtype="<i8")
    return out


def inverse_frequency(n: int, counts: np.ndarray) -> np.ndarray:
    """ln(1 + n / count) of each feature, held where n / count passes ``RARE``.

    Without that limit a group of copies would weigh less the larger it is, and its members'
    edits, which are rare, would count for more and more.
    """
    return np.log1p(np.minimum(n / np.maximum(counts, 1), RARE)).astype(np.float32)


def gamma2_table(bits: int = 16) -> np.ndarray:
    """Quantiles of Gamma(2, 1), by bisection."""
    p = (np.arange(1 << bits) + 0.5) / (1 << bits)
    low, high = np.zeros(len(p)), np.full(len(p), 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return ((low + high) / 2).astype(np.float32)


def samples(doc_starts: np.ndarray, h: np.ndarray, weight: np.ndarray, table: np.ndarray, log_table: np.ndarray, n: int) -> np.ndarray:
    """``n`` weighted samples of every document (one per row), as hashes of (shingle, level).

    Ioffe's scheme: with r, c ~ Gamma(2, 1) and b ~ U(0, 1) of the shingle, t = floor(ln w / r + b)
    and the shingle with the least ln c - r (t - b + 1) is drawn.  Documents are taken about
    ``TOGETHER`` shingles at a time, whose arrays stay in the processor's cache.
    """
    out = np.zeros((len(doc_starts), n), dtype=U64)
    log_w = np.log(weight).astype(np.float32)
    ends, first = np.append(doc_starts[1:], len(h)), 0
    while first < len(doc_starts):
        begin = int(doc_starts[first])
        last = max(first + 1, int(np.searchsorted(ends, begin + TOGETHER, side="right")))
        end = int(ends[last - 1])
        _draw(h[begin:end], log_w[begin:end], doc_starts[first:last] - begin, table, log_table, out[first:last])
        first = last
    return out


def _draw(h, log_w, starts, table, log_table, out) -> None:
    """One sample of every document into each column of ``out``; all large arrays are written in place."""
    sizes = np.diff(np.append(starts, len(h)))
    u, v = np.empty(len(h), U64), np.empty(len(h), U64)
    r, a, t = (np.empty(len(h), np.float32) for _ in range(3))
    bits = u.astype("<u8", copy=False).view("<u2").reshape(-1, 4)
    for k in range(out.shape[1]):
        np.add(h, U64((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF), out=u)
        mix_in_place(u, v)
        np.take(table, bits[:, 0], out=r, mode="clip")
        np.take(log_table, bits[:, 1], out=a, mode="clip")
        b = bits[:, 2].astype(np.float32)
        b /= np.float32(65536)
        np.divide(log_w, r, out=t)
        t += b
        np.floor(t, out=t)
        np.subtract(t, b, out=b)
        b += np.float32(1)
        b *= r
        a -= b
        hit = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), sizes))
        if len(hit) > len(starts):
            # ties (equal shingles of the table) go to the smallest hash, which is the first of a document
            which = np.searchsorted(starts, hit, side="right")
            hit = hit[np.append(True, which[1:] != which[:-1])]
        out[:, k] = mix(h[hit] ^ mix(t[hit].astype(np.int64).astype(U64) + U64(k)))


def _signatures(idf, tables):
    def sign(block: Block, number: int) -> list[tuple]:
        doc, h, (words, bounds, count) = shingles(block)
        d, s, tf = distinct_shingles(doc, h)
        every = [spans_hash(prefix(words, base), base, bounds[:-1], bounds[1:]).view(np.int64) for base in BASES]
        starts = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else np.zeros(0, np.int64)
        drawn = samples(starts, s, tf * idf.value[feature(s)].astype(np.float64), *tables.value, BANDS * ROWS) if len(d) else np.zeros((0, BANDS * ROWS), U64)
        bands = np.zeros((len(drawn), BANDS), dtype=U64)
        for j in range(ROWS):
            bands = mix(bands * U64(0xD6E8FEB86659FD93) + drawn[:, j::ROWS] + U64(j))
        bands, short = bands.view(np.int64), (drawn >> U64(32)).astype("<u4")
        place = {x: i for i, x in enumerate(d[starts].tolist())}
        out = []
        for i, (doc_id, known) in enumerate(zip(block.ids.tolist(), block.known.tolist(), strict=True)):
            j = place.get(i)
            out.append(((number << 16) | i, doc_id if known else None, int(count[i]), int(every[0][i]), int(every[1][i]),
                        [] if j is None else bands[j].tolist(), b"" if j is None else short[j].tobytes()))
        return out

    return sign


def _chosen(block: Block, rows: list[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The asked rows, and (index among them, hash) of their shingles; other documents are not looked at."""
    rows = sorted(rows)
    places = np.array([r & 0xFFFF for r in rows], dtype=np.int64)
    sizes = (block.offsets[1:] - block.offsets[:-1])[places]
    own = Block.__new__(Block)
    own.offsets = np.concatenate([[0], np.cumsum(sizes)])
    own.text = block.text[np.repeat(block.offsets[places] - own.offsets[:-1], sizes) + np.arange(own.offsets[-1])]
    doc, h, _ = shingles(own)
    return rows, doc, h


def _vectors(block: Block, rows: list[int], _) -> list[tuple]:
    """(row, all shingle hashes sorted, with repeats) of the asked rows."""
    rows, doc, h = _chosen(block, rows)
    order = by_document(doc, h)
    doc, h = doc[order], h[order]
    at = np.searchsorted(doc, np.arange(len(rows) + 1))
    return [(r, h[a:b].tobytes()) for r, a, b in zip(rows, at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _prefixes(similar: float):
    """(row, total weight, its rarest shingles and their weights) of the asked rows, as many as weigh
    more than 1 - ``similar`` of all.

    Two documents as similar as that share at least one of those, whatever the order, if it is
    the same for all (here: by the features' counts): what is left of either could not hold a
    large enough common part.  Shingles are shortened to 32 bits; those that then coincide are one.
    """

    def run(block: Block, rows: list[int], shared) -> list[tuple]:
        idf, place = shared
        rows, doc, h = _chosen(block, rows)
        d, s, tf = distinct_shingles(doc, h)
        order = np.lexsort((s, place[feature(s)], d))
        d, s, w = d[order], s[order], (tf * idf[feature(s)].astype(np.float64))[order]
        short = (s >> U64(32)).astype("<u4")
        new = np.append(True, (d[1:] != d[:-1]) | (short[1:] != short[:-1])) if len(d) else np.zeros(0, bool)
        d, short, w = d[new], short[new], np.add.reduceat(w, np.flatnonzero(new)) if len(d) else w
        at = np.searchsorted(d, np.arange(len(rows) + 1))
        before = np.concatenate([[0], np.cumsum(w)])
        total = before[at[1:]] - before[at[:-1]]
        taken = before[:-1] - before[at[:-1]][d] <= (1 - similar) * total[d] * (1 + 1e-9)
        return [(r, x.astype("<f8").tobytes() + short[a:b][taken[a:b]].tobytes() + w[a:b][taken[a:b]].astype("<f4").tobytes())
                for r, x, a, b in zip(rows, total, at[:-1].tolist(), at[1:].tolist(), strict=True)]

    return run


def _unpacked(p: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Shingles and weights of a prefix; its first 8 bytes are the total weight."""
    n = (len(p) - 8) // 8
    return np.frombuffer(p, "<u4", n, 8), np.frombuffer(p, "<f4", n, 8 + 4 * n).astype(np.float64)


def fetch(scratch: Scratch, blocks: DataFrame, rows: DataFrame, what, shared, name: str) -> DataFrame:
    """(row, vector): ``what(block, asked rows, shared value)`` of the blocks that hold asked rows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return rows_table([], "row long, vector binary")
        return rows_table(what(Block(left.to_pylist()[0]), right.column("row").to_pylist(), shared.value if shared else None), "row long, vector binary")

    rows = rows.select("row").distinct().withColumn("in_block", F.shiftright("row", 16))
    return scratch.write(blocks.groupBy("block").cogroup(rows.groupBy("in_block")).applyInArrow(run, "row long, vector binary"), name)


def weighted_jaccard(x: bytes, y: bytes, idf: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger weights, over all shingles of two documents."""
    u, n = np.unique(np.frombuffer(x, dtype=U64), return_counts=True)
    v, m = np.unique(np.frombuffer(y, dtype=U64), return_counts=True)
    at = np.searchsorted(v, u)
    at[at == len(v)] = 0
    same = v[at] == u if len(v) else np.zeros(len(u), bool)
    least = float((np.minimum(n[same], m[at[same]]) * idf[feature(u[same])]).sum())
    total = float((n * idf[feature(u)]).sum() + (m * idf[feature(v)]).sum()) - least
    return least / total if total > 0 else 0.0


def _similarity(idf, x: Column, y: Column) -> Column:
    """Weighted Jaccard similarity; marked non-deterministic so that a filter on it does not compute it again, in a second Python worker."""

    @F.arrow_udf("double")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        w = idf.value
        return pa.array([weighted_jaccard(p, q, w) for p, q in zip(a.to_pylist(), b.to_pylist(), strict=True)], type=pa.float64())

    return similar.asNondeterministic()(x, y)


def verified(scratch: Scratch, blocks: DataFrame, pairs: DataFrame, idf, similar: float, name: str) -> DataFrame:
    """Of a written table of distinct pairs (a, b) those whose weighted Jaccard similarity is ``similar`` or more."""
    vectors = fetch(scratch, blocks, pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))), _vectors, None, f"{name}_vectors")
    first = vectors.select(F.col("row").alias("x"), F.col("vector").alias("vx"))
    second = vectors.select(F.col("row").alias("y"), F.col("vector").alias("vy"))
    both = pairs.join(second, F.col("b") == F.col("y")).join(first, F.col("a") == F.col("x"))
    out = scratch.write_few(both.withColumn("similarity", _similarity(idf, F.col("vx"), F.col("vy"))).where(F.col("similarity") >= similar).select("a", "b", "similarity"), f"{name}_links")
    scratch.drop(vectors)
    return out


def _partners(best_only: bool, similar: float, shared):
    """Pairs of different components in a part of a bucket that may be similar enough: their
    common weight can reach what ``similar`` asks, and their samples agree often enough.

    The common weight is at most that of the shingles in both prefixes, and all that the
    document whose prefix ends first holds after its end.
    With ``best_only`` each document names its best partner only.
    """

    def run(t: pa.Table) -> pa.Table:
        place = shared.value[1]
        row, label, side = (t.column(c).to_numpy() for c in ("row", "label", "side"))
        sig = np.frombuffer(b"".join(t.column("samples").to_pylist()), dtype="<u4").reshape(len(row), -1)
        bands, band = np.array(t.column("bands").to_pylist(), dtype=np.int64), t.column("band")[0].as_py()
        vectors = t.column("vector").to_pylist()
        rare = [_unpacked(p) for p in vectors]
        total = np.array([np.frombuffer(p, "<f8", 1)[0] for p in vectors])
        after = total - np.array([w.sum() for _, w in rare])
        ends = np.array([x[-1] for x, _ in rare], dtype=np.int64)
        ends = (place[ends >> (32 - FEATURE_BITS)] << 32) | ends
        holds = np.flatnonzero(side != 1)  # documents that may be a partner
        number = np.repeat(holds, [len(rare[i][0]) for i in holds.tolist()])
        token = np.concatenate([np.zeros(0, "<u4"), *[rare[i][0] for i in holds.tolist()]])
        weight = np.concatenate([np.zeros(0), *[rare[i][1] for i in holds.tolist()]])
        order = np.argsort(token, kind="stable")
        token, number, weight = token[order], number[order], weight[order]
        out = set()
        for i in np.flatnonzero(side != 0).tolist():
            x, w = rare[i]
            a, b = np.searchsorted(token, x), np.searchsorted(token, x, side="right")
            n = b - a
            at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            common = np.bincount(number[at], np.minimum(weight[at], np.repeat(w, n)), minlength=len(row))
            j = np.flatnonzero(common)
            j = j[label[j] != label[i]]
            j = j[(bands[j] == bands[i]).argmax(1) == band]  # a pair is named in its first common band
            most = common[j] + np.where(ends[j] < ends[i], after[j], after[i])
            j = j[most * (1 + similar) >= similar * (total[j] + total[i]) * (1 - 1e-5)]
            agree = (sig[j] == sig[i]).sum(1)
            j, agree = j[agree >= AGREE], agree[agree >= AGREE]
            if best_only:
                j = j[np.lexsort((row[j], -agree))[:1]]
            out |= {(min(int(row[i]), b), max(int(row[i]), b)) for b in row[j].tolist()}
        return rows_table(list(out), "a long, b long")

    return run


def _open_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, with the bucket's largest one (``main``)
    and the numbers of chunks that this one and the others are cut into."""
    named = buckets.join(labels, F.col("row") == F.col("node"), "left").select("band", "key", "row", F.coalesce("label", "row").alias("label"))
    sizes = named.groupBy("band", "key", "label").agg(F.count("*").alias("n"))
    most = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
    most = most.where(F.col("top.n") < F.col("all")).select(F.col("band").alias("of_band"), F.col("key").alias("of_key"), F.col("top.label").alias("main"),
                                                             F.ceil(F.col("top.n") / CHUNK).cast("int").alias("mains"), F.ceil((F.col("all") - F.col("top.n")) / CHUNK).cast("int").alias("others"))
    met = named.join(most, (F.col("band") == F.col("of_band")) & (F.col("key") == F.col("of_key")))
    mine = F.when(F.col("label") == F.col("main"), F.pmod(F.xxhash64("row"), F.col("mains"))).otherwise(F.pmod(F.xxhash64("row"), F.col("others"))).cast("int")
    return met.withColumn("chunk", mine).drop("of_band", "of_key")


def _still_apart(met: DataFrame, known: DataFrame, shared, similar: float, best_only: bool) -> DataFrame:
    """Candidate pairs across components that share a bucket.

    A bucket's largest component and the others are cut into chunks that meet pairwise, but
    chunks of the largest component never meet each other: its rows are copied as often as
    the others have chunks (mostly once).
    """
    main = met.where(F.col("label") == F.col("main")).select("band", "key", "row", "label", F.lit(0).alias("side"), F.col("chunk").alias("i"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("j"))
    rest = met.where(F.col("label") != F.col("main"))
    across = rest.select("band", "key", "row", "label", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("mains") - 1)).alias("i"), F.col("chunk").alias("j"))
    other = rest.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    among = other.select("band", "key", "row", "label", F.when(F.col("chunk") == F.col("o"), 2).when(F.col("chunk") < F.col("o"), 0).otherwise(1).alias("side"),
                         (-1 - F.least("chunk", "o")).alias("i"), F.greatest("chunk", "o").alias("j"))
    tasks = main.unionByName(across).unionByName(among).join(known, F.col("row") == F.col("s")).drop("s")
    return tasks.groupBy("band", "key", "i", "j").applyInArrow(_partners(best_only, similar, shared), "a long, b long")


def classify(scratch: Scratch, blocks: DataFrame, similar: float) -> DataFrame:
    """(row, doc_id, class): class is the row that stands for the document's group.

    A task for each core at least and each ``TASK_BLOCKS`` blocks of documents writes the small tables:
    they are many, and a session may deal them to any number of partitions.
    """
    spark = scratch.spark
    scratch.tasks = max(spark.sparkContext.defaultParallelism, -(-blocks_size(blocks)[0] // TASK_BLOCKS))
    counts = frequencies(scratch, blocks)
    n = int(blocks.agg(F.sum("n_rows")).first()[0] or 0)
    idf = spark.sparkContext.broadcast(inverse_frequency(n, counts))
    shared = spark.sparkContext.broadcast((inverse_frequency(n, counts), np.argsort(np.argsort(counts, kind="stable"))))
    table = gamma2_table()
    tables = spark.sparkContext.broadcast((table, np.log(table)))
    signed = scratch.write(each_block(blocks, _signatures(idf, tables), SIGNATURE), "signatures", batch_rows=4)

    # Equal word sequences are one text; its first document (by id, null last) stands for it.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    with_words = signed.where("n_words > 0")
    texts = scratch.write_few(with_words.groupBy("a", "b").agg(F.min(order).alias("first")).select("a", "b", F.col("first.row").alias("rep")), "texts")
    signatures = with_words.join(texts.select(F.col("rep").alias("r")), F.col("row") == F.col("r"), "left_semi").select("row", "bands", "samples")
    signatures = scratch.write(signatures, "distinct")

    buckets = signatures.select("row", F.posexplode("bands").alias("band", "key"))
    leaders = buckets.groupBy("band", "key").agg(F.min("row").alias("leader"), F.count("*").alias("n")).where("n > 1")
    leaders = leaders.select(F.col("band").alias("of_band"), F.col("key").alias("of_key"), "leader")
    buckets = scratch.write_few(buckets.join(leaders, (F.col("band") == F.col("of_band")) & (F.col("key") == F.col("of_key"))).select("band", "key", "row", "leader"), "buckets")

    star = scratch.write_few(buckets.where("row <> leader").select(F.col("leader").alias("a"), F.col("row").alias("b")).distinct(), "star_apart")
    labels = components(scratch, verified(scratch, blocks, star, idf, similar, "star"), "star")
    met = scratch.write_few(_open_buckets(buckets, labels), "open")
    rare = fetch(scratch, blocks, met, _prefixes(similar), shared, "rare")
    known = rare.join(signatures.select(F.col("row").alias("s"), "samples", "bands"), F.col("row") == F.col("s")).select("s", "samples", "bands", "vector")
    tried = star
    for name, best_only in (("best", True), ("rest", False)):
        if not best_only:
            met = _open_buckets(buckets, labels)
        more = _still_apart(met, known, shared, similar, best_only).distinct()
        more = scratch.write_few(more.join(tried.select(F.col("a").alias("x"), F.col("b").alias("y")), (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti"), f"{name}_apart")
        found = verified(scratch, blocks, more, idf, similar, name)
        tried = tried.unionByName(more)
        if not found.isEmpty():
            labels = joined(scratch, labels, found, name)
    rep = signed.join(texts.select(F.col("a").alias("ta"), F.col("b").alias("tb"), "rep"), (F.col("n_words") > 0) & (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")), "left")
    return rep.join(labels, F.col("rep") == F.col("node"), "left").select("row", "doc_id", F.coalesce("label", "rep", "row").alias("group"))


def _classes(scratch: Scratch, blocks: DataFrame, similar: float) -> DataFrame:
    groups = scratch.write_few(classify(scratch, blocks, similar), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    firsts = groups.groupBy("group").agg(F.min(order).alias("first"), F.count("*").alias("class_size"))
    firsts = firsts.select(F.col("group").alias("g"), F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("first_row"), "class_size")
    joined = groups.join(firsts, F.col("group") == F.col("g"))
    return joined.select("row", "doc_id", "class_id", "class_size", (F.col("row") == F.col("first_row")).alias("keep"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """Class of every document: those linked by a weighted Jaccard similarity of ``similar`` or more.

    Weights are counts of 5-word shingles times ln(1 + documents / documents with the shingle's
    feature), the ratio held at 10 (``inverse_frequency``); features are the upper 20 bits of
    the shingle's hash.  Texts of one to four words are
    one shingle; texts without words (null, empty) are each a class of their own.  Returns doc_id,
    class_id (the least id in the class), class_size and keep (true for one document of each
    class: the least id, then the first row).  Repeated rows are documents of their own and copies
    of each other; null ids come last and are class_id only of a class without another.  An empty
    table gives an empty table; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "icws")
    blocks = write_blocks(scratch, docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), "doc_id", "text")
    return _classes(scratch, blocks, similar).drop("row")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """One document of each class of ``near_duplicates``, with all its columns."""
    scratch = Scratch(docs.sparkSession, "icws")
    blocks = write_blocks(scratch, docs, id_col, text_col)
    kept = _classes(scratch, blocks, similar).where("keep").select("row", F.shiftright("row", 16).alias("in_block"))
    names = docs.columns

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left.to_pylist()[0])
        t = b.rest().append_column(text_col, pa.array(list(b.texts()), type=pa.binary()).cast(pa.string()))
        places = sorted(r & 0xFFFF for r in right.column("row").to_pylist())
        return t.select(names).take(pa.array(places, type=pa.int64()))

    schema = output_schema(docs, id_col, text_col, [])
    schema = type(schema)([schema[n] for n in names])
    return blocks.groupBy("block").cogroup(kept.groupBy("in_block")).applyInArrow(pick, schema)
