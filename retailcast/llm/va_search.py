"""Exact top-k inner-product search with a vector-approximation file.

Vectors are written once exactly and once as cells of a uniform grid, a byte per
component.  A scan of the cells alone bounds every score from above and below; what can't
reach the k-th lower bound is out.  Exact vectors are then read in the order of their
bounds: the best 2k of each query first, and after them only those whose bound still
reaches the k-th exact score.  With scores as closeness, the largest upper bound is the
smallest distance bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

CELLS = 256
SLAB, QUERY_BLOCK, TILE = 16_384, 2_048, 128
LIMIT = 1 << 62


def _exact(scale: float):
    """Valid vectors as integers: (vec_id, is_query, dim, ints as little-endian int64)."""

    def run(batches):
        for b in batches:
            ids, vecs, asks = b.column("vec_id").cast(pa.int64()), b.column("vec"), b.column("is_query")
            rows = []
            for i, v, q in zip(ids.to_pylist(), vecs, asks.to_pylist(), strict=True):
                if i is None or not v.is_valid:
                    continue
                if v.values.null_count:
                    continue
                x = np.floor(v.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if np.isfinite(x).all():
                    rows.append((i, bool(q), len(x), np.clip(x, -float(LIMIT), float(LIMIT)).astype("<i8").tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.bool_(), pa.int32(), pa.binary()), strict=True)], names=["vec_id", "is_query", "dim", "ints"])

    return run


def _matrix(ints: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(ints), dtype="<i8").reshape(len(ints), dim)


def _by_dim(batch, columns):
    dims = np.asarray(batch.column("dim"))
    for d in np.unique(dims).tolist():
        part = batch.filter(pa.array(dims == d))
        yield d, [part.column(c).to_pylist() for c in columns]


def _ranges(batches):
    """Smallest and largest component at each place, once per task."""
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for d, (ints,) in _by_dim(b, ["ints"]):
            m = _matrix(ints, d)
            lo, hi = seen.get(d, (m.min(0), m.max(0)))
            seen[d] = np.minimum(lo, m.min(0)), np.maximum(hi, m.max(0))
    for d, (lo, hi) in seen.items():
        if d:
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, type=pa.int32()), pa.array(range(d), type=pa.int32()), pa.array(lo), pa.array(hi)], names=["dim", "place", "lo", "hi"])


def _cells(grid: dict, k: int):
    """Slabs of cells.  Of equal vectors in a slab the k + 1 smallest ids are enough: the rest
    have the same score and lose every tie."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list, list]] = {}

        def slab(d, ids, ints):
            nonlocal seq
            m, ids = _matrix(ints, d), np.array(ids, dtype=np.int64)
            same = np.unique(np.frombuffer(b"".join(ints), dtype=f"V{8 * d}"), return_inverse=True)[1] if d else np.zeros(len(ids), dtype=np.int64)
            order = np.lexsort((ids, same))
            s, i = same[order], ids[order]
            again = np.zeros(len(i), dtype=bool)
            again[1:] = (s[1:] == s[:-1]) & (i[1:] == i[:-1])
            order, s = order[~again], s[~again]
            place = np.arange(len(s)) - np.searchsorted(s, s)
            order = np.sort(order[place <= k])
            base, width = grid.get(d, (np.zeros(0, np.int64),) * 2)
            cells = ((m[order] - base) // width).astype(np.uint8) if d else np.zeros((len(order), 0), np.uint8)
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) | seq], type=pa.int64()), pa.array([d], type=pa.int32()), pa.array([ids[order].tobytes()], type=pa.binary()), pa.array([cells.tobytes()], type=pa.binary())], names=["slab", "dim", "ids", "cells"])

        for b in batches:
            for d, (ids, ints) in _by_dim(b, ["vec_id", "ints"]):
                h = held.setdefault(d, ([], []))
                h[0].extend(ids)
                h[1].extend(ints)
                while len(h[0]) >= SLAB:
                    yield slab(d, h[0][:SLAB], h[1][:SLAB])
                    del h[0][:SLAB], h[1][:SLAB]
        for d, h in held.items():
            if h[0]:
                yield slab(d, *h)

    return run


def _scan(grid: dict, k: int):
    """Bounds of a query block's scores over a slab; what may be among a query's k best comes out."""

    def run(slab: pa.Table, queries: pa.Table) -> pa.Table:
        rows: list[np.ndarray] = []
        for row in slab.to_pylist():
            d, ids = row["dim"], np.frombuffer(row["ids"], dtype=np.int64)
            cells = np.frombuffer(row["cells"], dtype=np.uint8).reshape(len(ids), d).astype(np.float64)
            base, width = grid.get(d, (np.zeros(0, np.int64),) * 2)
            extra = len(ids) - len(np.unique(ids))  # rows of repeated ids must not raise the k-th bound
            asked, vecs = queries.column("query_id").to_numpy(), _matrix(queries.column("ints").to_pylist(), d).astype(np.float64)
            for at in range(0, len(asked), TILE):
                q, own = vecs[at:at + TILE], asked[at:at + TILE]
                core = (q * width) @ cells.T + (q @ base.astype(np.float64))[:, None]
                core[own[:, None] == ids[None, :]] = -np.inf
                step = q * (width - 1)
                up, down = np.maximum(step, 0).sum(1), np.minimum(step, 0).sum(1)
                error = 1e-12 * (np.abs(q * width).sum(1) * CELLS + np.abs(q * base).sum(1))
                error[error < 1e-3] = 0  # below 2^53 all sums are exact
                n = k + extra
                kth = np.partition(core, -n, axis=1)[:, -n] if core.shape[1] >= n else np.full(len(q), -np.inf)
                i, j = np.nonzero((core + (up + error)[:, None] >= (kth + down - error)[:, None]) & np.isfinite(core))
                c = core[i, j]
                rows.append((own[i], ids[j], c + (up + error)[i], c + (down - error)[i]))
        cols = [np.concatenate(x) for x in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 2
        return pa.table(dict(zip(("query_id", "vec_id", "upper", "lower"), cols, strict=True)))

    return run


def inner_product(a: Column, b: Column) -> Column:
    """Exact inner product of two packed integer vectors of one length (held within long)."""

    @F.arrow_udf("long")
    def dot(x: pa.Array, y: pa.Array) -> pa.Array:
        xs, ys, out = x.to_pylist(), y.to_pylist(), []
        for p, q in zip(xs, ys, strict=True):
            u, v = np.frombuffer(p, dtype="<i8"), np.frombuffer(q, dtype="<i8")
            if len(u) * float(np.abs(u).max(initial=0)) * float(np.abs(v).max(initial=0)) < 2.0**62:
                out.append(int(u @ v))
            else:
                out.append(max(-2**63, min(2**63 - 1, sum(s * t for s, t in zip(u.tolist(), v.tolist(), strict=True)))))
        return pa.array(out, type=pa.int64())

    return dot(a, b)


def _best(df: DataFrame, k: int, *order: Column) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, scale: float = 1024.0) -> DataFrame:
    """Exact k best inner products of every query over all other vectors.

    Components become floor(scale * x).  Returns query_id, rank (from 1), vec_id, score; fewer
    than k rows if there are fewer other vectors; ties go to the smaller vec_id.  Vectors that
    are null or hold null or non-finite components, and rows without id, take no part; vectors
    of another length than the query's aren't compared with it.  A repeated vec_id is one
    candidate with its best score, and one query with its smallest vector; a query's own id is
    no candidate.  Components beyond +-2^62 and scores beyond long are held at those limits.  An
    empty table gives an empty table; other columns are not read.
    """
    scratch = Scratch(vectors.sparkSession, "va_search")
    read = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].alias("vec"), is_query.alias("is_query"))
    exact = scratch.write(read.mapInArrow(_exact(scale), "vec_id long, is_query boolean, dim int, ints binary"), "exact")
    ranges = exact.mapInArrow(_ranges, "dim int, place int, lo long, hi long").groupBy("dim", "place").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    found: dict[int, list] = {}
    for r in ranges.collect():  # as many rows as a vector has components
        found.setdefault(r["dim"], []).append((r["place"], r["lo"], r["hi"]))
    grid = {}
    for d, x in found.items():
        x.sort()
        lo, hi = np.array([y[1] for y in x], dtype=np.int64), np.array([y[2] for y in x], dtype=np.int64)
        grid[d] = lo, np.maximum(1, -(-(hi // 2 - lo // 2 + 1) * 2 // CELLS)) if (np.abs(x) > 1 << 60).any() else np.maximum(1, -(-(hi - lo + 1) // CELLS))
    cells = scratch.write(exact.mapInArrow(_cells(grid, k), "slab long, dim int, ids binary, cells binary"), "cells")

    queries = scratch.write(exact.where("is_query").groupBy(F.col("vec_id").alias("query_id"), "dim").agg(F.min("ints").alias("ints")), "queries")
    queries = queries.join(queries.groupBy(F.col("query_id").alias("of")).agg(F.min("dim").alias("least")), (F.col("query_id") == F.col("of")) & (F.col("dim") == F.col("least"))).drop("of", "least")
    blocks = max(1, -(-exact.where("is_query").count() // QUERY_BLOCK))
    dealt = queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    slabs = cells.select(F.col("slab").alias("to"), F.col("dim").alias("slab_dim"))
    left = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = dealt.join(slabs, F.col("dim") == F.col("slab_dim")).select("to", F.col("part").alias("of_part"), "query_id", "ints")
    bounds = left.groupBy("slab", "part").cogroup(right.groupBy("to", "of_part")).applyInArrow(_scan(grid, k), "query_id long, vec_id long, upper double, lower double")
    bounds = scratch.write(bounds.groupBy("query_id", "vec_id").agg(F.max("upper").alias("upper"), F.max("lower").alias("lower")), "bounds")

    kth = _best(bounds, k, F.desc("lower")).where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("lower").alias("least"))
    able = bounds.join(kth, F.col("query_id") == F.col("of"), "left").where(F.col("least").isNull() | (F.col("upper") >= F.col("least"))).select("query_id", "vec_id", "upper")
    first = _best(able, 2 * k, F.desc("upper"), F.asc("vec_id"))
    scored = scratch.write(_scores(first, exact, queries), "first")
    known = _best(scored, k, F.desc("score")).where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("score").alias("kth"))
    cut = first.where(F.col("rank") == 2 * k).select(F.col("query_id").alias("of"), F.col("upper").alias("reached"), F.col("vec_id").alias("last"))
    rest = able.join(cut, F.col("query_id") == F.col("of")).drop("of").join(known, F.col("query_id") == F.col("of"))
    after = (F.col("upper") < F.col("reached")) | (F.col("upper") == F.col("reached")) & (F.col("vec_id") > F.col("last"))
    rest = rest.where(after & (F.col("upper") >= F.col("kth"))).select("query_id", "vec_id")
    every = scored.unionByName(_scores(rest, exact, queries))
    best = _best(every, k, F.desc("score"), F.asc("vec_id"))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _scores(pairs: DataFrame, exact: DataFrame, queries: DataFrame) -> DataFrame:
    """Exact scores of (query_id, vec_id) pairs; only vectors that a pair names are read into the join."""
    of = queries.select(F.col("query_id").alias("q"), F.col("dim").alias("q_dim"), F.col("ints").alias("q_ints"))
    has = exact.select(F.col("vec_id").alias("v"), F.col("dim").alias("v_dim"), F.col("ints").alias("v_ints"))
    joined = pairs.join(has, F.col("vec_id") == F.col("v")).join(of, F.col("query_id") == F.col("q")).where(F.col("q_dim") == F.col("v_dim"))
    return joined.withColumn("score", inner_product(F.col("q_ints"), F.col("v_ints"))).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
