"""Mixing sources to target weights by hash-threshold histograms.

Tokens are summed by source and hash bucket; the bucket in which a source's budget
ends is refined, and only that one, until it holds a single hash; then a filter on the
hash takes the documents.  Nothing is sorted by document, and the work of a refinement
is one scan of (source, hash, size).  Rows that are equal in id, source and text share a hash: where a
budget ends among them, so many of them are taken as come nearest to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import rank_within
from .shared import Scratch, free_name, words_count

#: The hash has 63 bits; each level of histograms looks at so many of them.
HASH_BITS, LEVEL_BITS = 63, 9


def _hash(docs: DataFrame, columns: list[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[docs[c] for c in columns]), 1)


def ranked_sources(scratch: Scratch, sizes: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0, by code point, null last) to one row per source.

    A range-partitioned sort numbers the rows in each partition; the offsets come from
    the partitions' counts (as many numbers as shuffle partitions).
    """
    put = sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    put = scratch.write(put.withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "sources")
    counts, offsets, at = {r["part"]: r["n"] for r in put.groupBy("part").agg(F.count("*").alias("n")).collect()}, [], 0
    for p in sorted(counts):
        offsets += [F.lit(p), F.lit(at)]
        at += counts[p]
    rank = F.create_map(*offsets)[F.col("part")] + F.col("place") if offsets else F.col("place")
    return put.withColumn("rank", rank.cast("long")).drop("part", "place")


def fill_targets(scratch: Scratch, sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """Adds ``target``: shares of ``share`` x all sizes by weight, none above ``most`` x its source's size.

    The excess of sources that reach their limit is reshared by weight until none is above:
    every other source gets one level times its weight.  Each round is one aggregate.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sizes = scratch.write(ranked_sources(scratch, sizes).withColumn("weight", weight.cast("long")), "ranked")
    level = None
    while True:
        full = F.lit(False) if level is None else F.lit(level) * F.col("weight") >= F.lit(most) * F.col("source_size")
        total, taken, open_weight = sizes.agg(F.sum("source_size"), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        now = (share * (total or 0) - most * (taken or 0)) / open_weight if open_weight else level or 0.0
        if now == level:
            break
        level = now
    return sizes.withColumn("target", F.least(F.lit(float(most)) * F.col("source_size"), F.lit(float(level)) * F.col("weight")))


def thresholds(scratch: Scratch, slim: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source ``times`` (whole passes) and ``below``: hashes under it get one pass more, and of the rows
    whose hash is ``edge`` so many as ``take`` says (null: the hash has one row)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = targets.withColumn("times", whole.cast("long"))
    state = state.withColumn("need", F.col("target") - F.col("times") * F.col("source_size"))
    state = state.select("source", "source_size", "target", "times", "need", F.lit(0).cast("long").alias("below"), F.lit(None).cast("long").alias("edge"), F.lit(None).cast("long").alias("take"), (F.col("need") > 0).alias("open"))
    state, shift = scratch.write(state, "state"), HASH_BITS
    while shift > 0 and not state.where("open").isEmpty():
        last, shift = shift, max(0, shift - LEVEL_BITS)
        open_ = state.where("open").select(F.col("source").alias("of"), F.shiftright("below", last).alias("prefix"))
        inside = slim.join(open_, slim["source"].eqNullSafe(F.col("of")) & (F.shiftright("hash", last) == F.col("prefix")))
        hist = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("sum"), F.min("hash").alias("lo"), F.max("hash").alias("hi"), F.count(F.lit(1)).alias("rows"))
        before = F.sum("sum").over(Window.partitionBy("source").orderBy("bucket")) - F.col("sum")
        hist = hist.withColumn("before", before).select(F.col("source").alias("of"), "bucket", "sum", "lo", "hi", "rows", "before")
        met = state.where("open").join(hist, F.col("source").eqNullSafe(F.col("of")) & (F.col("before") < F.col("need")) & (F.col("before") + F.col("sum") >= F.col("need")), "left")
        one = F.col("lo") == F.col("hi")
        alike = one & (F.col("rows") > 1)
        some = F.round((F.col("need") - F.col("before")) * F.col("rows") / F.col("sum")).cast("long")
        nearer = F.col("need") - F.col("before") > F.col("before") + F.col("sum") - F.col("need")
        met = met.select("source", "source_size", "target", "times", (F.col("need") - F.coalesce("before", F.lit(0))).alias("need"),
                         F.when(F.col("bucket").isNull(), F.col("below")).when(alike, F.col("lo")).when(one, F.col("lo") + F.when(nearer, 1).otherwise(0)).otherwise(F.shiftleft("bucket", shift)).alias("below"),
                         F.when(alike, F.col("lo")).alias("edge"), F.when(alike, some).alias("take"),
                         F.coalesce(~one, F.lit(False)).alias("open"))
        state = scratch.write(state.where("not open").unionByName(met), f"state_{shift}")
    return state


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Choose how often each document is taken, so that every source comes near its target.

    Sizes are words; sources in code-point order (null is a source of its own, last) weigh
    ``weights``, repeating, and share ``share`` x all sizes; a target stops at ``most`` x its
    source's size and the excess is reshared by weight.  Returns every row of ``docs`` with its
    columns and ``size``, ``source_size``, ``target`` (its source's), ``taken`` (size x number of
    passes).  Which documents get the extra pass is a matter of their hash (id, source and
    text) alone, so reruns agree; of rows that are equal in all three, where the target ends among
    them, the ones with the largest hash over all columns get it (rows that are equal in every column are
    alike).  Null text has size 0.  An empty table gives an empty table.  Input columns named like
    an added one are replaced; other columns may have any names.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {"size", "source_size", "target", "taken"}])
    out_columns = [*docs.columns, "size", "source_size", "target", "taken"]
    scratch = Scratch(spark, "mixing")
    sized = docs.withColumn("size", words_count(docs[text_col]))
    slim = scratch.write(sized.select(F.col(source_col).cast("string").alias("source"), _hash(docs, [id_col, source_col, text_col]).alias("hash"), "size"), "slim")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = scratch.write(fill_targets(scratch, sizes, list(weights), share, most), "targets")
    state = thresholds(scratch, slim, targets)
    own = {c: free_name([*out_columns, *state.columns], f"mix_{c}") for c in ("of", "source_size", "target", "times", "below", "edge", "take", "hash", "rank", "any", "all")}
    state = state.select(F.col("source").alias(own["of"]), *[F.col(c).alias(own[c]) for c in ("source_size", "target", "times", "below", "edge", "take")])
    met = sized.withColumn(own["hash"], _hash(docs, [id_col, source_col, text_col])).join(state, sized[source_col].cast("string").eqNullSafe(F.col(own["of"])))
    col = {c: F.col(n) for c, n in own.items()}

    def result(rows: DataFrame, extra: Column) -> DataFrame:
        taken = F.col("size") * (col["times"] + F.when(extra, 1).otherwise(0))
        return rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("size"), col["source_size"].alias("source_size"), col["target"].alias("target"), taken.cast("long").alias("taken"))

    if state.where(col["take"].isNotNull()).isEmpty():
        return result(met, col["hash"] < col["below"])
    # The rows at an edge are numbered over ranges; a third of all rows may be alike.
    at_edge = F.coalesce(col["hash"] == col["edge"], F.lit(False))
    marked = met.where(at_edge).withColumns({own["all"]: F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`").alias("c"))) for c in docs.columns]), own["any"]: F.monotonically_increasing_id()})
    ranked = rank_within(marked, own["of"], own["all"], own["any"], name=own["rank"])
    return result(met.where(~at_edge), col["hash"] < col["below"]).unionByName(result(ranked, col["rank"] <= col["take"]))
