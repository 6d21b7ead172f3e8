"""Training-corpus pipeline: quality rules, line dedup, near-duplicates, source mix, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of documents; the last returns the packed pieces.

Every stage gives a defined result for null ids, texts and sources, equal rows, empty tables and other columns
of any name (see the operators' docstrings; the columns that a stage adds never replace a document's own).
Before a stage begins, the executors' Python workers hand back what earlier stages have left in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.llm.icws import drop_near_duplicates
from retailcast.llm.line_dedup import dedup_lines
from retailcast.llm.line_freq import keep_good_documents
from retailcast.llm.mixing import mix_sources
from retailcast.llm.packing import forget_words, pack_documents
from retailcast.llm.queries import tokenizer_file
from retailcast.llm.shared import Scratch, free_name


def give_back(spark: SparkSession) -> None:
    """Idle Python workers return free memory and the words that packing learnt to the system: they keep
    them otherwise, and the next stage's memory comes on top.  Two short tasks for each core; nothing is
    read or written."""
    def release(batches):
        import ctypes
        import gc
        import time

        import pyarrow as pa
        for _ in batches:
            pass
        forget_words()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
        if trim is not None:
            trim(0)
        time.sleep(0.1)  # so that one worker doesn't take all the tasks
        return iter(())

    n = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).mapInArrow(release, "id long").write.format("noop").mode("overwrite").save()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line-frequency verdict reject go; lines above the limits are removed.

    A null or empty text fails the base rules; equal rows go or stay together; no documents give none."""
    give_back(spark)
    return keep_good_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents hold stay in the last of them only.

    A document without an id keeps its lines; a document that loses all of them stays, with an empty text."""
    give_back(spark)
    return _sized(dedup_lines(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    Of equal rows one stays; documents too short for a shingle are compared as a whole."""
    give_back(spark)
    return drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (a document without words takes part no further).

    A null source is one of its own; columns named like one that the mix adds keep their values."""
    give_back(spark)
    added = {"size", "source_size", "target", "taken"}
    own: dict[str, str] = {}
    for c in docs.columns:
        own[c] = free_name([*docs.columns, *added, *own.values()], f"own_{c}") if c.lower() in added else c
    mixed = mix_sources(docs.withColumnsRenamed({c: n for c, n in own.items() if c != n}))
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(F.lit(0))
    # A document is taken twice at most; none for 0.
    copies = F.explode(F.array_repeat(F.lit(1), times))
    names = [F.col(f"`{n}`").alias(c) for c, n in own.items()]
    return mixed.select(*[F.col(f"`{n}`") for n in own.values()], copies.alias(free_name(own.values(), "copy"))).select(*names)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces packed into sequences of at most 2048 tokens.

    A null or empty text is one piece with the end token; no documents give no pieces."""
    give_back(spark)
    return pack_documents(docs, tokenizer_file(), with_ids=False)


def _sized(kept: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with n_chars of the text as it is now."""
    if "n_chars" in columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*columns)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-duplicates", near_duplicates), ("source mix", mixture), ("best-fit packing", packing)]

#: Weighted sampling, hashing and packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage_{i}", codec="snappy")
    return STAGES[-1][1](spark, docs, sf_dir)
