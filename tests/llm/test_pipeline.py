"""The pipeline's stages, each on what the one before kept, against brute force or the operator's own answer."""
from collections import Counter

import corpus_pipeline as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retailcast.llm.icws import near_duplicates
from retailcast.llm.line_dedup import dedup_lines
from retailcast.llm.line_freq import quality_rules
from retailcast.llm.mixing import mix_sources

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (-1, "", "en", "src0", 0), (-2, " \n", None, None, 2), (-3, "word " * 40, "en", None, 200)]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema)).cache()


def test_stages_one_after_another(spark, documents, tmp_path):
    docs, names = documents, [n for n, _ in P.STAGES]
    assert names == ["quality rules", "line dedup", "near-duplicates", "source mix", "best-fit packing"]
    kept = {}
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        kept[name] = (docs, after := spark.read.parquet(f"{tmp_path}/{i}"))
        if i < 4:
            assert after.columns == documents.columns
        docs = after
    before, after = kept["quality rules"]
    good = quality_rules(before).where("kept").select("doc_id")
    assert rows(after, "doc_id") == rows(good, "doc_id") and after.where("n_chars <> length(text)").count() == 0
    before, after = kept["line dedup"]
    assert rows(after, "doc_id", "text") == rows(dedup_lines(before), "doc_id", "text")
    before, after = kept["near-duplicates"]
    classes = {r["doc_id"]: r["class_id"] for r in near_duplicates(before).collect()}
    chosen = [r["doc_id"] for r in after.select("doc_id").collect()]
    assert sorted(classes[d] for d in chosen) == sorted(set(classes.values()))  # one of each class
    assert not rows(after, "doc_id", "text") - rows(before, "doc_id", "text")
    before, after = kept["source mix"]
    want = Counter({(r["doc_id"],): r["taken"] // r["size"] for r in mix_sources(before).where("taken > 0").collect()})
    assert rows(after, "doc_id") == want and max(want.values()) <= 2
    before, after = kept["best-fit packing"]
    assert rows(after.where("piece = 0"), "doc_id") == rows(before, "doc_id")
    bins = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert bins.where("n > 2048 OR n <> end").count() == 0


def test_columns_named_like_the_mix_own(spark, documents):
    docs = documents.withColumnsRenamed({"n_chars": "size"}).withColumn("taken", F.lit("t")).withColumn("times", F.lit(1)).withColumn("copy", F.lit(2))
    out = P.mixture(spark, docs, SF)
    assert out.columns == docs.columns
    sizes = {r["doc_id"]: r["size"] for r in docs.where("doc_id >= 0").collect()}
    got = out.where("doc_id >= 0").collect()
    assert got and all(r["size"] == sizes[r["doc_id"]] and r["taken"] == "t" and r["times"] == 1 and r["copy"] == 2 for r in got)


def test_no_documents(spark, documents, tmp_path):
    docs = documents.limit(0)
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.count() == 0 and "sequence_id" in docs.columns


def test_workers_forget_words_before_a_stage(spark, documents):
    def look(batches):
        import sys
        import time
        for _ in batches:
            pass
        time.sleep(0.1)
        kept = sys.modules["tokenizers"].__dict__.get("_loaded_by_text") if "tokenizers" in sys.modules else None
        yield pa.RecordBatch.from_pydict({"words": [sum(len(w.young) + len(w.old) for w in (kept or {}).values())]})

    def most_words():
        n = 4 * spark.sparkContext.defaultParallelism
        return spark.range(0, n, 1, n).mapInArrow(look, "words long").agg(F.max("words")).first()[0]

    P.packing(spark, documents, SF).count()
    assert most_words() > 0
    P.give_back(spark)
    assert most_words() == 0
