"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

ROWS = 1 << 19


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``; label is the least node of its component.

    Each round takes the least label among neighbours (a partial aggregate, so a node with
    very many links costs a task one row) and then the label's own label, which halves the
    distances; rounds end when no label changes.  Every round is written, so a lost executor
    costs a part of one round, by a task for each core at least and each ``ROWS`` links: the rounds
    are many and their tables small, and a session may deal them to any number of partitions.
    """
    both = scratch.write_few(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}_graph")
    tasks = max(scratch.spark.sparkContext.defaultParallelism, -(-both.count() // ROWS))
    labels, round_ = scratch.write_few(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}_labels_0", tasks), 0
    while True:
        round_ += 1
        of = labels.select(F.col("node").alias("n"), F.col("label").alias("l"))
        near = both.join(of, F.col("b") == F.col("n")).groupBy("a").agg(F.min("l").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = low.join(of, F.col("label") == F.col("n"), "left").select("node", "old", F.least("label", F.coalesce("l", "label")).alias("label"))
        new = scratch.write_few(jump, f"{name}_labels_{round_}", tasks)
        done = new.where(F.col("label") != F.col("old")).isEmpty()
        scratch.drop(labels)
        labels = new.select("node", "label")
        scratch.paths[id(labels)] = scratch.paths.pop(id(new))
        scratch.kept.append(labels)
        if done:
            return labels


def joined(scratch: Scratch, labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``labels`` after further links: only the links between components are looked at."""

    def end(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(f"{side}_node"), F.col("label").alias(f"{side}_label"))

    ends = links.join(end("a"), F.col("a") == F.col("a_node"), "left").join(end("b"), F.col("b") == F.col("b_node"), "left")
    ends = ends.select("a", "b", F.coalesce("a_label", "a").alias("la"), F.coalesce("b_label", "b").alias("lb"))
    between = components(scratch, ends.select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a <> b").distinct(), name)
    between = between.select(F.col("node").alias("old"), F.col("label").alias("new"))
    nodes = labels.unionByName(between.select(F.col("old").alias("node"), F.col("old").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
    merged = nodes.join(between, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label"))
    return scratch.write_few(merged, f"{name}_joined")
