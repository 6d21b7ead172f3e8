"""Aggregates kept up by appended days (A1, A2, A10): mergeable partials instead of a new pass.

A partial holds what adds up exactly: sums and counts by key.  New days bring their own partials; the
aggregate of all days is the sum over partials, the same number that a pass over all rows gives, because the
sums are whole numbers.  Means are taken at the end.  Distinct counts (items, stores) are kept as one partial row
for each distinct value, with the number of rows that hold it.

``RollupStore`` keeps the partials as Parquet, one append for each batch of days, and merges them when they are
read; ``compact`` rewrites them as one.  A batch that was appended already is not added again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a partial row is about: the mean demand of an item (A1), the sales of a day (A2), a distinct item or store (A10).
ITEM, DAY, ITEM_SEEN, STORE_SEEN = "item", "day", "item_seen", "store_seen"
#: A batch whose partials were merged into others by ``compact``.
BATCH = "batch"

SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("item_id", T.StringType()), T.StructField("cat_id", T.StringType()),
    T.StructField("dept_id", T.StringType()), T.StructField("store_id", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("total", T.LongType()), T.StructField("n", T.LongType()), T.StructField("batch_id", T.StringType())])
KEYS = ["kind", "item_id", "cat_id", "dept_id", "store_id", "date"]


def partials(sales: DataFrame) -> DataFrame:
    """Partials of some days of sales, all kinds in one pass (``grouping sets``): ``KEYS, total, n``.

    NULL sales count in no mean; rows without an item, category or department are in no item's mean, as in
    ``catalog.demand_summary``.
    """
    rows = sales.select("item_id", "cat_id", "dept_id", "store_id", F.col("date").cast("date").alias("date"), F.col("sales").cast("long").alias("sales"))
    sets = [["item_id", "cat_id", "dept_id"], ["date"], ["item_id"], ["store_id"]]
    grouped = (rows.groupingSets([[F.col(c) for c in s] for s in sets], "item_id", "cat_id", "dept_id", "store_id", "date")
               .agg(F.sum("sales").alias("total"), F.count("sales").alias("n_sales"), F.count(F.lit(1)).alias("n_rows"), F.grouping_id().alias("set")))

    def is_set(columns: list[str]) -> Column:
        # One bit for each column that is not in the set, the first column's the highest.
        at = ["item_id", "cat_id", "dept_id", "store_id", "date"]
        return F.col("set") == sum(1 << (len(at) - 1 - i) for i, c in enumerate(at) if c not in columns)

    kind = F.when(is_set(sets[0]), ITEM).when(is_set(sets[1]), DAY).when(is_set(sets[2]), ITEM_SEEN).otherwise(STORE_SEEN)
    n = F.when(kind.isin(ITEM, DAY), F.col("n_sales")).otherwise(F.col("n_rows"))
    out = grouped.select(kind.alias("kind"), *KEYS[1:], F.coalesce("total", F.lit(0)).alias("total"), n.alias("n"))
    complete = F.col("item_id").isNotNull() & F.col("cat_id").isNotNull() & F.col("dept_id").isNotNull()
    return out.where(F.when(F.col("kind") == ITEM, complete).when(F.col("kind") == ITEM_SEEN, F.col("item_id").isNotNull())
                     .when(F.col("kind") == STORE_SEEN, F.col("store_id").isNotNull()).otherwise(F.lit(True)))


def merged(parts: DataFrame) -> DataFrame:
    """Partials with one row for each key; merging merged ones gives the same."""
    return parts.where(F.col("kind") != BATCH).groupBy(*KEYS).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def demand_summary(parts: DataFrame) -> DataFrame:
    """A1 from merged partials."""
    return (parts.where(F.col("kind") == ITEM)
            .select("item_id", "cat_id", "dept_id", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("avg_daily_demand")))


def daily_total(parts: DataFrame) -> DataFrame:
    """A2 from merged partials."""
    return parts.where(F.col("kind") == DAY).select("date", F.when(F.col("n") > 0, F.col("total")).alias("total_sales"))


def kpis(parts: DataFrame) -> DataFrame:
    """Rows with a store, distinct items and stores (A10) and the first and last day, from merged partials."""
    of = F.col("kind")
    return parts.agg(F.coalesce(F.sum(F.when(of == STORE_SEEN, F.col("n"))), F.lit(0)).alias("n_rows"), F.count_if(of == ITEM_SEEN).alias("n_items"),
                     F.count_if(of == STORE_SEEN).alias("n_stores"), F.min(F.when(of == DAY, F.col("date"))).alias("first_date"), F.max(F.when(of == DAY, F.col("date"))).alias("last_date"))


class RollupStore:
    """Partials on a path, appended batch by batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def stored(self) -> DataFrame:
        """Partial rows as they were appended."""
        return self.spark.read.schema(SCHEMA).parquet(self.path) if self._exists() else self.spark.createDataFrame([], SCHEMA)

    def append(self, sales: DataFrame, batch_id: str) -> None:
        """Add a batch of days; the same batch again adds nothing (rows that a broken append left are not repeated)."""
        new = partials(sales).withColumn("batch_id", F.lit(batch_id))
        there = self.stored().where(F.col("batch_id") == batch_id)
        new = new.join(there.where(F.col("kind") == BATCH).select("batch_id"), "batch_id", "left_anti")
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEYS]
        condition = same[0]
        for c in same[1:]:
            condition = condition & c
        missing = new.alias("a").join(there.alias("b"), condition, "left_anti")
        missing.select(*SCHEMA.names).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return merged(self.stored())

    def compact(self, path: str) -> RollupStore:
        """A store at another path with one row for each key, and one for each batch in it, so that it is not
        appended again; the old store stays until its owner removes it."""
        out, stored = RollupStore(self.spark, path), self.stored()
        rows = merged(stored).withColumn("batch_id", F.lit(None).cast("string")).select(*SCHEMA.names)
        batches = stored.select("batch_id").where("batch_id IS NOT NULL").distinct().select(
            *[F.lit(BATCH).alias(f.name) if f.name == "kind" else F.col("batch_id") if f.name == "batch_id" else F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])
        rows.unionByName(batches).write.mode("errorifexists").parquet(out.path)
        return out
