"""Side-by-side comparison of two products at one store.

Instead of one pair per button click, a ``pairs`` table ``(store_id, item_a,
item_b)`` is compared in one pass: the pair is fanned out into its two slots
(a literal two-element generator), joined to the per-series summary, turned
into metric rows and pivoted back to the columns ``A`` and ``B``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import demand_ratio, pick_by, symmetric_ratio

# FIXED VALUES: metric rows of the comparison table, in display order.
METRICS = [
    ("avg_daily_demand", "Avg Daily Demand"),
    ("std_daily_demand", "Demand Std Dev"),
    ("total_forecast", "Total Forecast"),
    ("safety_stock", "Safety Stock"),
    ("rop", "Reorder Point (ROP)"),
    ("eoq", "Economic Order Qty (EOQ)"),
    ("mape", "MAPE (Backtest)"),
    ("rmse", "RMSE (Backtest)"),
]

SUMMARY_COLS = [m for m, _ in METRICS]


def top_pairs(summary: DataFrame) -> DataFrame:
    """Per store, the two items with the highest mean demand (A = first)."""
    w = Window.partitionBy("store_id").orderBy(F.col("avg_daily_demand").desc_nulls_last(),
                                               F.col("item_id"))
    ranked = summary.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 2)
    return (ranked.groupBy("store_id")
            .agg(F.max(F.when(F.col("_r") == 1, F.col("item_id"))).alias("item_a"),
                 F.max(F.when(F.col("_r") == 2, F.col("item_id"))).alias("item_b"))
            .filter(F.col("item_b").isNotNull()))


def compare_metrics(summary: DataFrame, pairs: DataFrame) -> DataFrame:
    """Metric rows x (A, B) columns for every pair.

    ``summary``: ``item_id, store_id, forecast_days`` + the columns of METRICS.
    """
    slots = pairs.select("store_id", "item_a", "item_b",
                         F.inline(F.array(
                             F.struct(F.lit("A").alias("slot"), F.col("item_a").alias("item_id")),
                             F.struct(F.lit("B").alias("slot"), F.col("item_b").alias("item_id")))))
    joined = slots.join(summary, ["store_id", "item_id"])
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("metric_no"),
                 (F.format_string("Total Forecast (%d days)", F.col("forecast_days"))
                  if col == "total_forecast" else F.lit(label)).alias("metric"),
                 F.col(col).cast("double").alias("value"))
        for i, (col, label) in enumerate(METRICS)])
    long = joined.select("store_id", "item_a", "item_b", "slot", F.inline(rows))
    return (long.groupBy("store_id", "item_a", "item_b", "metric_no", "metric")
            .pivot("slot", ["A", "B"]).agg(F.first("value")))


def compare_takeaway(summary: DataFrame, pairs: DataFrame) -> DataFrame:
    """Demand ratio, which item sells more, which needs more safety stock."""
    s = summary.select("store_id", "item_id", "avg_daily_demand", "safety_stock")
    a = s.toDF("store_id", "item_a", "avg_a", "ss_a")
    b = s.toDF("store_id", "item_b", "avg_b", "ss_b")
    j = pairs.join(a, ["store_id", "item_a"]).join(b, ["store_id", "item_b"])
    return _takeaway(j)


def compare_top_two(summary: DataFrame) -> DataFrame:
    """Per store, compare the two items with the highest mean demand.

    Single pass over the summary: a per-store top-2 window (planned as a
    group limit before the exchange), the metric rows, and a pivot -- no join.
    """
    w = Window.partitionBy("store_id").orderBy(F.col("avg_daily_demand").desc_nulls_last(),
                                               F.col("item_id"))
    wa = Window.partitionBy("store_id")
    top = (summary.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 2)
           .withColumn("item_a", F.max(F.when(F.col("_r") == 1, F.col("item_id"))).over(wa))
           .withColumn("item_b", F.max(F.when(F.col("_r") == 2, F.col("item_id"))).over(wa))
           .filter(F.col("item_b").isNotNull())
           .withColumn("slot", F.when(F.col("_r") == 1, F.lit("A")).otherwise(F.lit("B"))))
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("metric_no"),
                 (F.format_string("Total Forecast (%d days)", F.col("forecast_days"))
                  if col == "total_forecast" else F.lit(label)).alias("metric"),
                 F.col(col).cast("double").alias("value"))
        for i, (col, label) in enumerate(METRICS)])
    long = top.select("store_id", "item_a", "item_b", "slot", F.inline(rows))
    return (long.groupBy("store_id", "item_a", "item_b", "metric_no", "metric")
            .pivot("slot", ["A", "B"]).agg(F.first("value")))


def takeaway_top_two(summary: DataFrame) -> DataFrame:
    """Takeaway of ``compare_top_two`` in one aggregation per store."""
    w = Window.partitionBy("store_id").orderBy(F.col("avg_daily_demand").desc_nulls_last(),
                                               F.col("item_id"))
    top = summary.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 2)
    a, b = F.col("_r") == 1, F.col("_r") == 2
    j = (top.groupBy("store_id")
         .agg(F.max(F.when(a, F.col("item_id"))).alias("item_a"),
              F.max(F.when(b, F.col("item_id"))).alias("item_b"),
              F.max(F.when(a, F.col("avg_daily_demand"))).alias("avg_a"),
              F.max(F.when(b, F.col("avg_daily_demand"))).alias("avg_b"),
              F.max(F.when(a, F.col("safety_stock"))).alias("ss_a"),
              F.max(F.when(b, F.col("safety_stock"))).alias("ss_b"))
         .filter(F.col("item_b").isNotNull()))
    return _takeaway(j)


def _takeaway(j: DataFrame) -> DataFrame:
    ratio = demand_ratio("avg_a", "avg_b")
    return j.select(
        "store_id", "item_a", "item_b",
        ratio.alias("demand_ratio"),
        pick_by(ratio >= 1, "item_a", "item_b").alias("higher_item"),
        pick_by(ratio >= 1, "item_b", "item_a").alias("lower_item"),
        symmetric_ratio(ratio).alias("ratio_val"),
        pick_by(F.col("ss_a") >= F.col("ss_b"), "item_a", "item_b").alias("higher_ss_item"))