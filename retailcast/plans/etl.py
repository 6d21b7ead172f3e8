"""Curated sales table (composition C1): melt -> calendar -> prices -> filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.reshape import melt
from ..sources.clustered import ClusteredTable


def attach_calendar(long: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on ``d`` (J1).  No hint: a calendar of one row per day is broadcast by its
    measured size, another one isn't."""
    cal = calendar.select("d", F.col("date").cast("date").alias("date"), "wm_yr_wk")
    return long.join(cal, "d", "left")


def attach_prices(long: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join on (store_id, item_id, wm_yr_wk) (J2).  Prices grow with the
    catalogue, so no hint: AQE broadcasts them only if they turn out small."""
    return long.join(prices, ["store_id", "item_id", "wm_yr_wk"], "left")


def keep_priced(df: DataFrame) -> DataFrame:
    """Drop days without a price: the item was not on sale yet (F1)."""
    return df.filter(F.col("sell_price").isNotNull())


CLEAN_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id",
                 "d", "sales", "date", "wm_yr_wk", "sell_price"]


def priced_long(long: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Long sales with date, week and price attached, before the price filter."""
    return attach_prices(attach_calendar(long, calendar), prices).select(*CLEAN_COLUMNS)


def clean_long(long: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    return keep_priced(priced_long(long, calendar, prices))


def build_sales_clean(wide: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Wide sales + calendar + weekly prices -> the curated long table."""
    return clean_long(melt(wide), calendar, prices)


CLEAN_SCHEMA = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("id", "item_id", "dept_id", "cat_id", "state_id", "d")],
    T.StructField("sales", T.IntegerType()), T.StructField("date", T.DateType()),
    T.StructField("wm_yr_wk", T.IntegerType()), T.StructField("sell_price", T.DoubleType()),
    T.StructField("store_id", T.StringType())])


def curated_table(spark: SparkSession, path: str, buckets: int = 8) -> ClusteredTable:
    """The curated table by store folders, bucketed by item and sorted by item and date: one series is one file's few row groups."""
    return ClusteredTable(spark, path, CLEAN_SCHEMA, "item_id", ["item_id", "date"], buckets, ["store_id"])


def write_curated(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write partitioned by store so store filters prune whole folders."""
    df.write.mode(mode).partitionBy("store_id").parquet(path)
