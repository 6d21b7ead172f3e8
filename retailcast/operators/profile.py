"""Profiling (Q1-Q6): every statistic is one aggregation pass, no driver loop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """``table_name, n_rows, n_cols, n_nulls`` in one pass over ``df``."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns]
    total = nulls[0]
    for n in nulls[1:]:
        total = total + n
    return df.agg(F.count(F.lit(1)).alias("n_rows"), total.alias("n_nulls")).select(
        F.lit(table_name).alias("table_name"), "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"), F.col("n_nulls").cast("bigint"))


def null_profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        p = null_profile(df, name)
        out = p if out is None else out.unionByName(p)
    return out


def column_nulls(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(col).isNull()).alias(f"n_null_{col}"))


def value_range(df: DataFrame, date_col: str = "date") -> DataFrame:
    """First and last date, distinct items and stores."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                  F.countDistinct("item_id").alias("n_items"),
                  F.countDistinct("store_id").alias("n_stores"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, value`` for the sorted distinct values of each column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(pairs)).distinct()
            .orderBy("column_name", F.col("value").asc_nulls_last()))


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def tail(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """Last ``n`` rows by an explicit order (never file order)."""
    return df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n).orderBy(*order_by)


def shape(df: DataFrame) -> tuple[int, int]:
    """``(rows, columns)`` -- an action; for notebooks and tests."""
    return df.count(), len(df.columns)


def shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows, n_cols`` of several tables (Q1), each counted once."""
    one = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_cols")) for name, df in tables.items()]
    out = one[0]
    for df in one[1:]:
        out = out.unionByName(df)
    return out


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First and last ``n`` rows by an explicit order (Q2), with ``side`` head or tail."""
    return head(df, n, order_by).withColumn("side", F.lit("head")).unionByName(tail(df, n, order_by).withColumn("side", F.lit("tail")))


def first_row(df: DataFrame, order_by: Sequence) -> DataFrame:
    """The first matching row under an explicit order (O7), as a one-row frame."""
    return df.orderBy(*order_by).limit(1)
