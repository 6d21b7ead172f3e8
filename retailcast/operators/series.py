"""Per-series ordered operators.

A series is the rows of one ``(item_id, store_id)``.  On the daily grain a
series holds at most one row per calendar day, so a window partitioned by the
series is bounded by the date span, not by the data volume.  Order is always
explicit (by ``ds``), never file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import HISTORY_TAIL, HOLDOUT_DAYS, MIN_HISTORY_ROWS, BACKTEST_EXTRA_ROWS, SERIES


def by_series(*extra: str):
    return Window.partitionBy(*SERIES, *extra)


def single_series(df: DataFrame, item_id: str, store_id: str) -> DataFrame:
    """One item at one store (F2); a stored series table prunes by them, a derived frame is filtered."""
    return df.filter((F.col("item_id") == F.lit(item_id)) & (F.col("store_id") == F.lit(store_id)))


def series_size(name: str = "n_rows") -> Column:
    """Rows of the current series."""
    return F.count(F.lit(1)).over(by_series()).alias(name)


def min_history(df: DataFrame, min_rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Keep series with at least ``min_rows`` rows."""
    return df.withColumn("_n", series_size("_n")).filter(F.col("_n") >= min_rows).drop("_n")


def series_counts(df: DataFrame, min_rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Rows per series and whether the series passes the history guard."""
    return (df.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("has_history", F.col("n_rows") >= min_rows))


def rank_desc(order_col: str = "ds") -> Column:
    return F.row_number().over(by_series().orderBy(F.col(order_col).desc()))


def tail_rows(df: DataFrame, n: int = HISTORY_TAIL, order_col: str = "ds") -> DataFrame:
    """Last ``n`` rows of every series (O1); planned as a per-series top-k."""
    return df.withColumn("_r", rank_desc(order_col)).filter(F.col("_r") <= n).drop("_r")


def day_index(df: DataFrame, order_col: str = "ds", name: str = "day") -> DataFrame:
    """0-based position inside the series."""
    return df.withColumn(name, F.row_number().over(by_series().orderBy(order_col)) - 1)


def holdout_split(df: DataFrame, holdout: int = HOLDOUT_DAYS,
                  extra_rows: int = BACKTEST_EXTRA_ROWS) -> DataFrame:
    """Positional split (O2, F10): the last ``holdout`` rows are the test set.

    Adds ``n_rows``, ``is_test`` and ``evaluable`` (series has at least
    ``holdout + extra_rows`` rows).
    """
    return (df.withColumn("n_rows", series_size())
            .withColumn("is_test", rank_desc() <= holdout)
            .withColumn("evaluable", F.col("n_rows") >= holdout + extra_rows))


def after_last(df: DataFrame, history: DataFrame, ds_col: str = "ds") -> DataFrame:
    """Rows of ``df`` dated after the last observation of their series."""
    last = history.groupBy(*SERIES).agg(F.max(ds_col).alias("_last"))
    return df.join(last, SERIES).filter(F.col(ds_col) > F.col("_last")).drop("_last")


def extend_with_horizon(df: DataFrame, horizon, is_last: Column, ds_col: str = "ds") -> DataFrame:
    """Append ``horizon`` future days after the row flagged ``is_last``.

    Each row explodes to itself; the last row of a series also emits the next
    ``horizon`` days.  No shuffle: the generated rows stay in the partition of
    their series.  Adds ``is_future``; the original date is kept in ``_ds0``.
    """
    h = horizon if isinstance(horizon, Column) else F.lit(int(horizon))
    d0 = F.col("_ds0")
    days = F.when(is_last, F.sequence(d0, F.date_add(d0, h))).otherwise(F.array(d0))
    return (df.withColumnRenamed(ds_col, "_ds0")
            .withColumn(ds_col, F.explode(days.cast("array<date>")))
            .withColumn("is_future", (F.col(ds_col) > F.col("_ds0"))
                        .alias("is_future", metadata={"horizon": int(horizon)})))


def future_spine(df: DataFrame, horizon: int) -> DataFrame:
    """History dates of every series plus the next ``horizon`` days (O3)."""
    base = df.select(*SERIES, "ds").withColumn("_r", rank_desc())
    return (extend_with_horizon(base, horizon, F.col("_r") == 1)
            .select(*SERIES, "ds", "is_future"))
