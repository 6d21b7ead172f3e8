"""Saved forecast runs: build, read back, filter, rank.

A run is one policy row (one series under one parameter set); its days are the
future forecast rows.  Every function takes and returns DataFrames and builds
filters as Column expressions -- never SQL text from user values.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..constants import SERIES
from ..functions.scalar import round_half_up
from .ids import dense_ids

RUN_COLUMNS = ["run_id", "run_at", "item_id", "store_id", "forecast_days", "lead_time_days",
               "ordering_cost", "holding_cost", "avg_daily_demand", "std_daily_demand",
               "safety_stock", "rop", "eoq", "mape", "rmse"]
DAILY_COLUMNS = ["run_id", "ds", "yhat", "yhat_lower", "yhat_upper"]

# FIXED VALUES: decimals shown for saved runs.
ROUNDING = {"avg_daily_demand": 2, "std_daily_demand": 2, "safety_stock": 1, "rop": 1,
            "eoq": 1, "mape": 1, "rmse": 2}


def next_run_id(runs: DataFrame) -> Column:
    """``coalesce(max(run_id), 0)`` as a scalar subquery (O9); the first new id
    is this plus one."""
    return runs.select(F.coalesce(F.max("run_id"), F.lit(0))).scalar()


def build_runs(policy: DataFrame, metrics: DataFrame | None, run_at: _dt.datetime | Column,
               start: Column | int = 0, per_run_minutes: bool = False) -> DataFrame:
    """Policy rows + backtest metrics -> run rows with dense ids.

    ``metrics`` may be None when ``policy`` already carries ``mape, rmse``
    (``policy.series_summary``), which saves the join.  Ids follow
    ``(param_set, item_id, store_id)``.  ``run_at`` is one literal per batch;
    with ``per_run_minutes`` each run is stamped ``run_at + run_id`` minutes
    (a deterministic stand-in for saving runs one after another).
    """
    if metrics is None:
        joined = policy
    else:
        joined = policy.drop("mape", "rmse").join(metrics.select(*SERIES, "mape", "rmse"),
                                                  SERIES, "left")
    numbered = dense_ids(joined, ["param_set", "item_id", "store_id"], start, "run_id")
    ts = run_at if isinstance(run_at, Column) else F.lit(run_at).cast("timestamp_ntz")
    if per_run_minutes:
        ts = F.timestamp_add("MINUTE", F.col("run_id"), ts)
    return numbered.select("param_set", *[
        (ts.alias("run_at") if c == "run_at" else F.col(c)) for c in RUN_COLUMNS])


def build_daily(future: DataFrame, runs: DataFrame) -> DataFrame:
    """Future forecast days tagged with their run id."""
    ids = runs.select(*SERIES, "param_set", "run_id")
    return future.join(ids, [*SERIES, "param_set"]).select(*DAILY_COLUMNS)


def _rounded(cols: Sequence[str]) -> list[Column]:
    return [round_half_up(c, ROUNDING[c]).alias(c) if c in ROUNDING else F.col(c) for c in cols]


def latest_runs(runs: DataFrame, limit: int = K.SAVED_RUNS_LIMIT) -> DataFrame:
    """Newest runs first, rounded for display (T1); ties broken by id."""
    return (runs.select(*_rounded(RUN_COLUMNS))
            .orderBy(F.col("run_at").desc(), F.col("run_id").desc()).limit(limit))


QUERY_COLUMNS = ["run_id", "run_at", "item_id", "store_id", "avg_daily_demand",
                 "safety_stock", "rop", "eoq", "mape", "rmse"]


def filter_runs(runs: DataFrame, item_id: str | None = None, store_id: str | None = None) -> DataFrame:
    """Optional conjunctive filters; a falsy value means no filter."""
    cond = F.lit(True)
    if item_id:
        cond = cond & (F.col("item_id") == F.lit(item_id))
    if store_id:
        cond = cond & (F.col("store_id") == F.lit(store_id))
    return runs.filter(cond)


def query_runs(runs: DataFrame, item_id: str | None = None, store_id: str | None = None,
               top_n_by_demand: int | None = None) -> DataFrame:
    """Filtered runs by rounded demand, descending, optional top-n."""
    df = (filter_runs(runs, item_id, store_id).select(*_rounded(QUERY_COLUMNS))
          .orderBy(F.col("avg_daily_demand").desc_nulls_last(), F.col("run_id")))
    return df.limit(top_n_by_demand) if top_n_by_demand else df


def runs_kpis(latest: DataFrame) -> DataFrame:
    """Count, distinct items, distinct stores and mean MAPE of the shown runs (A10)."""
    return latest.agg(F.count(F.lit(1)).alias("n_runs"),
                      F.countDistinct("item_id").alias("n_items"),
                      F.countDistinct("store_id").alias("n_stores"),
                      F.avg("mape").alias("avg_mape"))


# FIXED VALUES: sort choices of the saved-runs view (column, ascending).
SORT_OPTIONS = {
    "Most recent first": ("run_at", False),
    "Highest avg demand": ("avg_daily_demand", False),
    "Lowest MAPE (best fit)": ("mape", True),
    "Highest EOQ": ("eoq", False),
}


def sort_runs(runs: DataFrame, sort_col: str, ascending: bool) -> DataFrame:
    """User-chosen sort with missing values last (T4), ties by run id."""
    key = F.col(sort_col).asc_nulls_last() if ascending else F.col(sort_col).desc_nulls_last()
    return runs.orderBy(key, F.col("run_id"))


def explore_runs(latest: DataFrame, sort: str, item_id: str | None = None, store_id: str | None = None) -> DataFrame:
    """Shown runs -> filtered (F5), sorted (T4), under their display names (R5), with their place as ``position``.

    At most the view's limit of rows is sorted (a top-k of the newest runs came before).
    """
    column, ascending = SORT_OPTIONS[sort]
    chosen = filter_runs(latest, item_id, store_id)
    key = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    placed = chosen.withColumn("position", F.row_number().over(Window.orderBy(key, F.col("run_id"))))
    return placed.select("position", *[F.col(k).alias(v) for k, v in DISPLAY_NAMES.items()]).orderBy("position")


def run_forecast(daily: DataFrame, run_id: int) -> DataFrame:
    """Days of one run in date order."""
    return (daily.filter(F.col("run_id") == F.lit(run_id))
            .select("ds", "yhat", "yhat_lower", "yhat_upper").orderBy("ds"))


def runs_with_days(runs: DataFrame, daily: DataFrame) -> DataFrame:
    """Every run joined to its daily rows."""
    return runs.join(daily, "run_id")


# FIXED VALUES: display names of the saved-runs table.
DISPLAY_NAMES = {
    "run_id": "Run #",
    "run_at": "Timestamp",
    "item_id": "Product",
    "store_id": "Store",
    "forecast_days": "Horizon (days)",
    "lead_time_days": "Lead Time",
    "avg_daily_demand": "Avg Demand/day",
    "safety_stock": "Safety Stock",
    "rop": "ROP",
    "eoq": "EOQ",
    "mape": "MAPE (%)",
    "rmse": "RMSE",
}
