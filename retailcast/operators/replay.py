"""Inventory replay (O5, O6): stock level day by day under a policy.

Start with one EOQ in stock.  Each day, if stock <= ROP an EOQ arrives at once
(and the day is marked as an order); then ``stock = max(0, stock - demand)``.

Plan shape: the days are partitioned by series and sorted by date, and a *state scan* goes
over them once: it holds the level of the current series and nothing else, so time is linear
in the days and a task's memory does not depend on how long a series is.  The policy of a series comes
from a window over the same partitioning (its own future days) or from a table of policies.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SERIES
from ..functions.scalar import round_half_up
from .policy import PARAM_COLS, PolicyParams, future_days, inventory_policy, policy_columns

KEYS = [*SERIES, "param_set"]
LEVELS = "item_id string, store_id string, param_set int, day int, ds date, demand double, level double, ordered boolean, rop double, eoq double"


def _starts(batch: pa.RecordBatch) -> np.ndarray:
    """Whether a row has another key than the row before it (the first row: True)."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[:1] = True
    for name in KEYS:
        codes = batch.column(batch.schema.get_field_index(name)).dictionary_encode().indices.fill_null(-1).to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return new


def scan_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and date -> the same rows with day, level and order flag."""
    key, level, day = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        new = _starts(batch)
        first = tuple(col[k][0].as_py() for k in KEYS)
        new[0] = key != first
        key = tuple(col[k][batch.num_rows - 1].as_py() for k in KEYS)
        levels, flags, days = [], [], []
        for fresh, demand, rop, eoq in zip(new.tolist(), col["demand"].to_pylist(), col["rop"].to_pylist(), col["eoq"].to_pylist(), strict=True):
            if fresh:
                level, day = eoq, 0
            ordered = level is not None and rop is not None and level <= rop
            if ordered and eoq is not None:
                level += eoq
            # A missing policy or demand leaves no level from there on.
            level = None if level is None or demand is None else max(0.0, level - demand)
            levels.append(level)
            flags.append(ordered)
            days.append(day)
            day += 1
        out = [col["item_id"], col["store_id"], col["param_set"], pa.array(days, pa.int32()), col["ds"], col["demand"], pa.array(levels, pa.float64()), pa.array(flags, pa.bool_()), col["rop"], col["eoq"]]
        yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in LEVELS.split(", ")])


def _scan(days: DataFrame) -> DataFrame:
    """``item_id, store_id, param_set, ds, demand, rop, eoq`` (partitioned by series) through the scan."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = days.select(*SERIES, F.col("param_set").cast("int"), "ds", *[F.col(c).cast("double") for c in ("demand", "rop", "eoq")])
    return rows.sortWithinPartitions(*KEYS, "ds").mapInArrow(scan_levels, LEVELS)


def replay(frame: DataFrame, params: PolicyParams | Sequence[PolicyParams] = PolicyParams(),
           demand_col: str = "yhat", precision: int | None = None) -> DataFrame:
    """One row per series-day: ``day`` (0-based), ``ds``, ``demand``, ``level``, ``ordered``.

    Demand is the clipped forecast by default (any daily column of the frame
    can be used).  ``precision`` rounds demand, ROP and EOQ to that many
    decimals before the scan (used to compare engines bit for bit).
    """
    days = future_days(frame, params).withColumn("demand", F.col(demand_col)).repartition(*SERIES)
    whole = Window.partitionBy(*SERIES, *PARAM_COLS, "z")
    days = days.withColumns({"avg_daily_demand": F.avg("yhat").over(whole), "std_daily_demand": F.stddev_samp("yhat").over(whole),
                             "avg_price": F.first("avg_price").over(whole)})
    days = days.select(*SERIES, "param_set", "ds", "demand",
                       *policy_columns(F.col("avg_daily_demand"), F.col("std_daily_demand"), F.col("avg_price")))
    return _scan(_rounded(days, precision))


def _rounded(days: DataFrame, precision: int | None) -> DataFrame:
    if precision is None:
        return days
    return days.withColumns({c: round_half_up(c, precision) for c in ("demand", "rop", "eoq")})


def replay_history(frame: DataFrame, params: PolicyParams | Sequence[PolicyParams] = PolicyParams(),
                   precision: int | None = None) -> DataFrame:
    """The replay over every past day: actual demand (missing: 0) under the policy of the forecast.

    What a policy would have done over the whole history, however long it is.
    """
    policy = inventory_policy(frame, params).select(*KEYS, "rop", "eoq")
    days = frame.where(~F.col("is_future")).select(*SERIES, "ds", F.coalesce(F.greatest(F.col("y"), F.lit(0.0)), F.lit(0.0)).alias("demand"))
    return _scan(_rounded(days.join(policy, SERIES).repartition(*SERIES), precision))


def replay_orders(levels: DataFrame) -> DataFrame:
    """Orders placed per series over the replay."""
    return (levels.groupBy(*SERIES, "param_set")
            .agg(F.count_if("ordered").cast("bigint").alias("n_orders"),
                 F.count(F.lit(1)).alias("n_days"),
                 F.min("level").alias("min_level")))
