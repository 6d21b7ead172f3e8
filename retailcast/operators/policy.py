"""Inventory policy (I1-I5, A3, A4, A7, A8) from a forecast frame.

The frame (see ``seasonal.seasonal_frame`` or ``additive_model.map_frame``) is
already partitioned by series, so every per-series aggregate below is a
``groupBy`` that Spark plans without another exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..constants import SERIES
from ..functions.scalar import clip0


@dataclass(frozen=True)
class PolicyParams:
    forecast_days: int = K.DEFAULT_HORIZON
    lead_time_days: int = K.DEFAULT_LEAD_TIME
    ordering_cost: float = K.DEFAULT_ORDERING_COST
    holding_cost: float = K.DEFAULT_HOLDING_COST
    z: float = K.Z_SERVICE  # the service level is fixed at 95 %


def check_horizon(frame: DataFrame, params: PolicyParams | Sequence[PolicyParams]) -> None:
    """Raise if more days are asked for than the frame forecasts (its horizon is kept as
    metadata of ``is_future``); a frame without that note is taken as it is."""
    horizon = frame.schema["is_future"].metadata.get("horizon")
    sets = [params] if isinstance(params, PolicyParams) else list(params)
    most = max(p.forecast_days for p in sets)
    if horizon is not None and most > horizon:
        raise ValueError(f"forecast_days={most}, but the frame holds {horizon} future days; build it with a longer horizon")


def with_params(frame: DataFrame, params: PolicyParams | Sequence[PolicyParams]) -> DataFrame:
    """Attach parameter columns.  A list of parameter sets fans every row out
    once per set (a literal-array generator: no join, the set list is tiny and
    its size is known on the driver); ``param_set`` numbers the sets from 1."""
    sets = [params] if isinstance(params, PolicyParams) else list(params)
    structs = [F.struct(F.lit(i + 1).alias("param_set"),
                        F.lit(int(p.forecast_days)).alias("forecast_days"),
                        F.lit(int(p.lead_time_days)).alias("lead_time_days"),
                        F.lit(float(p.ordering_cost)).alias("ordering_cost"),
                        F.lit(float(p.holding_cost)).alias("holding_cost"),
                        F.lit(float(p.z)).alias("z"))
               for i, p in enumerate(sets)]
    if len(structs) == 1:
        return frame.select("*", structs[0].alias("_p")).select(*frame.columns, "_p.*")
    return frame.select("*", F.inline(F.array(*structs)))


def future_days(frame: DataFrame, params: PolicyParams | Sequence[PolicyParams] = PolicyParams()) -> DataFrame:
    """The forecast days after the last observation, clipped at 0."""
    check_horizon(frame, params)
    fr = with_params(frame.filter(F.col("is_future")), params)
    return (fr.withColumn("h", F.date_diff("ds", "last_ds"))
            .filter(F.col("h") <= F.col("forecast_days"))
            .withColumn("yhat", clip0("yhat"))
            .withColumn("yhat_lower", clip0("yhat_lower"))
            .withColumn("yhat_upper", clip0("yhat_upper")))


def policy_columns(avg: Column, std: Column, price: Column) -> list[Column]:
    """Safety stock, reorder point and EOQ (I1-I3) from aggregated inputs."""
    lead = F.col("lead_time_days").cast("double")
    ss = F.col("z") * std * F.sqrt(lead)
    annual = avg * F.lit(float(K.DAYS_PER_YEAR))
    eoq = F.sqrt(F.try_divide(F.lit(2.0) * annual * F.col("ordering_cost"),
                              F.col("holding_cost") * price))
    return [ss.alias("safety_stock"), (avg * lead + ss).alias("rop"), eoq.alias("eoq")]


PARAM_COLS = ["param_set", "forecast_days", "lead_time_days", "ordering_cost", "holding_cost"]


def inventory_policy(frame: DataFrame,
                     params: PolicyParams | Sequence[PolicyParams] = PolicyParams()) -> DataFrame:
    """One policy row per series (and parameter set) (I4).

    ``std`` is the sample std of the clipped *forecast*, NULL for one day
    (then safety stock and ROP are NULL; EOQ is still defined).  EOQ is NULL
    for a zero price (``try_divide``).
    """
    days = future_days(frame, params)
    agg = (days.groupBy(*SERIES, *PARAM_COLS, "z")
           .agg(F.avg("yhat").alias("avg_daily_demand"),
                F.stddev_samp("yhat").alias("std_daily_demand"),
                F.first("avg_price").alias("avg_price")))
    return agg.select(*SERIES, *PARAM_COLS, "avg_daily_demand", "std_daily_demand",
                      *policy_columns(F.col("avg_daily_demand"), F.col("std_daily_demand"),
                                      F.col("avg_price")),
                      "avg_price")


def forecast_insights(frame: DataFrame,
                      params: PolicyParams | Sequence[PolicyParams] = PolicyParams()) -> DataFrame:
    """Total, peak and lowest day, mean upper bound of the future window.

    Ties go to the earliest day, like a first-occurrence arg max.
    """
    days = future_days(frame, params).withColumn("_u", F.unix_date("ds"))
    return (days.groupBy(*SERIES, "param_set")
            .agg(F.coalesce(F.sum("yhat"), F.lit(0.0)).alias("total_forecast"),
                 F.max_by("ds", F.struct(F.col("yhat"), -F.col("_u"))).alias("peak_ds"),
                 F.max("yhat").alias("peak_yhat"),
                 F.min_by("ds", F.struct(F.col("yhat"), F.col("_u"))).alias("low_ds"),
                 F.min("yhat").alias("low_yhat"),
                 F.avg("yhat_upper").alias("avg_upper")))


def series_summary(frame: DataFrame,
                   params: PolicyParams | Sequence[PolicyParams] = PolicyParams(),
                   holdout: int = K.HOLDOUT_DAYS) -> DataFrame:
    """Policy, forecast total and backtest metrics per series in ONE aggregation.

    Conditional aggregates pick the future window (for the policy and the
    total) and the compared test days (for MAPE/RMSE) out of the same
    series-partitioned frame, so the frame is read once and nothing is joined.
    """
    from .evaluate import metric_aggs, metric_columns
    check_horizon(frame, params)
    fr = with_params(frame, params)
    fut = F.col("is_future") & (F.date_diff("ds", "last_ds") <= F.col("forecast_days"))
    yh = F.when(fut, clip0("yhat"))
    agg = (fr.groupBy(*SERIES, *PARAM_COLS, "z")
           .agg(F.avg(yh).alias("avg_daily_demand"),
                F.stddev_samp(yh).alias("std_daily_demand"),
                F.first("avg_price").alias("avg_price"),
                F.coalesce(F.sum(yh), F.lit(0.0)).alias("total_forecast"),
                *metric_aggs(holdout)))
    return agg.select(*SERIES, *PARAM_COLS, "avg_daily_demand", "std_daily_demand",
                      "total_forecast",
                      *policy_columns(F.col("avg_daily_demand"), F.col("std_daily_demand"),
                                      F.col("avg_price")),
                      "avg_price", *metric_columns(holdout))
