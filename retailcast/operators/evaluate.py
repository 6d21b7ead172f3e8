"""Holdout backtest.

The train-only fit lives in the same frame as the full fit (``yhat_tr``), so
the backtest is a filter plus one per-series aggregate -- no second model
pass and no join.  A test row is compared when its date falls inside the
``holdout`` calendar days after the last training day (the inner join on
``ds`` of the positional split with the calendar horizon: with gaps, fewer
than ``holdout`` days are compared, and ``n_compared`` says how many).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..constants import SERIES
from ..functions.scalar import accuracy_band, clip0, is_intermittent


def compared(holdout: int = K.HOLDOUT_DAYS) -> Column:
    return (F.col("is_test") & F.col("evaluable")
            & (F.col("ds") <= F.date_add(F.col("last_train_ds"), holdout)))


def metric_aggs(holdout: int = K.HOLDOUT_DAYS) -> list[Column]:
    """Aggregates behind MAPE/RMSE (usable inside a wider aggregation)."""
    cmp = compared(holdout) & ~F.col("is_future")
    err = F.col("y") - clip0("yhat_tr")
    nonzero = cmp & (F.col("y") > 0)
    return [F.count_if(cmp).alias("n_compared"),
            F.count_if(nonzero).alias("n_nonzero"),
            F.avg(F.when(nonzero, F.abs(err) / F.col("y"))).alias("_mape"),
            F.avg(F.when(cmp, err * err)).alias("_mse")]


def metric_columns(holdout: int = K.HOLDOUT_DAYS) -> list[Column]:
    ok = F.col("n_nonzero") > 0
    return [F.when(ok, F.col("_mape") * 100.0).alias("mape"),
            F.when(ok, F.sqrt("_mse")).alias("rmse"),
            F.col("n_compared"),
            F.lit(holdout).alias("holdout_days")]


def backtest_metrics(frame: DataFrame, holdout: int = K.HOLDOUT_DAYS) -> DataFrame:
    """MAPE (non-zero days, percent) and RMSE (all compared days) per series.

    Both are NULL when the series is too short or no compared day sold
    anything.
    """
    agg = frame.filter(~F.col("is_future")).groupBy(*SERIES).agg(*metric_aggs(holdout))
    return agg.select(*SERIES, *metric_columns(holdout))


def backtest_comparison(frame: DataFrame, holdout: int = K.HOLDOUT_DAYS) -> DataFrame:
    """Actual vs predicted rows of every series whose backtest is defined.

    ``yhat`` is clipped at 0; the band is not (as in the original backtest).
    """
    cmp = compared(holdout)
    has_nonzero = F.count_if(cmp & (F.col("y") > 0)).over(Window.partitionBy(*SERIES)) > 0
    return (frame.filter(~F.col("is_future"))
            .withColumn("_ok", has_nonzero)
            .filter(cmp & F.col("_ok"))
            .select(*SERIES, "ds", "y", clip0("yhat_tr").alias("yhat"),
                    F.col("yhat_tr_lower").alias("yhat_lower"),
                    F.col("yhat_tr_upper").alias("yhat_upper")))


def accuracy_labels(metrics: DataFrame, policy: DataFrame) -> DataFrame:
    """Accuracy band from MAPE and the intermittent-demand flag."""
    return (policy.select(*SERIES, "avg_daily_demand")
            .join(metrics.select(*SERIES, "mape"), SERIES, "left")
            .select(*SERIES, accuracy_band("mape").alias("accuracy"),
                    is_intermittent("avg_daily_demand").alias("intermittent")))
