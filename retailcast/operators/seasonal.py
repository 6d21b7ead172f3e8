"""Columnar seasonal forecast (M6, with M2-M4 outputs) and the backtest fit.

Model per series: a least-squares line on the day number ``t`` plus a
day-of-week mean and a month mean of the residuals;
``yhat = a + b*t + weekly[dow] + yearly[month]``, band ``yhat +- z*sd`` with
``sd`` the sample std of the final residuals.  Weekdays or months never seen
in training contribute 0.

Plan shape: the input is hash-partitioned once by series.  Future days are
generated next to the last row of each series (no shuffle), with ``y = NULL``,
and every coefficient is a window aggregate over the whole series, all with
the same ``(series, ds)`` order: weekday and month effects are conditional
means over the series window, not windows keyed by weekday or month, so the
frame is never re-sorted by them.  The whole model is one exchange, two sorts
and a chain of window passes.  Aggregates skip NULL, so future rows pick up
the coefficients without a join.

The same pass fits a second model on the training rows only (all but the last
``holdout`` rows) for the backtest: its target ``y_tr`` is NULL on test rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..constants import SERIES
from .series import extend_with_horizon



def _effects(col: str, key: str, n: int, w: Window) -> Column:
    """Per-series mean of ``col`` for the current row's ``key`` (1..n).

    One conditional mean per key value over the series window, then a pick by
    the row's key: the same numbers as a window keyed by ``(series, key)`` but
    without re-sorting the frame by that key.
    """
    means = F.array(*[F.avg(F.when(F.col(key) == k, F.col(col))).over(w) for k in range(1, n + 1)])
    return F.coalesce(F.element_at(means, F.col(key)), F.lit(0.0))


def seasonal_frame(model_input: DataFrame, horizon: int = K.DEFAULT_HORIZON,
                   holdout: int = K.HOLDOUT_DAYS,
                   min_rows: int = K.MIN_HISTORY_ROWS,
                   backtest_extra_rows: int = K.BACKTEST_EXTRA_ROWS,
                   band_z: float = K.BAND_Z) -> DataFrame:
    """History + ``horizon`` future days per series with both fits.

    ``model_input``: ``item_id, store_id, ds, y`` and optionally ``sell_price``.
    Series with fewer than ``min_rows`` rows get no rows at all (guard F9).

    Every window shares the order ``(series, ds)`` (whole-series frames for the
    aggregates), so the frame is sorted twice in total: once for the history
    statistics and once after the future days are generated.
    """
    order = Window.partitionBy(*SERIES).orderBy("ds")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = set(model_input.columns)
    price = F.col("sell_price") if "sell_price" in cols else F.lit(None).cast("double")
    base = model_input.select(*SERIES, "ds", F.col("y").cast("double").alias("y"),
                              price.alias("sell_price"))
    staged = (base
              .withColumns({"n_rows": F.count(F.lit(1)).over(whole),
                            "first_ds": F.min("ds").over(whole),
                            "last_ds": F.max("ds").over(whole),
                            "_rn": F.row_number().over(order)})
              .withColumn("rn_desc", F.col("n_rows") - F.col("_rn") + 1)
              .filter(F.col("n_rows") >= min_rows))
    ext = extend_with_horizon(staged, horizon, F.col("rn_desc") == 1)
    hist = ~F.col("is_future")
    evaluable = F.col("n_rows") >= holdout + backtest_extra_rows
    is_test = hist & (F.col("rn_desc") <= holdout)
    train = hist & (F.col("rn_desc") > holdout) & evaluable
    fr = ext.withColumns({
        "y": F.when(hist, F.col("y")),
        "sell_price": F.when(hist, F.col("sell_price")),
        "is_test": is_test,
        "evaluable": evaluable,
        "is_train": train,
        "t": F.date_diff("ds", "first_ds").cast("double"),
        "dow": F.dayofweek("ds"),
        "month": F.month("ds")})
    fr = fr.withColumn("y_tr", F.when(F.col("is_train"), F.col("y")))
    # Pass 1: trend lines (full and train), price mean, last training day.
    fr = fr.withColumns({
        "a": F.regr_intercept("y", "t").over(whole),
        "b": F.regr_slope("y", "t").over(whole),
        "a_tr": F.regr_intercept("y_tr", "t").over(whole),
        "b_tr": F.regr_slope("y_tr", "t").over(whole),
        "avg_price": F.avg("sell_price").over(whole),
        "last_train_ds": F.max(F.when(F.col("is_train"), F.col("ds"))).over(whole)})
    trend = F.col("a") + F.col("b") * F.col("t")
    trend_tr = F.col("a_tr") + F.col("b_tr") * F.col("t")
    fr = fr.withColumns({"trend": trend, "trend_tr": trend_tr,
                         "e": F.col("y") - trend, "e_tr": F.col("y_tr") - trend_tr})
    # Pass 2: weekday effect; pass 3: month effect of what is left.
    fr = fr.withColumns({"weekly": _effects("e", "dow", 7, whole),
                         "weekly_tr": _effects("e_tr", "dow", 7, whole)})
    fr = fr.withColumns({"_r": F.col("e") - F.col("weekly"),
                         "_r_tr": F.col("e_tr") - F.col("weekly_tr")})
    fr = fr.withColumns({"yearly": _effects("_r", "month", 12, whole),
                         "yearly_tr": _effects("_r_tr", "month", 12, whole)})
    # Pass 4: residual spread -> band.
    fr = fr.withColumns({"sd": F.stddev_samp(F.col("_r") - F.col("yearly")).over(whole),
                         "sd_tr": F.stddev_samp(F.col("_r_tr") - F.col("yearly_tr")).over(whole)})
    z = F.lit(band_z)
    yhat = F.col("trend") + F.col("weekly") + F.col("yearly")
    yhat_tr = F.col("trend_tr") + F.col("weekly_tr") + F.col("yearly_tr")
    return fr.select(
        *SERIES, "ds", "is_future", "y", "n_rows", "last_ds", "rn_desc",
        "avg_price", "is_test", "evaluable", "last_train_ds",
        "trend", "weekly", "yearly",
        yhat.alias("yhat"),
        (yhat - z * F.col("sd")).alias("yhat_lower"),
        (yhat + z * F.col("sd")).alias("yhat_upper"),
        yhat_tr.alias("yhat_tr"),
        (yhat_tr - z * F.col("sd_tr")).alias("yhat_tr_lower"),
        (yhat_tr + z * F.col("sd_tr")).alias("yhat_tr_upper"),
    )


def forecast(frame: DataFrame) -> DataFrame:
    """History + future forecast with band and components (M2-M4)."""
    return frame.select(*SERIES, "ds", "is_future", "yhat", "yhat_lower", "yhat_upper",
                        "trend", "weekly", "yearly")
