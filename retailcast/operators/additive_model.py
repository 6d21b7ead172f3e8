"""Additive trend + seasonality model (M1-M4), fitted per series.

Model (the published "forecasting at scale" form, Taylor & Letham 2018), in
scaled units ``y / max|y|`` and ``t in [0, 1]`` over the history::

    g(t) = k*t + m + sum_j delta_j * max(t - s_j, 0)          # 25 changepoints
    s(d) = sum_i a_i sin(2 pi i d / 365.25) + b_i cos(...)     # yearly, order 10
         + sum_i c_i sin(2 pi i d / 7)      + e_i cos(...)     # weekly, order 3
    y    = g + s + noise(sigma)

with ``d`` the day number since 1970-01-01.  Priors: ``k, m ~ N(0, 5)``,
seasonal coefficients ``~ N(0, 10)``, ``delta ~ Laplace(0, 0.05)``.  The MAP
fit is iteratively reweighted ridge (the Laplace prior as a reweighted
quadratic), a fixed number of iterations on the normal equations.

Plan shape: the normal equations are native sums by (series, fit, segment between changepoints, weekday)
(``gram``), computed with the history's series partitioning.  The only Python step solves
them, for many series in one Arrow batch, and emits a small row of coefficients for each fit (all of the
history, and its training part).  Prediction is native: the model row is joined
back to the per-series spine and trend and seasonality are evaluated as a fixed
set of plain arithmetic terms over the coefficient arrays (whole-stage codegen,
no interpreted lambdas; changepoint arrays are padded to 25), so the forecast frame
has exactly the columns of ``seasonal.seasonal_frame`` and every downstream
operator (policy, backtest, replay, runs) works on either model.

Band: the trend uncertainty of future changepoints has the closed form
``var = (2/3) * S * lambda^2 * (T - 1)^3`` for scaled time ``T > 1``
(changepoints at rate ``S`` per unit time, Laplace(``lambda``) jumps,
``lambda = mean|delta|``); added to ``sigma^2`` and scaled back.  The original
method samples this; the closed form gives the same variance without sampling.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..constants import SERIES
from ..session import cut_lineage
from . import gram
from .series import extend_with_horizon

# FIXED VALUES: model configuration.
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_PRIOR = 0.05
SEASONALITY_PRIOR = 10.0
TREND_PRIOR = 5.0
YEAR_PERIOD, YEAR_ORDER = 365.25, 10
WEEK_PERIOD, WEEK_ORDER = 7.0, 3
IRLS_ITERATIONS = 20
#: Series whose matrices are solved at once.
SOLVE_TOGETHER = 256

SCALARS = "ds0 int, span double, y_scale double, k double, m double, n_cp int, sigma double, lam double"
ARRAYS = ["cp", "delta", "beta_year", "beta_week"]
FITTED = f"item_id string, store_id string, fit string, {SCALARS}, " + ", ".join(f"{c} array<double>" for c in ARRAYS)


def _scaled_rows(history: DataFrame) -> DataFrame:
    """Rows of each fit (``full`` has all of a series, ``train`` the training days) with scaled time and value, and the
    number of changepoints before the row.

    A day without a finite value tells nothing about the series: it is left out of the fit.
    """
    finite = F.col("y").isNotNull() & ~F.isnan("y") & (F.abs("y") < F.lit(float("inf")))
    fits = F.explode(F.when(F.col("is_train"), F.array(F.lit("full"), F.lit("train"))).otherwise(F.array(F.lit("full"))))
    rows = history.where(finite).select(*SERIES, F.unix_date("ds").alias("day"), F.col("y").alias("y0"), fits.alias("fit"))
    order = Window.partitionBy(*SERIES, "fit").orderBy("day")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"n": F.count(F.lit(1)).over(whole), "row": F.row_number().over(order) - 1, "ds0": F.min("day").over(whole),
                             "last": F.max("day").over(whole), "most": F.max(F.abs("y0")).over(whole),
                             "low": F.min("y0").over(whole), "high": F.max("y0").over(whole)})
    # A constant series, or one of a single day, has its mean as the whole model.
    rows = rows.withColumns({"flat": (F.col("n") < 2) | (F.col("last") <= F.col("ds0")) | (F.col("low") == F.col("high")),
                             "span": F.greatest((F.col("last") - F.col("ds0")).cast("double"), F.lit(1.0)),
                             "y_scale": F.when(F.col("most") > 0, F.col("most")).otherwise(F.lit(1.0))})
    hist = F.floor(F.col("n") * F.lit(CHANGEPOINT_RANGE)).cast("int")
    rows = rows.withColumns({"t": (F.col("day") - F.col("ds0")) / F.col("span"), "y": F.col("y0") / F.col("y_scale"),
                             "n_cp": F.least(F.lit(N_CHANGEPOINTS), F.greatest(hist - 1, F.lit(0)))})
    # Changepoint j stands at row rint(j * step): evenly over the first part of the history.
    step = (hist - 1) / F.col("n_cp")
    before = F.filter(F.sequence(F.lit(1), F.col("n_cp")), lambda j: F.rint(j * step) < F.col("row"))
    rows = rows.withColumn("segment", F.when(F.col("n_cp") > 0, F.size(before)).otherwise(F.lit(0)))
    at_next = (F.col("segment") < F.col("n_cp")) & (F.rint((F.col("segment") + 1) * step) == F.col("row"))
    return rows.withColumn("cp", F.when(at_next, F.col("t")))


def _fitter(year_order: int, week_order: int):
    """Sums of many series -> their coefficients."""
    n_year = 2 * year_order

    def fit(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SOLVE_TOGETHER):
                yield _solved(batch.slice(at, SOLVE_TOGETHER))

    def _solved(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        sums, cps = gram.sums_of(batch, N_CHANGEPOINTS + 1), gram.changepoints_of(batch, N_CHANGEPOINTS)
        n_cp, flat = col["n_cp"].to_numpy().astype(int), col["flat"].to_numpy(zero_copy_only=False)
        normal = gram.Normal(sums, cps, n_cp, year_order, week_order)
        priors = np.empty(normal.p)
        priors[:2], priors[2:] = 1.0 / TREND_PRIOR ** 2, 1.0 / SEASONALITY_PRIOR ** 2
        theta, sigma2 = gram.solve(normal, priors, CHANGEPOINT_PRIOR, IRLS_ITERATIONS)
        theta[flat] = 0.0
        theta[flat, 1] = (normal.y_sum / normal.n)[flat]
        delta = theta[:, normal.hinges]
        lam = np.abs(delta).sum(axis=1) / np.maximum(n_cp, 1) + 1e-8
        lists = {"cp": cps * ~flat[:, None], "delta": delta, "beta_year": theta[:, normal.hinges.stop:normal.hinges.stop + n_year], "beta_week": theta[:, normal.hinges.stop + n_year:]}
        values = {c: col[c] for c in ("item_id", "store_id", "fit", "ds0", "span", "y_scale")}
        values |= {"k": pa.array(theta[:, 0]), "m": pa.array(theta[:, 1]), "n_cp": pa.array(np.where(flat, 0, n_cp).astype(np.int32)),
                   "sigma": pa.array(np.where(flat, 0.0, np.sqrt(sigma2))), "lam": pa.array(np.where(flat | (n_cp == 0), 0.0, lam))}
        values |= {c: pa.array(list(v), type=pa.list_(pa.float64())) for c, v in lists.items()}
        names = [f.split()[0] for f in FITTED.split(", ")]
        return pa.RecordBatch.from_arrays([values[n] for n in names], names=names)

    return fit


def fit_models(history: DataFrame) -> DataFrame:
    """One model row per series: ``item_id, store_id, full, train``.

    ``history``: ``item_id, store_id, ds, y, is_train``.  The normal equations are sums by
    (series, fit, segment, weekday), planned with the series partitioning of ``history``; Python gets
    them for many series at once and solves these together.  A series without a finite value has no row.
    """
    # Ship the solver by value: executors need not have this package installed (only NumPy and Arrow).
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(gram)
    rows = _scaled_rows(history)
    keep = ["ds0", "span", "y_scale", "n_cp", "flat"]
    sums = gram.segment_sums(rows, keep, YEAR_PERIOD, YEAR_ORDER)
    fitted = sums.mapInArrow(_fitter(YEAR_ORDER, WEEK_ORDER), FITTED)
    model = F.struct(F.date_from_unix_date("ds0").alias("ds0"), "span", "y_scale", "k", "m", "n_cp", *ARRAYS, "sigma", "lam")
    models = fitted.select(*SERIES, "fit", model.alias("model")).groupBy(*SERIES).agg(
        *[F.first(F.when(F.col("fit") == f, F.col("model")), ignorenulls=True).alias(f) for f in ("full", "train")])
    # A row of sums holds some 120 KB, a model row 1 KB; the models are read by several branches.
    return cut_lineage(models, arrow_rows=SOLVE_TOGETHER)


def _predict(m: Column, ds: Column) -> dict[str, Column]:
    """Native prediction of one model struct at date ``ds``.

    A fixed number of plain arithmetic terms (25 hinges, 20 + 6 Fourier terms)
    rather than higher-order functions, so whole-stage codegen compiles it.
    """
    day = F.unix_date(ds).cast("double")
    t = (day - F.unix_date(m["ds0"]).cast("double")) / m["span"]
    cp, delta = m["cp"], m["delta"]
    hinge = sum((delta[j] * F.greatest(t - cp[j], F.lit(0.0)) for j in range(1, N_CHANGEPOINTS)),
                delta[0] * F.greatest(t - cp[0], F.lit(0.0)))
    trend = (m["k"] * t + m["m"] + hinge) * m["y_scale"]

    def seasonal(beta: Column, period: float, order: int) -> Column:
        terms = []
        for i in range(1, order + 1):
            w = F.lit(2.0 * math.pi * i / period) * day
            terms.append(beta[2 * i - 2] * F.sin(w) + beta[2 * i - 1] * F.cos(w))
        return sum(terms[1:], terms[0]) * m["y_scale"]

    yearly = seasonal(m["beta_year"], YEAR_PERIOD, YEAR_ORDER)
    weekly = seasonal(m["beta_week"], WEEK_PERIOD, WEEK_ORDER)
    extra = F.when(t > 1, F.lit(2.0 / 3.0) * m["n_cp"] * m["lam"] * m["lam"] * F.pow(t - 1, 3)) \
        .otherwise(F.lit(0.0))
    sd = F.sqrt(m["sigma"] * m["sigma"] + extra) * m["y_scale"]
    return {"trend": trend, "yearly": yearly, "weekly": weekly, "sd": sd}


def predict_components(models: DataFrame, spine: DataFrame, band_z: float = K.BAND_Z) -> DataFrame:
    """Prediction from a table of coefficients (M2-M4): ``item_id, store_id, ds, yhat, yhat_lower, yhat_upper, trend, weekly, yearly``.

    ``models``: ``item_id, store_id, model`` with the fields of ``fit_models``' structs, from wherever it
    comes; ``spine``: ``item_id, store_id, ds``.  Days of a series without a model are left out.
    """
    at = _predict(F.col("model"), F.col("ds"))
    fr = spine.join(models.select(*SERIES, "model"), SERIES).select(*SERIES, "ds", *[at[c].alias(c) for c in ("trend", "weekly", "yearly", "sd")])
    yhat = F.col("trend") + F.col("weekly") + F.col("yearly")
    return fr.select(*SERIES, "ds", yhat.alias("yhat"), (yhat - band_z * F.col("sd")).alias("yhat_lower"), (yhat + band_z * F.col("sd")).alias("yhat_upper"), "trend", "weekly", "yearly")


def projected_models(history: DataFrame) -> DataFrame:
    """A table of coefficients by plain projection: ``item_id, store_id, model`` (no iteration, all native sums).

    The trend is the least-squares line; the jump at changepoint j is a tenth of the difference
    between the means after and before it; each seasonal coefficient is twice the mean of the scaled value
    times its wave.  A quick start model of the same form as the fit, and the same numbers in any SQL engine.
    """
    base = history.where(F.col("y").isNotNull()).select(*SERIES, "ds", F.unix_date("ds").cast("double").alias("day"), F.col("y").cast("double").alias("y"))
    whole = Window.partitionBy(*SERIES)
    base = base.withColumns({"d0": F.min("day").over(whole), "span": F.greatest(F.max("day").over(whole) - F.min("day").over(whole), F.lit(1.0)), "most": F.max(F.abs("y")).over(whole)})
    base = base.withColumn("y_scale", F.when(F.col("most") > 0, F.col("most")).otherwise(F.lit(1.0)))
    base = base.withColumns({"t": (F.col("day") - F.col("d0")) / F.col("span"), "v": F.col("y") / F.col("y_scale")})
    cps = [CHANGEPOINT_RANGE * j / N_CHANGEPOINTS for j in range(1, N_CHANGEPOINTS + 1)]

    def waves(period: float, order: int) -> Column:
        angles = [F.lit(2.0 * math.pi * i / period) * F.col("day") for i in range(1, order + 1)]
        return F.array(*[F.lit(2.0) * F.avg(F.col("v") * f(a)) for a in angles for f in (F.sin, F.cos)])

    jumps = F.array(*[F.coalesce(F.lit(0.1) * (F.avg(F.when(F.col("t") > s, F.col("v"))) - F.avg(F.when(F.col("t") <= s, F.col("v")))), F.lit(0.0)) for s in cps])
    sums = base.groupBy(*SERIES).agg(
        F.min("ds").alias("ds0"), F.first("span").alias("span"), F.first("y_scale").alias("y_scale"), F.coalesce(F.regr_slope("v", "t"), F.lit(0.0)).alias("k"),
        F.coalesce(F.regr_intercept("v", "t"), F.avg("v")).alias("m"), jumps.alias("delta"), waves(YEAR_PERIOD, YEAR_ORDER).alias("beta_year"),
        waves(WEEK_PERIOD, WEEK_ORDER).alias("beta_week"), F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("sigma"))
    lam = F.aggregate("delta", F.lit(0.0), lambda a, d: a + F.abs(d)) / N_CHANGEPOINTS
    model = F.struct("ds0", "span", "y_scale", "k", "m", F.lit(N_CHANGEPOINTS).alias("n_cp"), F.array(*[F.lit(s) for s in cps]).alias("cp"), "delta", "beta_year", "beta_week", "sigma", lam.alias("lam"))
    return sums.select(*SERIES, model.alias("model"))


def map_frame(model_input: DataFrame, horizon: int = K.DEFAULT_HORIZON,
              holdout: int = K.HOLDOUT_DAYS, min_rows: int = K.MIN_HISTORY_ROWS,
              backtest_extra_rows: int = K.BACKTEST_EXTRA_ROWS,
              band_z: float = K.BAND_Z) -> DataFrame:
    """Forecast frame (same columns as ``seasonal_frame``) from the fitted model."""
    order = Window.partitionBy(*SERIES).orderBy("ds")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = set(model_input.columns)
    price = F.col("sell_price") if "sell_price" in cols else F.lit(None).cast("double")
    # A row is a few bytes but costs 40 sines in the fit and 100 in the prediction: partitions are
    # kept as they are, not merged by their size.
    n = int(model_input.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = model_input.select(*SERIES, "ds", F.col("y").cast("double").alias("y"),
                              price.alias("sell_price")).repartition(n, *SERIES)
    staged = (base
              .withColumns({"n_rows": F.count(F.lit(1)).over(whole),
                            "last_ds": F.max("ds").over(whole),
                            "avg_price": F.avg("sell_price").over(whole),
                            "_rn": F.row_number().over(order)})
              .withColumn("rn_desc", F.col("n_rows") - F.col("_rn") + 1)
              .filter(F.col("n_rows") >= min_rows))
    staged = staged.withColumns({
        "evaluable": F.col("n_rows") >= holdout + backtest_extra_rows,
        "is_train": (F.col("rn_desc") > holdout) & (F.col("n_rows") >= holdout + backtest_extra_rows)})
    staged = staged.withColumn("last_train_ds",
                               F.max(F.when(F.col("is_train"), F.col("ds"))).over(whole))
    models = fit_models(staged)
    ext = extend_with_horizon(staged, horizon, F.col("rn_desc") == 1)
    hist = ~F.col("is_future")
    fr = (ext.withColumns({"y": F.when(hist, F.col("y")),
                           "is_test": hist & (F.col("rn_desc") <= holdout)})
          .join(models, SERIES, "left"))
    full = _predict(F.col("full"), F.col("ds"))
    tr = _predict(F.col("train"), F.col("ds"))
    # Components once as columns; everything else refers to them.
    fr = fr.withColumns({"trend": full["trend"], "weekly": full["weekly"],
                         "yearly": full["yearly"], "_sd": full["sd"],
                         "_trend_tr": tr["trend"], "_weekly_tr": tr["weekly"],
                         "_yearly_tr": tr["yearly"], "_sd_tr": tr["sd"]})
    fr = fr.withColumns({"yhat": F.col("trend") + F.col("weekly") + F.col("yearly"),
                         "yhat_tr": F.col("_trend_tr") + F.col("_weekly_tr") + F.col("_yearly_tr")})
    z = F.lit(band_z)
    return fr.select(
        *SERIES, "ds", "is_future", "y", "n_rows", "last_ds", "rn_desc", "avg_price",
        "is_test", "evaluable", "last_train_ds", "trend", "weekly", "yearly", "yhat",
        (F.col("yhat") - z * F.col("_sd")).alias("yhat_lower"),
        (F.col("yhat") + z * F.col("_sd")).alias("yhat_upper"),
        "yhat_tr",
        (F.col("yhat_tr") - z * F.col("_sd_tr")).alias("yhat_tr_lower"),
        (F.col("yhat_tr") + z * F.col("_sd_tr")).alias("yhat_tr_upper"))
