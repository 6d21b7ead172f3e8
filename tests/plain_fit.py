"""The additive model's fit of one series with its design matrix written out (the reference of the tests)."""
import math

import numpy as np

from retailcast.operators.additive_model import (CHANGEPOINT_PRIOR, CHANGEPOINT_RANGE, IRLS_ITERATIONS, N_CHANGEPOINTS, SEASONALITY_PRIOR, TREND_PRIOR, WEEK_ORDER,
                                                 WEEK_PERIOD, YEAR_ORDER, YEAR_PERIOD)


def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    cols = []
    for i in range(1, order + 1):
        w = 2.0 * math.pi * i * days / period
        cols.append(np.sin(w))
        cols.append(np.cos(w))
    return np.column_stack(cols)


def fit_series(days: np.ndarray, y: np.ndarray) -> dict:
    """MAP fit of one series. ``days``: day numbers since 1970 (sorted)."""
    n = len(y)
    d0 = days[0]
    span = float(days[-1] - d0)
    y_scale = float(np.max(np.abs(y))) if n else 0.0
    flat = {"ds0": int(d0), "span": max(span, 1.0), "y_scale": y_scale, "k": 0.0,
            "m": 1.0 if y_scale > 0 else 0.0, "n_cp": 0,
            "cp": [0.0] * N_CHANGEPOINTS, "delta": [0.0] * N_CHANGEPOINTS,
            "beta_year": [0.0] * (2 * YEAR_ORDER), "beta_week": [0.0] * (2 * WEEK_ORDER),
            "sigma": 0.0, "lam": 0.0}
    if n < 2 or span <= 0 or y_scale == 0.0 or float(np.ptp(y)) == 0.0:
        flat["y_scale"] = y_scale if y_scale > 0 else 1.0
        flat["m"] = float(np.mean(y)) / flat["y_scale"] if n else 0.0
        return flat
    t = (days - d0) / span
    ys = y / y_scale
    hist = int(math.floor(n * CHANGEPOINT_RANGE))
    n_cp = min(N_CHANGEPOINTS, max(hist - 1, 0))
    if n_cp > 0:
        idx = np.linspace(0, hist - 1, n_cp + 1).round().astype(int)[1:]
        cps = t[idx]
    else:
        cps = np.zeros(0)
    hinge = np.maximum(t[:, None] - cps[None, :], 0.0) if n_cp else np.zeros((n, 0))
    X = np.column_stack([t, np.ones(n), hinge, _fourier(days.astype(float), YEAR_PERIOD, YEAR_ORDER),
                         _fourier(days.astype(float), WEEK_PERIOD, WEEK_ORDER)])
    p = X.shape[1]
    base_prec = np.empty(p)
    base_prec[:2] = 1.0 / TREND_PRIOR ** 2
    base_prec[2 + n_cp:] = 1.0 / SEASONALITY_PRIOR ** 2
    XtX, Xty = X.T @ X, X.T @ ys
    delta = np.full(n_cp, CHANGEPOINT_PRIOR)
    sigma2 = max(float(np.var(ys)), 1e-6)
    theta = np.zeros(p)
    for _ in range(IRLS_ITERATIONS):
        prec = base_prec.copy()
        prec[2:2 + n_cp] = 1.0 / (CHANGEPOINT_PRIOR * np.maximum(np.abs(delta), 1e-6))
        A = XtX / sigma2 + np.diag(prec)
        theta = np.linalg.solve(A, Xty / sigma2)
        delta = theta[2:2 + n_cp]
        resid = ys - X @ theta
        sigma2 = max(float(np.mean(resid ** 2)), 1e-10)
    ny = 2 * YEAR_ORDER
    pad = [0.0] * (N_CHANGEPOINTS - n_cp)  # padded: delta 0 adds nothing
    return {"ds0": int(d0), "span": span, "y_scale": y_scale, "k": float(theta[0]),
            "m": float(theta[1]), "n_cp": n_cp, "cp": [float(c) for c in cps] + pad,
            "delta": [float(v) for v in delta] + pad,
            "beta_year": [float(v) for v in theta[2 + n_cp:2 + n_cp + ny]],
            "beta_week": [float(v) for v in theta[2 + n_cp + ny:]],
            "sigma": math.sqrt(sigma2),
            "lam": float(np.mean(np.abs(delta))) + 1e-8 if n_cp else 0.0}
