"""Normal equations of the additive model as native sums, and one solve for many series (M1).

The design matrix of a series has the columns (n_cp is 25 at most)::

    t, 1, h_1 .. h_ncp, sin/cos(2 pi i d / 365.25) i = 1..10, sin/cos(2 pi i d / 7) i = 1..3

with ``t`` scaled to [0, 1], ``h_j = max(t - s_j, 0)`` and d the day's number.  X'X has 1,431
different entries, but they need far fewer sums:

* Between two changepoints every hinge is ``t - s_j`` or 0.  So with sums by *segment* (the number of
  changepoints before a row), ``sum h_j f`` is ``sum t f - s_j sum f`` over the segments from j on, for
  every column f, and ``sum h_j h_k`` needs count, ``sum t`` and ``sum t^2`` only.
* A weekly column depends on the weekday only.  So with sums by weekday too, every product with it
  follows from the other column's sums of the seven days.
* A product of two yearly columns is half a sum of two cosines or sines of the sums and differences
  of their angles, so all 210 products come from the sums of 20 angles.

These are plain ``sum`` aggregates of Spark, grouped by (series, fit, segment, weekday).  The fit
itself (a fixed number of reweighted ridge solves) needs X'X, X'y and y'y only: the sum of squared residuals
is ``y'y - 2 b'X'y + b'X'X b``.  It runs over Arrow batches of many series at once, as stacked
matrices.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SERIES

#: Sums of a cell, in this order: count, t, t^2, y, t y, y^2; then the yearly columns' own sums, with t, and
#: with y; then the sines and cosines of the angles beyond the columns' own that their products need.
PLAIN = ["1.0D", "t", "t * t", "y", "t * y", "y * y"]
WEEKDAYS = 7


def segment_sums(rows: DataFrame, keep: list[str], year: float, year_order: int) -> DataFrame:
    """``item_id, store_id, fit, segment, t, y, day, cp`` -> one row per (series, fit) with ``sums``: an array over
    the cells (segment, weekday) of these two, the sums as one array, and the changepoint that ends the segment.

    ``keep``: columns that are the same in all rows of a fit, handed on.
    """
    # Four years of 365.25 days are whole days: a small angle has exact sines.  Expressions are SQL text,
    # because making hundreds of column objects takes longer than the sums.
    angle = f"pmod(day, {round(4 * year)}) * {2.0 * math.pi / year!r}D"
    waves = [f"{f}(angle * {i})" for i in range(1, 2 * year_order + 1) for f in ("sin", "cos")]
    own = range(2 * year_order)
    terms = PLAIN + [f"f{i}" for i in own] + [f"t * f{i}" for i in own] + [f"y * f{i}" for i in own] + [f"f{i}" for i in range(2 * year_order, 4 * year_order)]
    base = rows.selectExpr(*SERIES, "fit", "segment", f"pmod(day, {WEEKDAYS}) AS weekday", "t", "y", "cp", *keep, f"{angle} AS angle")
    wide = base.selectExpr("* EXCEPT (angle)", *[f"{w} AS f{i}" for i, w in enumerate(waves)])
    cells = wide.groupBy(*SERIES, "fit", "segment", "weekday").agg(F.expr("max(cp) AS cp"), *[F.expr(f"first({c}) AS {c}") for c in keep], *[F.expr(f"sum({x}) AS s{i}") for i, x in enumerate(terms)])
    packed = f"sort_array(collect_list(struct(segment, weekday, array({', '.join(f's{i}' for i in range(len(terms)))}) AS v, cp))) AS sums"
    return cells.groupBy(*SERIES, "fit").agg(*[F.expr(f"first({c}) AS {c}") for c in keep], F.expr(packed))


class Normal:
    """X'X, X'y and y'y of many series, from their sums."""

    def __init__(self, sums: np.ndarray, cps: np.ndarray, n_cp: np.ndarray, year_order: int, week_order: int):
        """``sums``: (series, segments, weekdays, terms), ``cps``: (series, changepoints); an empty cell is zero."""
        b, n_seg, _, _ = sums.shape
        n_c, n_year = n_seg - 1, 2 * year_order
        self.p = 2 + n_c + n_year + 2 * week_order
        plain = sums[..., :len(PLAIN)]
        yearly, t_yearly, y_yearly, beyond = np.split(sums[..., len(PLAIN):], 4, axis=-1)
        day = 2.0 * np.pi * np.outer(np.arange(WEEKDAYS), np.arange(1, week_order + 1)) / WEEKDAYS
        week = np.stack([np.sin(day), np.cos(day)], axis=2).reshape(WEEKDAYS, -1)
        by_week = np.einsum("bswx,wk->bskx", plain, week)  # the weekly columns' sums with 1, t, ..., y
        # Sums of the seasonal columns with 1, t and y, by segment.
        f, tf, yf = (np.concatenate([x.sum(axis=2), by_week[..., i]], axis=2) for x, i in ((yearly, 0), (t_yearly, 1), (y_yearly, 3)))
        plain = plain.sum(axis=2)
        # Sums over the segments from each one on.
        tail = lambda x: np.cumsum(x[:, ::-1], axis=1)[:, ::-1]
        total, after, f_after, tf_after = plain.sum(axis=1), tail(plain)[:, 1:], tail(f)[:, 1:], tail(tf)[:, 1:]
        xx, xy = np.zeros((b, self.p, self.p)), np.zeros((b, self.p))
        h, s = slice(2, 2 + n_c), slice(2 + n_c, self.p)
        one, t, t2, y, ty = (total[:, i] for i in range(5))
        xx[:, 0, 0], xx[:, 0, 1], xx[:, 1, 1] = t2, t, one
        xy[:, 0], xy[:, 1] = ty, y
        count, at, at2, ay, aty = (after[:, :, i] for i in range(5))
        xx[:, 0, h], xx[:, 1, h] = at2 - cps * at, at - cps * count
        xy[:, h] = aty - cps * ay
        # h_j h_k over the segments from the later one on.
        later = np.maximum(np.arange(n_c)[:, None], np.arange(n_c)[None, :])
        pair = cps[:, :, None], cps[:, None, :]
        xx[:, h, h] = at2[:, later] - (pair[0] + pair[1]) * at[:, later] + pair[0] * pair[1] * count[:, later]
        xx[:, 0, s], xx[:, 1, s] = tf.sum(axis=1), f.sum(axis=1)
        xx[:, h, s] = tf_after - cps[:, :, None] * f_after
        xy[:, s] = yf.sum(axis=1)
        days, by_day = sums[..., 0].sum(axis=1), yearly.sum(axis=1)
        y_slice, w_slice = slice(2 + n_c, 2 + n_c + n_year), slice(2 + n_c + n_year, self.p)
        xx[:, y_slice, y_slice] = self._products(np.concatenate([by_day.sum(axis=1), beyond.sum(axis=(1, 2))], axis=1), one, year_order)
        xx[:, y_slice, w_slice] = np.einsum("bwf,wk->bfk", by_day, week)
        xx[:, w_slice, w_slice] = np.einsum("bw,wk,wl->bkl", days, week, week)
        lower = np.tril_indices(self.p, -1)
        xx[:, lower[0], lower[1]] = xx[:, lower[1], lower[0]]
        # Changepoints that a short series doesn't have: no column.
        self.no_cp = np.arange(n_c)[None, :] >= n_cp[:, None]
        gone = np.zeros((b, self.p), dtype=bool)
        gone[:, h] = self.no_cp
        xx[gone[:, :, None] | gone[:, None, :]] = 0.0
        xy[gone] = 0.0
        self.xx, self.xy, self.yy, self.n = xx, xy, total[:, 5], one
        self.y_sum = y
        self.hinges, self.gone = h, gone

    @staticmethod
    def _products(waves: np.ndarray, one: np.ndarray, order: int) -> np.ndarray:
        """Sums of the products of the yearly columns, from the sums of sines and cosines of 1 to 2 ``order`` angles."""
        zero = np.zeros_like(one)
        sine = [zero, *waves[:, 0::2].T]
        cosine = [one, *waves[:, 1::2].T]
        out = np.zeros((len(one), 2 * order, 2 * order))
        for i in range(1, order + 1):
            for j in range(1, order + 1):
                apart, sign = abs(i - j), 1 if i >= j else -1
                out[:, 2 * i - 2, 2 * j - 2] = (cosine[apart] - cosine[i + j]) / 2
                out[:, 2 * i - 1, 2 * j - 1] = (cosine[apart] + cosine[i + j]) / 2
                out[:, 2 * i - 2, 2 * j - 1] = (sine[i + j] + sign * sine[apart]) / 2
                out[:, 2 * i - 1, 2 * j - 2] = (sine[i + j] - sign * sine[apart]) / 2
        return out


def solve(normal: Normal, base_precision: np.ndarray, hinge_prior: float, iterations: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and residual variance of every series, by reweighted ridge solves on stacked matrices.

    ``base_precision``: precision of the normal priors by column (of the hinges it is not used).
    """
    b, p = normal.xy.shape
    mean_square = normal.yy / normal.n
    sigma2 = np.maximum(mean_square - (normal.y_sum / normal.n) ** 2, 1e-6)
    delta, theta = np.full((b, normal.no_cp.shape[1]), hinge_prior), np.zeros((b, p))
    diagonal = np.arange(p)
    for _ in range(iterations):
        precision = np.broadcast_to(base_precision, (b, p)).copy()
        precision[:, normal.hinges] = 1.0 / (hinge_prior * np.maximum(np.abs(delta), 1e-6))
        precision[normal.gone] = 1.0
        a = normal.xx / sigma2[:, None, None]
        a[:, diagonal, diagonal] += precision
        theta = np.linalg.solve(a, (normal.xy / sigma2[:, None])[:, :, None])[:, :, 0]
        delta = theta[:, normal.hinges]
        fitted = np.einsum("bi,bij,bj->b", theta, normal.xx, theta)
        sigma2 = np.maximum((normal.yy - 2 * np.einsum("bi,bi->b", theta, normal.xy) + fitted) / normal.n, 1e-10)
    return theta, sigma2


def _cells(batch: pa.RecordBatch):
    lists = batch.column(batch.schema.get_field_index("sums"))
    flat = lists.flatten()
    return lists, flat, (lists.value_parent_indices().to_numpy(), flat.field("segment").to_numpy(), flat.field("weekday").to_numpy())


def sums_of(batch: pa.RecordBatch, n_seg: int) -> np.ndarray:
    """The sums of a batch as (series, segments, weekdays, terms)."""
    lists, flat, at = _cells(batch)
    values = flat.field("v").flatten().to_numpy().reshape(len(flat), -1)
    out = np.zeros((len(lists), n_seg, WEEKDAYS, values.shape[1]))
    out[at] = values
    return out


def changepoints_of(batch: pa.RecordBatch, n_cp: int) -> np.ndarray:
    """Changepoint j ends segment j; those that a series doesn't have are 0."""
    lists, flat, (series, segment, _) = _cells(batch)
    cp = flat.field("cp")
    there = cp.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), n_cp))
    out[series[there], segment[there]] = cp.drop_null().to_numpy()
    return out
