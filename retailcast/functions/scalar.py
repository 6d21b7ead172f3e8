"""Scalar column functions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip0(c) -> Column:
    """Clip at 0 and keep NULL (``greatest(0, NULL)`` would give 0)."""
    c = _c(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def nan_to_null(c) -> Column:
    """NaN becomes NULL, so averages skip it as pandas does."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def safe_div(a, b) -> Column:
    """Division that gives NULL for a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(_c(a), _c(b))


def round_half_up(c, places: int) -> Column:
    """Round via ``round(x * 10^n) / 10^n``.

    Engines disagree on ``round(x, n)`` for doubles whose decimal text ends in 5
    (one rounds the text, one the binary value); rounding a scaled value to an
    integer agrees everywhere.
    """
    scale = float(10 ** places)
    return F.round(_c(c) * F.lit(scale), 0) / F.lit(scale)


def r6(c) -> Column:
    return round_half_up(c, 6)


def accuracy_band(mape) -> Column:
    """'good' below 20 %, 'fair' below 40 %, else 'poor'; NULL -> 'N/A'."""
    m = _c(mape)
    return (F.when(m.isNull(), F.lit("N/A"))
            .when(m < K.MAPE_GOOD, F.lit("good"))
            .when(m < K.MAPE_FAIR, F.lit("fair"))
            .otherwise(F.lit("poor")))


def is_intermittent(avg_demand) -> Column:
    return _c(avg_demand) < F.lit(K.INTERMITTENT_BELOW)


def demand_label(item_id, avg_demand) -> Column:
    """``item  —  1.23 units/day`` (Java rounding of the text; see trap G7)."""
    return F.concat(_c(item_id), F.lit("  —  "),
                    F.format_string("%.2f units/day", _c(avg_demand)))


def date_label(ds) -> Column:
    """``Mon DD, YYYY``."""
    return F.date_format(_c(ds), "MMM dd, yyyy")


def map_lookup(mapping: Mapping[str, str], key, default_to_key: bool = False) -> Column:
    """Literal map lookup id -> label; optionally fall back to the key."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, _c(key))
    return F.coalesce(v, _c(key)) if default_to_key else v


def reverse_lookup(mapping: Mapping[str, str], label) -> Column:
    """Literal map lookup label -> id; a label of several ids is an error (see ``scoped_reverse_lookup``)."""
    if len(set(mapping.values())) < len(mapping):
        raise ValueError("a label belongs to several ids; look it up within its scope")
    return map_lookup({v: k for k, v in mapping.items()}, label)


def scoped_reverse_lookup(mapping: Mapping[str, Mapping[str, str]], scope, label) -> Column:
    """Lookup label -> id inside a scope (such as a store's label inside its state).

    ``mapping``: scope -> {id: label}; NULL for an unknown pair, an error for a label that
    repeats within one scope.
    """
    pairs = [((s, v), k) for s, ids in mapping.items() for k, v in ids.items()]
    if len({p for p, _ in pairs}) < len(pairs):
        raise ValueError("a label repeats within its scope")
    by_scope = F.create_map(*[x for s, ids in mapping.items() for x in (
        F.lit(s), F.create_map(*[F.lit(y) for k, v in ids.items() for y in (v, k)]))])
    return F.try_element_at(F.try_element_at(by_scope, _c(scope)), _c(label))


def symmetric_ratio(ratio) -> Column:
    """``max(r, 1 / max(r, 0.01))``."""
    r = _c(ratio)
    return F.greatest(r, F.lit(1.0) / F.greatest(r, F.lit(0.01)))


def demand_ratio(a, b) -> Column:
    """``a / max(b, 0.01)``."""
    return _c(a) / F.greatest(_c(b), F.lit(0.01))


def pick_by(cond, a, b) -> Column:
    return F.when(_c(cond), _c(a)).otherwise(_c(b))
