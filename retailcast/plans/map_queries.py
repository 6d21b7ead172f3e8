"""Registered queries of the grouped-map model (no SQL twin: rows-only check).

Their invariants (band ordering, component sum, recovery of a known signal,
determinism) are tested in pytest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..constants import SERIES
from ..functions.scalar import r6
from ..operators import policy as P
from ..operators.additive_model import map_frame
from .queries import Inputs, POLICY_VALUES, _round_cols


def q_forecast_map(i: Inputs) -> DataFrame:
    fr = map_frame(i.model_input)
    return fr.select(*SERIES, "ds", "is_future", *[r6(c).alias(c) for c in
                     ["yhat", "yhat_lower", "yhat_upper", "trend", "weekly", "yearly"]])


def q_policy_map(i: Inputs) -> DataFrame:
    return _round_cols(P.series_summary(map_frame(i.model_input)).drop("param_set"),
                       POLICY_VALUES | {"total_forecast", "mape", "rmse"})


REGISTRY = {"forecast_map": q_forecast_map, "policy_map": q_policy_map}


def registered_map() -> dict:
    return {name: (lambda fn: (lambda spark, sf_dir: fn(Inputs(spark, sf_dir))))(fn)
            for name, fn in REGISTRY.items()}
