"""Forecast sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import series as S
from . import files


def save_forecast(frame: DataFrame, path: str, single_item: tuple[str, str] | None = None,
                  mode: str = "overwrite") -> None:
    """Write the forecast of every series as one dataset partitioned by store
    (S6); ``single_item`` writes one series' extract instead."""
    out = frame.select("item_id", "store_id", "ds", "is_future", "yhat", "yhat_lower",
                       "yhat_upper", "trend", "weekly", "yearly")
    if single_item:
        out = S.single_series(out, *single_item)
    files.write_parquet(out, path, ["store_id"], mode)
