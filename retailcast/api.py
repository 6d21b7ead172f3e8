"""User-level API (compositions C1-C6) under the planning tool's names.

Every function works on all series at once and returns DataFrames; a single
series is a filter (``get_single_item``).  Nothing here collects to the driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import constants as K
from .operators import compare as CMP
from .operators import evaluate as E
from .operators import policy as P
from .operators import replay as RP
from .operators import series as S
from .operators.additive_model import map_frame
from .operators.catalog import demand_summary, dept_products
from .operators.reshape import to_model_input
from .operators.seasonal import seasonal_frame
from .plans.etl import build_sales_clean, write_curated
from .sources import files
from .sources.forecasts import save_forecast
from .sources.runs_store import RunStore

PolicyParams = P.PolicyParams


def load_data(spark: SparkSession, parquet_path: str) -> DataFrame:
    """The curated table with the columns the planning views use."""
    return files.read_curated(spark, parquet_path)


def build_curated(spark: SparkSession, sales_csv: str, calendar_csv: str, prices_csv: str,
                  out_path: str | None = None) -> DataFrame:
    """Three CSVs -> curated long table, optionally written by store."""
    clean = build_sales_clean(files.read_sales_cells_csv(spark, sales_csv),
                              files.read_calendar_csv(spark, calendar_csv),
                              files.read_prices_csv(spark, prices_csv))
    if out_path:
        write_curated(clean, out_path)
    return clean


def get_single_item(df: DataFrame, product_id: str, store_id: str) -> DataFrame:
    return S.single_series(df, product_id, store_id)


def prepare_model_input(df: DataFrame) -> DataFrame:
    """``item_id, store_id, ds, y, sell_price`` (R2, keeping keys and price)."""
    return to_model_input(df, extra=["sell_price"] if "sell_price" in df.columns else [])


def train_forecast(model_input: DataFrame, forecast_days: int = K.DEFAULT_HORIZON,
                   model: str = "seasonal") -> DataFrame:
    """Forecast frame for every series: history + ``forecast_days`` future days.

    ``model="seasonal"``: native trend + weekday + month model (exact SQL twin);
    ``model="additive"``: changepoint trend + Fourier seasonality, grouped fit.
    The frame also carries the train-only backtest fit.
    """
    builders = {"seasonal": seasonal_frame, "additive": map_frame}
    if model not in builders:
        raise ValueError(f"model must be one of {sorted(builders)}, not {model!r}")
    return builders[model](model_input, horizon=forecast_days)


def evaluate_forecast(frame: DataFrame, holdout_days: int = K.HOLDOUT_DAYS) -> DataFrame:
    """MAPE / RMSE / n_compared per series (NULL when not evaluable) (M5)."""
    return E.backtest_metrics(frame, holdout_days)


def backtest_comparison(frame: DataFrame, holdout_days: int = K.HOLDOUT_DAYS) -> DataFrame:
    return E.backtest_comparison(frame, holdout_days)


def calculate_inventory(frame: DataFrame,
                        params: PolicyParams | Sequence[PolicyParams] = PolicyParams()) -> DataFrame:
    """Safety stock, ROP, EOQ per series (and parameter set) (I4)."""
    return P.inventory_policy(frame, params)


def future_forecast(frame: DataFrame, params: PolicyParams = PolicyParams()) -> DataFrame:
    """The clipped future days used by the policy."""
    return P.future_days(frame, params)


@dataclass
class PipelineResult:
    frame: DataFrame
    summary: DataFrame      # policy + total + metrics, one row per series
    insights: DataFrame


def run_pipeline(model_input: DataFrame, params: PolicyParams = PolicyParams(),
                 model: str = "seasonal") -> PipelineResult:
    """Forecast -> policy -> backtest for all series.

    Series with fewer than 30 rows get no result (guard F9).
    """
    frame = train_forecast(model_input, max(params.forecast_days, 1), model)
    return PipelineResult(frame, P.series_summary(frame, params),
                          P.forecast_insights(frame, params))


def simulate_inventory(frame: DataFrame, params: PolicyParams = PolicyParams(),
                       demand_col: str = "yhat") -> DataFrame:
    """Stock level replay under each series' policy."""
    return RP.replay(frame, params, demand_col)


def compare_products(summary: DataFrame, pairs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Metric table and takeaway for ``pairs (store_id, item_a, item_b)``;
    without pairs, the top two items of every store (C3)."""
    if pairs is None:
        return CMP.compare_top_two(summary), CMP.takeaway_top_two(summary)
    return CMP.compare_metrics(summary, pairs), CMP.compare_takeaway(summary, pairs)


def product_summary(sales: DataFrame) -> DataFrame:
    """Mean daily demand per item (A1)."""
    return demand_summary(sales)


def products_of_department(summary: DataFrame, dept_id: str) -> DataFrame:
    """Products of one department by demand with their labels."""
    return dept_products(summary, dept_id, with_label=True).orderBy("rank")


def save_results(store: RunStore, result: PipelineResult,
                 params: PolicyParams = PolicyParams(),
                 run_at: _dt.datetime | None = None) -> DataFrame:
    """Append one run per series and its days (C4)."""
    pol = result.summary
    return store.save(result.frame, pol, pol.select("item_id", "store_id", "mape", "rmse"),
                      params, run_at)


def open_store(spark: SparkSession, root: str) -> RunStore:
    """Saved-runs tables under ``root`` (C5: load_all_runs / load_run_forecast / query_runs)."""
    return RunStore(spark, root)


__all__ = [n for n in dir() if not n.startswith("_") and n not in {"F", "K", "S", "E", "P", "RP", "CMP"}]
