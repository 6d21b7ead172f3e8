"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through ``fixtures``) and runs over the
whole of them; the only literal choices are the ones the feature itself takes
(one series for the single-series filter, one store for the store filter, the
parameter sets of saved runs).  Model-derived doubles are rounded to 6
decimals via ``round(x * 1e6) / 1e6`` so that engines can be compared value
for value.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from contextlib import contextmanager, suppress
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..constants import SERIES
from ..functions.scalar import date_label, r6, round_half_up
from ..operators import catalog as C
from ..operators import compare as CMP
from ..operators import evaluate as E
from ..operators import policy as P
from ..operators import profile as Q
from ..operators import replay as RP
from ..operators import rollups as RU
from ..operators import runs as R
from ..operators import series as S
from ..operators.additive_model import predict_components, projected_models
from ..operators.reshape import melt, to_model_input
from ..operators.rollups import RollupStore
from ..operators.seasonal import seasonal_frame
from ..session import checkpoint_dir
from ..sources import files
from ..sources.forecasts import save_forecast
from ..sources.runs_store import RunStore
from . import etl
from . import fixtures as fx

# FIXED VALUES: literal choices of the registered queries.
ONE_SERIES = ("Brand#13", "EUROPE")          # single-series filter (F2)
RUNS_STORE = "EUROPE"                        # store filter of the saved-runs query (F5)
RUNS_TOP_N = 10                              # top-n by demand (T2)
ONE_DEPT = "ECONOMY_5"                       # department choice (F3)
ONE_RUN = 7                                  # saved run looked up by its id (F8)
RUN_AT = _dt.datetime(2024, 1, 1, 0, 0, 0)   # saved-run clock: RUN_AT + run_id minutes
# Three saved batches: defaults, then a short and a long horizon.
RUN_BATCHES = [
    P.PolicyParams(90, 7, 10.0, 0.20),
    P.PolicyParams(30, 3, 50.0, 0.10),
    P.PolicyParams(180, 14, 100.0, 0.50),
]
# Labels for all categories but one (that one falls back to its id).
CATEGORY_NAMES = {"ECONOMY": "Category ECONOMY", "LARGE": "Category LARGE",
                  "MEDIUM": "Category MEDIUM", "PROMO": "Category PROMO",
                  "SMALL": "Category SMALL"}


class Inputs:
    """Lazily built inputs of one query (plans only; nothing is executed)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir
        self._frames: dict[int, DataFrame] = {}

    @cached_property
    def daily(self) -> DataFrame:
        """The line-item rollup, persisted: it is small (series x days) and read
        by several branches with different columns (sales, prices), which would
        otherwise each scan and join the line items again."""
        return fx.daily_rollup(self.spark, self.sf).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def long(self) -> DataFrame:
        return fx.sales_long(self.spark, self.sf, self.daily)

    @cached_property
    def calendar(self) -> DataFrame:
        return fx.calendar(self.spark, self.sf)

    @cached_property
    def prices(self) -> DataFrame:
        return fx.sell_prices(self.spark, self.sf, self.daily)

    @cached_property
    def priced(self) -> DataFrame:
        return etl.priced_long(self.long, self.calendar, self.prices)

    @cached_property
    def clean(self) -> DataFrame:
        return etl.keep_priced(self.priced)

    @cached_property
    def model_input(self) -> DataFrame:
        # Same rows as ``to_model_input(self.clean)``; one exchange after the rollup.
        return to_model_input(fx.priced_daily(self.spark, self.sf, self.daily), extra=["sell_price"])

    @cached_property
    def wide(self) -> DataFrame:
        return fx.sales_wide(self.spark, self.sf, self.long)

    @cached_property
    def catalog(self) -> DataFrame:
        return fx.catalog_sales(self.spark, self.sf)

    def frame(self, horizon: int = K.DEFAULT_HORIZON) -> DataFrame:
        """The model frame, persisted: policy, backtest and replay all read it.

        It is bounded by series x (days + horizon) and partitioned by series;
        MEMORY_AND_DISK, so a lost executor only recomputes its partitions.
        """
        if horizon not in self._frames:
            self._frames[horizon] = seasonal_frame(self.model_input, horizon=horizon).persist(
                StorageLevel.MEMORY_AND_DISK)
        return self._frames[horizon]

    def summary(self) -> DataFrame:
        """Per-series policy + total forecast + backtest (default parameters)."""
        return P.series_summary(self.frame())

    @cached_property
    def saved_runs(self) -> DataFrame:
        """Run rows with their ids, placed once (see ``ids.dense_ids``)."""
        fr = self.frame(max(p.forecast_days for p in RUN_BATCHES))
        summary = P.series_summary(fr, RUN_BATCHES)  # policy + metrics, one aggregation
        return R.build_runs(summary, None, RUN_AT, 0, per_run_minutes=True)

    def runs(self) -> DataFrame:
        return self.saved_runs

    def daily_runs(self) -> DataFrame:
        fr = self.frame(max(p.forecast_days for p in RUN_BATCHES))
        return R.build_daily(P.future_days(fr, RUN_BATCHES), self.runs())


def _round_cols(df: DataFrame, cols) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# -- reshape and ETL ---------------------------------------------------------

def q_melt_sales(i: Inputs) -> DataFrame:
    return melt(i.wide)


def q_sales_clean(i: Inputs) -> DataFrame:
    out = etl.build_sales_clean(i.wide, i.calendar, i.prices)
    return _round_cols(out, {"sell_price"})


def q_profile_nulls(i: Inputs) -> DataFrame:
    return Q.null_profiles({"calendar": i.calendar, "sell_prices": i.prices,
                            "sales_long": i.long, "sales_priced": i.priced})


def q_price_nulls(i: Inputs) -> DataFrame:
    return Q.column_nulls(i.priced, "sell_price")


def q_profile_range(i: Inputs) -> DataFrame:
    return Q.value_range(i.clean)


def q_distinct_sorted(i: Inputs) -> DataFrame:
    return Q.distinct_values(i.catalog, ["store_id", "state_id", "cat_id", "dept_id"])


def q_daily_total(i: Inputs) -> DataFrame:
    return (i.clean.groupBy("date").agg(F.sum("sales").alias("total_sales")).orderBy("date"))


def q_daily_labels(i: Inputs) -> DataFrame:
    return q_daily_total(i).select("date", date_label("date").alias("label"), "total_sales")


# -- catalog -----------------------------------------------------------------

def q_demand_summary(i: Inputs) -> DataFrame:
    return _round_cols(C.demand_summary(i.catalog), {"avg_daily_demand"})


def q_dept_products_ranked(i: Inputs) -> DataFrame:
    ranked = C.dept_products(C.demand_summary(i.catalog))
    return _round_cols(ranked.select("dept_id", "rank", "item_id", "avg_daily_demand"),
                       {"avg_daily_demand"})


def q_dept_by_category_prefix(i: Inputs) -> DataFrame:
    pairs = i.catalog.select("cat_id", "dept_id").distinct()
    return C.departments_of_category(pairs).orderBy("cat_id", "dept_id")


def q_stores_by_state(i: Inputs) -> DataFrame:
    return C.stores_of_state(i.catalog)


def q_label_lookup_default(i: Inputs) -> DataFrame:
    cats = i.catalog.select("cat_id").distinct()
    labelled = C.with_labels(cats, "cat_id", CATEGORY_NAMES, "cat_label", default_to_key=True)
    return C.id_from_label(labelled, "cat_label", CATEGORY_NAMES, "cat_id_from_label")


# -- series ------------------------------------------------------------------

def q_series_filter(i: Inputs) -> DataFrame:
    one = S.single_series(i.model_input, *ONE_SERIES)
    return _round_cols(one, {"sell_price"})


def q_series_min_history(i: Inputs) -> DataFrame:
    return S.series_counts(i.model_input)


def q_history_tail(i: Inputs) -> DataFrame:
    return S.tail_rows(i.model_input.select(*SERIES, "ds", "y"), K.HISTORY_TAIL)


def q_holdout_split_counts(i: Inputs) -> DataFrame:
    sp = S.holdout_split(i.model_input)
    return (sp.groupBy(*SERIES).agg(F.first("n_rows").alias("n_rows"),
                                    F.count_if(~F.col("is_test")).alias("n_train"),
                                    F.count_if("is_test").alias("n_test"),
                                    F.first("evaluable").alias("evaluable")))


def q_future_spine(i: Inputs) -> DataFrame:
    return S.future_spine(i.model_input, K.DEFAULT_HORIZON)


# -- forecast, backtest, policy ------------------------------------------------

def q_forecast_seasonal(i: Inputs) -> DataFrame:
    fc = i.frame().select(*SERIES, "ds", "is_future", "yhat", "yhat_lower", "yhat_upper")
    return _round_cols(fc, {"yhat", "yhat_lower", "yhat_upper"})


def q_forecast_components(i: Inputs) -> DataFrame:
    fc = i.frame().select(*SERIES, "ds", "trend", "weekly", "yearly")
    return _round_cols(fc, {"trend", "weekly", "yearly"})


def q_backtest_metrics(i: Inputs) -> DataFrame:
    return _round_cols(E.backtest_metrics(i.frame()), {"mape", "rmse"})


def q_backtest_comparison(i: Inputs) -> DataFrame:
    return _round_cols(E.backtest_comparison(i.frame()), {"yhat", "yhat_lower", "yhat_upper"})


def q_accuracy_band(i: Inputs) -> DataFrame:
    fr = i.frame()
    return E.accuracy_labels(E.backtest_metrics(fr), P.inventory_policy(fr))


POLICY_VALUES = {"avg_daily_demand", "std_daily_demand", "safety_stock", "rop", "eoq", "avg_price"}


def q_inventory_policy(i: Inputs) -> DataFrame:
    return _round_cols(P.inventory_policy(i.frame()).drop("param_set"), POLICY_VALUES)


def q_forecast_insights(i: Inputs) -> DataFrame:
    # Peak and low days are chosen on the forecast at 1e-6 precision, so that
    # days whose forecasts differ only in the last bits count as ties.
    fr = i.frame().withColumn("yhat", r6("yhat"))
    return _round_cols(P.forecast_insights(fr).drop("param_set"),
                       {"total_forecast", "peak_yhat", "low_yhat", "avg_upper"})


def q_inventory_replay(i: Inputs) -> DataFrame:
    lv = RP.replay(i.frame(), precision=6).drop("param_set", "rop", "eoq")
    return _round_cols(lv, {"demand", "level"})


def q_replay_orders(i: Inputs) -> DataFrame:
    lv = RP.replay(i.frame(), precision=6)
    return _round_cols(RP.replay_orders(lv).drop("param_set"), {"min_level"})


def q_inventory_replay_history(i: Inputs) -> DataFrame:
    lv = RP.replay_history(i.frame(), precision=6).drop("param_set", "rop", "eoq")
    return _round_cols(lv, {"level"})


# -- comparison ----------------------------------------------------------------

def q_compare_products(i: Inputs) -> DataFrame:
    return _round_cols(CMP.compare_top_two(i.summary()), {"A", "B"})


def q_compare_takeaway(i: Inputs) -> DataFrame:
    return _round_cols(CMP.takeaway_top_two(i.summary()), {"demand_ratio", "ratio_val"})


# -- saved runs ----------------------------------------------------------------

RUN_VALUES = {"ordering_cost", "holding_cost"}


def q_runs_next_id(i: Inputs) -> DataFrame:
    return i.spark.range(1).select((R.next_run_id(i.runs()) + 1).alias("next_run_id"))


def q_runs_latest(i: Inputs) -> DataFrame:
    return R.latest_runs(i.runs(), K.SAVED_RUNS_LIMIT)


def q_runs_top_by_demand(i: Inputs) -> DataFrame:
    return R.query_runs(i.runs(), store_id=RUNS_STORE, top_n_by_demand=RUNS_TOP_N)


def q_runs_kpis(i: Inputs) -> DataFrame:
    k = R.runs_kpis(R.latest_runs(i.runs(), K.SAVED_RUNS_LIMIT))
    return _round_cols(k, {"avg_mape"})


def q_runs_sorted_nulls_last(i: Inputs) -> DataFrame:
    latest = R.latest_runs(i.runs(), K.SAVED_RUNS_LIMIT)
    col, asc = R.SORT_OPTIONS["Lowest MAPE (best fit)"]
    return R.sort_runs(R.filter_runs(latest, None, None), col, asc)


def q_run_detail(i: Inputs) -> DataFrame:
    runs = i.runs().select("run_id", *SERIES, "rop", "safety_stock")
    out = R.runs_with_days(runs, i.daily_runs())
    return out.select("run_id", *SERIES, "ds",
                      *[r6(c).alias(c) for c in ["yhat", "yhat_lower", "yhat_upper"]],
                      *[round_half_up(c, 6).alias(c) for c in ["rop", "safety_stock"]])


def q_run_forecast(i: Inputs) -> DataFrame:
    days = R.run_forecast(i.daily_runs(), ONE_RUN)
    return _round_cols(days, {"yhat", "yhat_lower", "yhat_upper"})


# -- stored tables ---------------------------------------------------------------

def _scratch(i: Inputs, name: str) -> str:
    return f"{checkpoint_dir(i.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_stored_series(i: Inputs) -> DataFrame:
    """One series read back from the clustered curated table."""
    table = etl.curated_table(i.spark, _scratch(i, "curated"))
    table.append(i.clean.withColumn("sales", F.col("sales").cast("int")))
    one = S.single_series(table.read(), *ONE_SERIES)
    return _round_cols(one.select("item_id", "store_id", "date", "sales", "sell_price"), {"sell_price"})


def q_csv_curated(i: Inputs) -> DataFrame:
    """The three inputs written as CSV, read back and built into the curated table, stored by store."""
    root = _scratch(i, "csv")
    files.write_sales_cells_csv(i.wide, f"{root}/sales")
    i.calendar.write.option("header", True).csv(f"{root}/calendar")
    i.prices.write.option("header", True).csv(f"{root}/prices")
    clean = etl.build_sales_clean(files.read_sales_cells_csv(i.spark, f"{root}/sales"), files.read_calendar_csv(i.spark, f"{root}/calendar"), files.read_prices_csv(i.spark, f"{root}/prices"))
    etl.write_curated(clean, f"{root}/curated")
    return _round_cols(files.read_curated(i.spark, f"{root}/curated"), {"sell_price"})


def q_stored_forecast(i: Inputs) -> DataFrame:
    """The forecast of every series written as one dataset by store and read back."""
    path = _scratch(i, "forecast")
    save_forecast(i.frame(), path)
    back = i.spark.read.parquet(path)
    return _round_cols(back.select(*SERIES, "ds", "is_future", *(cols := ["yhat", "yhat_lower", "yhat_upper", "trend"])), set(cols))


def q_table_shapes(i: Inputs) -> DataFrame:
    return Q.shapes({"calendar": i.calendar, "sell_prices": i.prices, "sales_long": i.long, "sales_clean": i.clean})


def q_table_preview(i: Inputs) -> DataFrame:
    """First and last rows of the curated table by series and day (Q2)."""
    return _round_cols(Q.preview(i.clean.select("item_id", "store_id", "date", "sales", "sell_price"), 5, ["item_id", "store_id", "date"]), {"sell_price"})


def _stored_runs(i: Inputs) -> RunStore:
    """Three batches saved one after another; the second one fails after its days and is saved again, the first is
    saved again although it was complete."""
    store = RunStore(i.spark, _scratch(i, "runs"), buckets=8)
    frame = i.frame(max(p.forecast_days for p in RUN_BATCHES))

    def save(k: int) -> None:
        summary = P.series_summary(frame, RUN_BATCHES[k])
        store.save(frame, summary, None, RUN_BATCHES[k], RUN_AT + _dt.timedelta(days=k), f"batch {k + 1}")

    save(0)
    with failing_before_runs(store):
        save(1)
    save(1)
    save(0)
    save(2)
    return store


@contextmanager
def failing_before_runs(store: RunStore):
    """Every save in the block breaks off before its run rows are written."""
    append = store._append

    def broken(path: str, rows: DataFrame) -> None:
        if path == store.runs_path:
            raise _Broken
        append(path, rows)

    store._append = broken
    try:
        with suppress(_Broken):
            yield
    finally:
        store._append = append


class _Broken(Exception):
    pass


def q_saved_runs_roundtrip(i: Inputs) -> DataFrame:
    """Runs of the stored tables with how many days they have, and the days' sum."""
    days = _stored_runs(i).load_run_days()
    return (days.groupBy("run_id", "run_at", *SERIES, "forecast_days", r6("rop").alias("rop"))
            .agg(F.count(F.lit(1)).alias("n_days"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), round_half_up(F.sum("yhat"), 4).alias("total_forecast")))


def q_saved_runs_view(i: Inputs) -> DataFrame:
    """The saved-runs view over the stored tables: the newest runs of one store by fit, under display names."""
    return _stored_runs(i).explore("Lowest MAPE (best fit)", store_id=RUNS_STORE)


def _kept_up(i: Inputs):
    """Partials of all days but the last two, then each of these appended (the first of them twice)."""
    store = RollupStore(i.spark, _scratch(i, "rollups"))
    _, hi = fx.ship_bounds(i.spark, i.sf)
    back = F.date_diff(hi, F.col("date"))
    for batch, days in (("history", back >= 2), ("next", back == 1), ("next", back == 1), ("last", back == 0)):
        store.append(i.catalog.where(days), batch)
    return store.read()


def q_demand_summary_kept_up(i: Inputs) -> DataFrame:
    return _round_cols(RU.demand_summary(_kept_up(i)), {"avg_daily_demand"})


def q_daily_total_kept_up(i: Inputs) -> DataFrame:
    return RU.daily_total(_kept_up(i))


def q_kpis_kept_up(i: Inputs) -> DataFrame:
    return RU.kpis(_kept_up(i))


def q_predict_components(i: Inputs) -> DataFrame:
    """Additive prediction from a table of coefficients, for the history and the next 90 days (M2-M4)."""
    models = projected_models(i.model_input)
    out = predict_components(models, S.future_spine(i.model_input, K.DEFAULT_HORIZON))
    return _round_cols(out, {"yhat", "yhat_lower", "yhat_upper", "trend", "weekly", "yearly"})


def q_dept_products_labels(i: Inputs) -> DataFrame:
    """Products of one department by demand, as the choice list shows them."""
    return C.dept_products(C.demand_summary(i.catalog), ONE_DEPT, with_label=True).select("rank", "item_id", "label")


REGISTRY = {
    "melt_sales": q_melt_sales,
    "sales_clean": q_sales_clean,
    "profile_nulls": q_profile_nulls,
    "price_nulls": q_price_nulls,
    "profile_range": q_profile_range,
    "distinct_sorted": q_distinct_sorted,
    "daily_total": q_daily_total,
    "daily_labels": q_daily_labels,
    "demand_summary": q_demand_summary,
    "dept_products_ranked": q_dept_products_ranked,
    "dept_by_category_prefix": q_dept_by_category_prefix,
    "stores_by_state": q_stores_by_state,
    "label_lookup_default": q_label_lookup_default,
    "series_filter": q_series_filter,
    "series_min_history": q_series_min_history,
    "history_tail": q_history_tail,
    "holdout_split_counts": q_holdout_split_counts,
    "future_spine": q_future_spine,
    "forecast_seasonal": q_forecast_seasonal,
    "forecast_components": q_forecast_components,
    "backtest_metrics": q_backtest_metrics,
    "backtest_comparison": q_backtest_comparison,
    "accuracy_band": q_accuracy_band,
    "inventory_policy": q_inventory_policy,
    "forecast_insights": q_forecast_insights,
    "inventory_replay": q_inventory_replay,
    "replay_orders": q_replay_orders,
    "inventory_replay_history": q_inventory_replay_history,
    "compare_products": q_compare_products,
    "compare_takeaway": q_compare_takeaway,
    "runs_next_id": q_runs_next_id,
    "runs_latest": q_runs_latest,
    "runs_top_by_demand": q_runs_top_by_demand,
    "runs_kpis": q_runs_kpis,
    "runs_sorted_nulls_last": q_runs_sorted_nulls_last,
    "run_detail": q_run_detail,
    "run_forecast": q_run_forecast,
    "stored_series": q_stored_series,
    "csv_curated": q_csv_curated,
    "stored_forecast": q_stored_forecast,
    "table_shapes": q_table_shapes,
    "table_preview": q_table_preview,
    "saved_runs_roundtrip": q_saved_runs_roundtrip,
    "saved_runs_view": q_saved_runs_view,
    "dept_products_labels": q_dept_products_labels,
    "demand_summary_kept_up": q_demand_summary_kept_up,
    "daily_total_kept_up": q_daily_total_kept_up,
    "kpis_kept_up": q_kpis_kept_up,
    "predict_components": q_predict_components,
}


def registered() -> dict:
    return {name: (lambda fn: (lambda spark, sf_dir: fn(Inputs(spark, sf_dir))))(fn)
            for name, fn in REGISTRY.items()}
