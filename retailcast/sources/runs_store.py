"""Saved-runs store: two Parquet tables, parent ``forecast_runs`` and child
``forecast_daily`` linked by ``run_id`` (S7-S10).

Writes append.  Every save is a *batch* with an id that both tables carry.  The daily rows are
written first and the run rows second, so a visible run always has its days.  A save that
failed anywhere is finished by saving the same batch again: it takes the ids of the days that are
there, and a ``left_anti`` join with what either table holds of the batch adds what is missing
and nothing twice.  A save without a batch id is a new batch, so saving again appends new runs.
Days of a batch that has no run rows are left out by every reader; ``unfinished_batches`` names them.

New ids continue from the largest of both tables (a scalar subquery, no driver round trip), so a
save that failed halfway leaves no id to reuse; the new runs are checkpointed into the shared
checkpoint folder before the two writes, so both see the same ids.  A single writer is assumed, as
with the embedded table it replaces.

With ``buckets`` both tables are clustered by ``run_id`` alike (``clustered``): runs and days are joined
without an exchange, and the days of a run stand in one bucket.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..operators import runs as R
from ..operators.policy import PolicyParams, future_days
from ..session import cut_lineage
from .clustered import ClusteredTable

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.IntegerType()),
    T.StructField("run_at", T.TimestampNTZType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("forecast_days", T.IntegerType()),
    T.StructField("lead_time_days", T.IntegerType()),
    T.StructField("ordering_cost", T.DoubleType()),
    T.StructField("holding_cost", T.DoubleType()),
    T.StructField("avg_daily_demand", T.DoubleType()),
    T.StructField("std_daily_demand", T.DoubleType()),
    T.StructField("safety_stock", T.DoubleType()),
    T.StructField("rop", T.DoubleType()),
    T.StructField("eoq", T.DoubleType()),
    T.StructField("mape", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("batch_id", T.StringType()),
])

DAILY_SCHEMA = T.StructType([
    T.StructField("run_id", T.IntegerType()),
    T.StructField("ds", T.DateType()),
    T.StructField("yhat", T.DoubleType()),
    T.StructField("yhat_lower", T.DoubleType()),
    T.StructField("yhat_upper", T.DoubleType()),
    T.StructField("batch_id", T.StringType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the table's folder exists, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class RunStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root
        self.runs_path = f"{root.rstrip('/')}/forecast_runs"
        self.daily_path = f"{root.rstrip('/')}/forecast_daily"
        self._clustered = {}
        if buckets:
            self._clustered = {self.runs_path: ClusteredTable(spark, self.runs_path, RUNS_SCHEMA, "run_id", ["run_id"], buckets),
                               self.daily_path: ClusteredTable(spark, self.daily_path, DAILY_SCHEMA, "run_id", ["run_id", "ds"], buckets)}

    # S7 -----------------------------------------------------------------
    def init(self) -> None:
        """Create both tables (empty, typed) if absent."""
        for path, schema in ((self.daily_path, DAILY_SCHEMA), (self.runs_path, RUNS_SCHEMA)):
            if path in self._clustered:
                self._clustered[path].create()
            elif not _exists(self.spark, path):
                self.spark.createDataFrame([], schema).write.mode("append").parquet(path)

    # S10 ----------------------------------------------------------------
    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self._clustered[path].read() if path in self._clustered else self.spark.read.schema(schema).parquet(path)

    def _append(self, path: str, rows: DataFrame) -> None:
        if path in self._clustered:
            self._clustered[path].append(rows)
        else:
            rows.write.mode("append").parquet(path)

    def runs(self) -> DataFrame:
        return self._read(self.runs_path, RUNS_SCHEMA)

    def all_daily(self) -> DataFrame:
        """All daily rows, also those whose runs were never written."""
        return self._read(self.daily_path, DAILY_SCHEMA)

    def daily(self) -> DataFrame:
        """Days of visible runs."""
        return self.all_daily().join(self.runs().select("run_id"), "run_id", "left_semi")

    def unfinished_batches(self) -> DataFrame:
        """Batches whose days were written, all or in part, and whose runs are missing, all or in part: ``batch_id, n_runs``."""
        days = self.all_daily().groupBy("batch_id", "run_id").count()
        return days.join(self.runs().select("run_id"), "run_id", "left_anti").groupBy("batch_id").agg(F.count("run_id").alias("n_runs"))

    # S8 + S9 --------------------------------------------------------------
    def save(self, frame: DataFrame, policy: DataFrame, metrics: DataFrame | None,
             params: PolicyParams | Sequence[PolicyParams] = PolicyParams(),
             run_at: _dt.datetime | None = None, batch_id: str | None = None) -> DataFrame:
        """Append one run per policy row and its future days; returns the batch's runs.

        The same ``batch_id`` again finishes that batch: it is numbered as it was, and rows that are
        there already are not written again.  The forecast must be the same, as it is for a retry.
        """
        self.init()
        run_at = run_at or _dt.datetime.now().replace(microsecond=0)
        batch = batch_id or uuid.uuid4().hex
        runs_there, days_there = self.runs().where(F.col("batch_id") == batch), self.all_daily().where(F.col("batch_id") == batch)
        ids = self.runs().select("run_id", "batch_id").unionByName(self.all_daily().select("run_id", "batch_id"))
        # Days of a save whose run rows were never written still use up their ids; a batch that is
        # there in part begins where it began.
        begun = ids.select(F.min(F.when(F.col("batch_id") == batch, F.col("run_id") - 1))).scalar()
        start = F.coalesce(begun, R.next_run_id(ids))
        new_runs = cut_lineage(R.build_runs(policy, metrics, run_at, start).withColumn("batch_id", F.lit(batch)))
        days = R.build_daily(future_days(frame, params), new_runs).withColumn("batch_id", F.lit(batch))
        self._append(self.daily_path, days.join(days_there.select("run_id", "ds"), ["run_id", "ds"], "left_anti").select(*DAILY_SCHEMA.names))
        self._append(self.runs_path, new_runs.join(runs_there.select("run_id"), "run_id", "left_anti").select(*RUNS_SCHEMA.names))
        return self.runs().where(F.col("batch_id") == batch).select(*R.RUN_COLUMNS)

    # T1, T2, T3 -------------------------------------------------------------
    def load_all_runs(self, limit: int = K.SAVED_RUNS_LIMIT) -> DataFrame:
        return R.latest_runs(self.runs(), limit)

    def explore(self, sort: str = "Most recent first", item_id: str | None = None, store_id: str | None = None, limit: int = K.SAVED_RUNS_LIMIT) -> DataFrame:
        """The saved-runs view as one call (C5): the newest runs, filtered, sorted by one of ``SORT_OPTIONS`` (its
        place as ``position``), with display names."""
        return R.explore_runs(self.load_all_runs(limit), sort, item_id, store_id)

    def load_run_days(self, run_id: int | None = None) -> DataFrame:
        """Runs with their days (J9), of one run or of all."""
        one = F.lit(True) if run_id is None else F.col("run_id") == F.lit(run_id)
        return R.runs_with_days(self.runs().where(one).drop("batch_id"), self.all_daily().where(one).drop("batch_id"))

    def load_run_forecast(self, run_id: int) -> DataFrame:
        return R.run_forecast(self.daily(), run_id)

    def query_runs(self, item_id: str | None = None, store_id: str | None = None,
                   top_n_by_demand: int | None = None) -> DataFrame:
        return R.query_runs(self.runs(), item_id, store_id, top_n_by_demand)
