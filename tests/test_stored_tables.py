"""Clustered tables and saves that can be repeated."""
import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from helpers import series_df, synthetic
from retailcast.operators import policy as P
from retailcast.operators.seasonal import seasonal_frame
from retailcast.plans import etl
from retailcast.plans.queries import failing_before_runs
from retailcast.sources.clustered import buckets_for
from retailcast.sources.runs_store import RunStore


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def curated(spark, n_items=20, n_days=50):
    return spark.range(n_items * n_days * 2).select(
        F.lit("x").alias("id"), F.format_string("item%d", F.col("id") % n_items).alias("item_id"), F.lit("D").alias("dept_id"), F.lit("C").alias("cat_id"),
        F.when(F.col("id") % 2 == 0, "CA_1").otherwise("TX_1").alias("store_id"), F.lit("S").alias("state_id"), F.lit("d_1").alias("d"), (F.col("id") % 7).cast("int").alias("sales"),
        F.date_add(F.lit(dt.date(2015, 1, 1)), (F.col("id") / (2 * n_items)).cast("int")).alias("date"), F.lit(1).alias("wm_yr_wk"), F.lit(2.0).alias("sell_price"))


def test_one_series_reads_one_bucket_of_one_store(spark, tmp_dir):
    data = curated(spark)
    table = etl.curated_table(spark, f"{tmp_dir}/curated")
    table.append(data)
    one = table.read().where("item_id = 'item4' AND store_id = 'CA_1'")
    want = data.where("item_id = 'item4' AND store_id = 'CA_1'").count()
    assert want and one.count() == want
    plan = plan_of(one)
    assert re.search(r"PartitionFilters: \[[^\]]*store_id", plan) and "EqualTo(item_id,item4)" in plan
    # Only the files of one bucket are needed: the others of the store may as well be gone.
    folder = f"{tmp_dir}/curated/store_id=CA_1"
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    mine = {os.path.basename(r[0]) for r in one.select(F.input_file_name()).distinct().collect()}
    assert len(files) > 4 and len(mine) == 1
    for f in set(files) - mine:
        os.remove(f"{folder}/{f}")
    assert one.count() == want
    rows = spark.read.parquet(f"{folder}/{mine.pop()}").select("item_id", "date").collect()
    assert rows == sorted(rows)  # within the bucket by item and date


def test_layout_grows_with_the_bytes():
    assert buckets_for(0) == 8 and buckets_for(100 << 40) == 1 << 19
    assert all(buckets_for(10.0 ** k) * (256 << 20) >= 10 ** k for k in range(6, 15))


def frame_of(spark):
    return seasonal_frame(series_df(spark, synthetic(200)).union(series_df(spark, synthetic(180), item="J")), horizon=30)


PARAMS = P.PolicyParams(forecast_days=30)


def save(store, frame, batch=None, day=1):
    return store.save(frame, P.series_summary(frame, PARAMS), None, PARAMS, dt.datetime(2020, 1, day), batch)


def state(store):
    runs = sorted(tuple(r) for r in store.runs().select("run_id", "item_id", "batch_id").collect())
    days = sorted(tuple(r) for r in store.daily().groupBy("run_id").count().collect())
    return runs, days


@pytest.mark.parametrize("buckets", [None, 4])
def test_retries_add_nothing_twice(spark, tmp_dir, buckets):
    store, frame = RunStore(spark, f"{tmp_dir}/s", buckets), frame_of(spark).cache()
    assert store.runs().count() == 0 and store.unfinished_batches().count() == 0
    save(store, frame, "a")
    first = state(store)
    assert first == ([(1, "I", "a"), (2, "J", "a")], [(1, 30), (2, 30)])
    save(store, frame, "a")
    assert state(store) == first
    with failing_before_runs(store):
        save(store, frame, "b", 2)
    assert state(store) == first and [tuple(r) for r in store.unfinished_batches().collect()] == [("b", 2)]
    save(store, frame, "c", 3)  # another batch in between takes other ids
    ids = [r.run_id for r in save(store, frame, "b", 2).orderBy("run_id").collect()]
    assert ids == [3, 4] and store.unfinished_batches().count() == 0
    runs, days = state(store)
    assert [r[0] for r in runs] == [1, 2, 3, 4, 5, 6] and days == [(i, 30) for i in range(1, 7)]
    # without a batch id every save is a new one
    save(store, frame)
    save(store, frame)
    assert store.runs().count() == 10 and store.runs().select("batch_id").distinct().count() == 5


def test_a_batch_that_broke_off_between_files(spark, tmp_dir):
    """Some of the days and one of the runs are there: the rest is added."""
    store, frame = RunStore(spark, f"{tmp_dir}/s"), frame_of(spark).cache()
    full = RunStore(spark, f"{tmp_dir}/full")
    save(full, frame, "a")
    store.init()
    full.all_daily().where("run_id = 2 OR day(ds) < 10").write.mode("append").parquet(store.daily_path)
    full.runs().where("run_id = 1").write.mode("append").parquet(store.runs_path)
    save(store, frame, "a")
    assert state(store) == state(full) and store.all_daily().count() == 60


def test_runs_meet_their_days_without_an_exchange(spark, tmp_dir):
    store, frame = RunStore(spark, f"{tmp_dir}/s", 4), frame_of(spark).cache()
    save(store, frame, "a")
    save(store, frame, "b")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        both = store.load_run_days()
        plan = plan_of(both)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert both.count() == 120 and store.load_run_days(3).count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    view = store.explore("Highest avg demand", item_id="J")
    assert view.columns[:3] == ["position", "Run #", "Timestamp"] and [r["Run #"] for r in view.collect()] == [2, 4]
    again = RunStore(spark, f"{tmp_dir}/s", 4)  # another store object on the same files
    assert again.runs().count() == 4
    for t in again._clustered.values():
        t.forget()
    assert again.daily().count() == 120
