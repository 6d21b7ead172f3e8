"""One test for each silent cut or switch that must not come back."""
import datetime as dt

import pytest
from helpers import series_df, synthetic

from retailcast import api
from retailcast.functions import scalar as X
from retailcast.operators import policy as P
from retailcast.operators.additive_model import map_frame
from retailcast.operators.replay import replay
from retailcast.operators.seasonal import seasonal_frame
from retailcast.sources import files
from retailcast.sources.runs_store import RunStore


def test_longer_horizon_than_the_frame_is_an_error(spark):
    frame = seasonal_frame(series_df(spark, synthetic(200)), horizon=90)
    long = P.PolicyParams(forecast_days=180)
    for f in (P.inventory_policy, P.forecast_insights, P.series_summary, replay):
        with pytest.raises(ValueError, match="90"):
            f(frame, long)
    assert P.future_days(frame, P.PolicyParams(forecast_days=90)).count() == 90


def test_unknown_model_is_an_error(spark):
    with pytest.raises(ValueError, match="model"):
        api.train_forecast(series_df(spark, synthetic(60)), model="sesonal")


def test_csv_by_name_and_without_silent_nulls(spark, tmp_dir):
    with open(f"{tmp_dir}/w.csv", "w") as f:
        f.write('"id",item_id,dept_id,cat_id,store_id,state_id,d_1,d_2\na,I,D,C,S,T,3.0,\n')
    assert files.read_sales_wide_csv(spark, f"{tmp_dir}/w.csv").select("id", "d_1", "d_2").first() == ("a", 3, None)
    with open(f"{tmp_dir}/p.csv", "w") as f:
        f.write("item_id,store_id,sell_price,wm_yr_wk\nI,S,NaN,5\n")
    assert files.read_prices_csv(spark, f"{tmp_dir}/p.csv").first() == ("S", "I", 5, None)
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("item_id,store_id,sell_price,wm_yr_wk\nI,S,cheap,5\n")
    with pytest.raises(Exception, match="sell_price"):
        files.read_prices_csv(spark, f"{tmp_dir}/b.csv").collect()


def test_store_on_a_uri_root_and_after_a_failed_save(spark, tmp_dir):
    root = f"file://{tmp_dir}/store"
    frame = seasonal_frame(series_df(spark, synthetic(200)), horizon=30)
    params = P.PolicyParams(forecast_days=30)
    summary = P.series_summary(frame, params)
    metrics = summary.select("item_id", "store_id", "mape", "rmse")
    store = RunStore(spark, root)
    ids = [store.save(frame, summary, metrics, params, dt.datetime(2020, 1, i)).first()["run_id"] for i in (1, 2)]
    assert ids == [1, 2] and store.runs().count() == 2 and store.load_run_forecast(1).count() == 30
    # the days of a save that failed before its run rows were written
    store.daily().where("run_id = 2").selectExpr("3 AS run_id", "ds", "yhat", "yhat_lower", "yhat_upper").write.mode("append").parquet(store.daily_path)
    assert store.save(frame, summary, metrics, params, dt.datetime(2020, 1, 3)).first()["run_id"] == 4


def test_a_null_day_does_not_empty_the_additive_model(spark):
    values = synthetic(200)
    df = series_df(spark, values)
    from pyspark.sql import functions as F
    day = dt.date(2015, 1, 5) + dt.timedelta(days=50)
    frame = map_frame(df.withColumn("y", F.when(F.col("ds") != F.lit(day), F.col("y"))), horizon=30)
    row = P.inventory_policy(frame, P.PolicyParams(forecast_days=30)).first()
    assert row["avg_daily_demand"] is not None and row["safety_stock"] is not None


def test_reverse_lookup_in_its_scope(spark):
    names = {"CA": {"CA_1": "Store 1", "CA_2": "Store 2"}, "TX": {"TX_1": "Store 1"}}
    df = spark.createDataFrame([("TX", "Store 1"), ("CA", "Store 1"), ("TX", "Store 2")], "state string, label string")
    got = [r[0] for r in df.select(X.scoped_reverse_lookup(names, "state", "label")).collect()]
    assert got == ["TX_1", "CA_1", None]
    with pytest.raises(ValueError):
        X.reverse_lookup({"CA_1": "Store 1", "TX_1": "Store 1"}, "label")
