"""User-level API compositions (C2, C4, C5, S6) on one synthetic series."""
import os

from pyspark.sql import functions as F

from retailcast import api
from tests.helpers import series_df, synthetic


def test_pipeline_save_and_read_back(spark, tmp_dir):
    mi = series_df(spark, synthetic(200)).unionByName(series_df(spark, synthetic(20), item="short"))
    res = api.run_pipeline(mi, api.PolicyParams(30, 7, 10.0, 0.2))
    rows = res.summary.collect()
    assert [r.item_id for r in rows] == ["I"]  # the 20-row series has no result (F9)
    assert rows[0].mape < 1.0 and rows[0].eoq > 0
    store = api.open_store(spark, os.path.join(tmp_dir, "db"))
    saved = api.save_results(store, res, api.PolicyParams(30, 7, 10.0, 0.2)).collect()
    assert [r.run_id for r in saved] == [1]
    assert store.load_run_forecast(1).count() == 30
    api.save_forecast(res.frame, os.path.join(tmp_dir, "fc"))
    back = spark.read.parquet(os.path.join(tmp_dir, "fc"))
    assert back.filter(F.col("is_future")).count() == 30
    lv = api.simulate_inventory(res.frame, api.PolicyParams(30)).collect()
    assert len(lv) == 30 and all(r.level >= 0 for r in lv)
