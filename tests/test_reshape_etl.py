"""Reshape, ETL and sources."""
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailcast.operators.reshape import melt, metrics_side_by_side, rename, to_model_input
from retailcast.plans import etl
from retailcast.sources import files


def tiny_inputs(spark):
    wide = spark.createDataFrame(
        [("A_CA_1", "A", "D", "C", "CA_1", "CA", 1, 0, 2),
         ("B_CA_1", "B", "D", "C", "CA_1", "CA", 4, 5, 6)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, "
        "state_id string, d_1 int, d_2 int, d_3 int")
    cal = spark.createDataFrame([("d_1", "2016-01-01", 1), ("d_2", "2016-01-02", 1),
                                 ("d_3", "2016-01-08", 2)], "d string, date string, wm_yr_wk int")
    cal = cal.withColumn("date", F.to_date("date"))
    prices = spark.createDataFrame([("CA_1", "A", 1, 2.0), ("CA_1", "A", 2, 2.5),
                                    ("CA_1", "B", 2, 9.0)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    return wide, cal, prices


def test_melt_R1(spark):
    wide, _, _ = tiny_inputs(spark)
    long = melt(wide)
    assert long.columns == ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "sales"]
    rows = sorted((r.item_id, r.d, r.sales) for r in long.collect())
    assert rows == [("A", "d_1", 1), ("A", "d_2", 0), ("A", "d_3", 2),
                    ("B", "d_1", 4), ("B", "d_2", 5), ("B", "d_3", 6)]


@settings(max_examples=5, deadline=None)
@given(n_rows=st.integers(1, 4), n_days=st.integers(1, 6))
def test_melt_row_count_property(spark, n_rows, n_days):
    cols = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"] + [f"d_{i}" for i in range(1, n_days + 1)]
    data = [tuple([f"x{r}"] * 6 + list(range(n_days))) for r in range(n_rows)]
    schema = ", ".join([f"{c} string" for c in cols[:6]] + [f"{c} int" for c in cols[6:]])
    assert melt(spark.createDataFrame(data, schema)).count() == n_rows * n_days


def test_build_sales_clean_C1_J1_J2_F1(spark):
    wide, cal, prices = tiny_inputs(spark)
    clean = etl.build_sales_clean(wide, cal, prices)
    got = sorted((r.item_id, str(r.date), r.sales, r.sell_price) for r in clean.collect())
    # B has no price in week 1 -> its first two days are dropped
    assert got == [("A", "2016-01-01", 1, 2.0), ("A", "2016-01-02", 0, 2.0),
                   ("A", "2016-01-08", 2, 2.5), ("B", "2016-01-08", 6, 9.0)]
    priced = etl.priced_long(melt(wide), cal, prices)
    assert priced.filter(F.col("sell_price").isNull()).count() == 2


def test_model_input_and_rename_R2_R5(spark):
    wide, cal, prices = tiny_inputs(spark)
    mi = to_model_input(etl.build_sales_clean(wide, cal, prices))
    assert mi.columns == ["item_id", "store_id", "ds", "y"]
    assert dict(mi.dtypes)["y"] == "double"
    r = rename(mi, {"item_id": "Product", "y": "Units"})
    assert r.columns == ["Product", "Units"]


def test_metrics_side_by_side_R6(spark):
    long = spark.createDataFrame([("s", "m1", "A", 1.0), ("s", "m1", "B", 2.0), ("s", "m2", "A", 3.0)],
                                 "store_id string, metric string, slot string, value double")
    out = {r.metric: (r.A, r.B) for r in metrics_side_by_side(long, ["store_id"]).collect()}
    assert out == {"m1": (1.0, 2.0), "m2": (3.0, None)}


def test_csv_sources_S1_and_parquet_S2_S3_S5(spark, tmp_dir):
    wide, cal, prices = tiny_inputs(spark)
    p = os.path.join(tmp_dir, "in")
    os.makedirs(p)
    with open(os.path.join(p, "sales.csv"), "w") as f:
        f.write("id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2,d_3\n")
        f.write("A_CA_1,A,D,C,CA_1,CA,1,0,2\nB_CA_1,B,D,C,CA_1,CA,4,5,6\n")
    with open(os.path.join(p, "calendar.csv"), "w") as f:
        f.write("date,wm_yr_wk,weekday,d\n2016-01-01,1,Fri,d_1\n2016-01-02,1,Sat,d_2\n2016-01-08,2,Fri,d_3\n")
    with open(os.path.join(p, "prices.csv"), "w") as f:
        f.write("store_id,item_id,wm_yr_wk,sell_price\nCA_1,A,1,2.0\nCA_1,A,2,2.5\nCA_1,B,2,9.0\n")
    w = files.read_sales_wide_csv(spark, os.path.join(p, "sales.csv"))
    assert dict(w.dtypes)["d_2"] == "int" and dict(w.dtypes)["store_id"] == "string"
    c = files.read_calendar_csv(spark, os.path.join(p, "calendar.csv"))
    pr = files.read_prices_csv(spark, os.path.join(p, "prices.csv"))
    clean = etl.build_sales_clean(w, c, pr)
    assert clean.count() == 4
    out = os.path.join(tmp_dir, "curated")
    etl.write_curated(clean, out)
    assert sorted(os.listdir(out))[0].startswith("_") or any(n.startswith("store_id=") for n in os.listdir(out))
    one = files.read_curated(spark, out, item_id="A", store_id="CA_1")
    assert one.count() == 3
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan


def test_melt_mixed_types_G9(spark):
    wide = spark.createDataFrame([("a", "i", "d", "c", "s", "t", 1, 2)],
                                 "id string, item_id string, dept_id string, cat_id string, "
                                 "store_id string, state_id string, d_1 bigint, d_2 int")
    long = melt(wide)
    assert dict(long.dtypes)["sales"] == "int"
    assert sorted(r.sales for r in long.collect()) == [1, 2]


def test_curated_dates_roundtrip_G15(spark, tmp_dir):
    import datetime as dt

    import pandas as pd
    wide, cal, prices = tiny_inputs(spark)
    out = os.path.join(tmp_dir, "curated")
    etl.write_curated(etl.build_sales_clean(wide, cal, prices), out)
    back = files.read_curated(spark, out)
    assert dict(back.dtypes)["date"] == "date"
    # an external file with microsecond timestamps loads and casts to DATE
    ext = os.path.join(tmp_dir, "ext.parquet")
    pd.DataFrame({"ts": pd.to_datetime(["2016-01-01 00:00:00"]).astype("datetime64[us]")}).to_parquet(ext)
    got = spark.read.parquet(ext).select(F.col("ts").cast("date").alias("d")).first().d
    assert got == dt.date(2016, 1, 1)
