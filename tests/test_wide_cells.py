"""The wide table as one array of day cells."""
import os
import time

import pytest
from pyspark.sql import functions as F

from retailcast import api
from retailcast.operators.reshape import CELLS, melt, to_cells
from retailcast.plans import etl
from retailcast.plans.queries import Inputs
from retailcast.sources import files

IDS = "id,item_id,dept_id,cat_id,store_id,state_id"


def write(path, lines, end="\n"):
    with open(path, "w", newline="") as f:
        f.write(end.join(lines) + end)
    return path


def long_rows(df):
    return sorted((r.id, r.d, r.sales) for r in melt(df).collect())


def test_csv_line_becomes_one_array(spark, tmp_dir):
    p = write(f"{tmp_dir}/w.csv", [IDS + ",d_1,d_2,d_3", "a,I,D,C,S,T,1,,3", '"b, ""q""",I,D,C,S,T,"4",5,-6', "", "c,I,D,C,S,,3.0,NaN, 7 "])
    df = files.read_sales_cells_csv(spark, p)
    assert df.columns == [*IDS.split(","), CELLS] and dict(df.dtypes)[CELLS] == "array<int>"
    assert long_rows(df) == [("a", "d_1", 1), ("a", "d_2", None), ("a", "d_3", 3), ('b, "q"', "d_1", 4), ('b, "q"', "d_2", 5), ('b, "q"', "d_3", -6), ("c", "d_1", 3), ("c", "d_2", None), ("c", "d_3", 7)]
    assert df.where("id = 'c'").first().state_id is None


def test_same_rows_as_the_reader_by_columns(spark, tmp_dir):
    n = 40
    p = write(f"{tmp_dir}/w.csv", [IDS + "," + ",".join(f"d_{i}" for i in range(1, n + 1)), *[f"r{k},I{k},D,C,S,T," + ",".join(str((k * i) % 7) if (k + i) % 5 else "" for i in range(n)) for k in range(30)]], "\r\n")
    assert long_rows(files.read_sales_cells_csv(spark, p)) == long_rows(files.read_sales_wide_csv(spark, p))


def test_headers_by_name_and_in_several_files(spark, tmp_dir):
    d = f"{tmp_dir}/many"
    os.makedirs(d)
    head = "mon,item_id,id,dept_id,tue,cat_id,store_id,state_id"
    write(f"{d}/1.csv", [head, "1,I,a,D,2,C,S,T"])
    write(f"{d}/2.csv", [head, "3,I,b,D,4,C,S,T"])
    assert long_rows(files.read_sales_cells_csv(spark, d)) == [("a", "mon", 1), ("a", "tue", 2), ("b", "mon", 3), ("b", "tue", 4)]


@pytest.mark.parametrize(("line", "message"), [("a,I,D,C,S,T,1,two", "d_2"), ("a,I,D,C,S,T,1.5,2", "d_1"), ("a,I,D,C,S,T,1", "7 cells"), ("a,I,D,C,S,T,1,2,3", "9 cells"), ("a,I,D,C,S,T,1,99999999999", ""), ("a,I,D,C,S,T,1,-", "d_2")])
def test_bad_lines_stop_the_read(spark, tmp_dir, line, message):
    p = write(f"{tmp_dir}/w.csv", [IDS + ",d_1,d_2", "x,I,D,C,S,T,1,2", line])
    with pytest.raises(Exception, match=message):
        print(melt(files.read_sales_cells_csv(spark, p)).collect())


def test_missing_ids_or_header(spark, tmp_dir):
    with pytest.raises(ValueError, match="store_id"):
        files.read_sales_cells_csv(spark, write(f"{tmp_dir}/w.csv", ["id,item_id,dept_id,cat_id,state_id,d_1"]))
    with pytest.raises(ValueError, match="header"):
        files.read_sales_cells_csv(spark, write(f"{tmp_dir}/e.csv", [""]))
    only_ids = files.read_sales_cells_csv(spark, write(f"{tmp_dir}/i.csv", [IDS, "a,I,D,C,S,T"]))
    assert only_ids.count() == 1 and melt(only_ids).count() == 0


def test_wide_parquet(spark, tmp_dir):
    wide = spark.createDataFrame([("a", "I", "D", "C", "S", "T", 1, None), ("b", "I", "D", "C", "S", "T", 3, 4)], "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d_1 bigint, d_2 int")
    wide.write.parquet(f"{tmp_dir}/w")
    got = files.read_sales_cells_parquet(spark, f"{tmp_dir}/w")
    assert long_rows(got) == [("a", "d_1", 1), ("a", "d_2", None), ("b", "d_1", 3), ("b", "d_2", 4)]
    assert long_rows(to_cells(wide.select("d_2", *IDS.split(",")))) == [("a", "d_2", None), ("b", "d_2", 4)]


def test_one_generator_whatever_the_number_of_days(spark):
    i = Inputs(spark, "/root/testdata/sf0.001")
    t = time.time()
    plan = melt(i.wide)._jdf.queryExecution().executedPlan().toString()
    assert time.time() - t < 60 and plan.count("Generate posexplode") == 1 and "named_struct" not in plan and "pivot" not in plan
    assert dict(i.wide.dtypes)[CELLS] == "array<int>"


def test_curated_from_csv(spark, tmp_dir):
    s = write(f"{tmp_dir}/s.csv", [IDS + ",d_1,d_2,d_3", "A_CA_1,A,D,C,CA_1,CA,1,0,2", "B_CA_1,B,D,C,CA_1,CA,4,5,6"])
    c = write(f"{tmp_dir}/c.csv", ["date,wm_yr_wk,weekday,d", "2016-01-01,1,Fri,d_1", "2016-01-02,1,Sat,d_2", "2016-01-08,2,Fri,d_3"])
    p = write(f"{tmp_dir}/p.csv", ["store_id,item_id,wm_yr_wk,sell_price", "CA_1,A,1,2.0", "CA_1,A,2,2.5", "CA_1,B,2,9.0"])
    clean = api.build_curated(spark, s, c, p, f"{tmp_dir}/out")
    want = [("A", "2016-01-01", 1, 2.0), ("A", "2016-01-02", 0, 2.0), ("A", "2016-01-08", 2, 2.5), ("B", "2016-01-08", 6, 9.0)]
    assert sorted((r.item_id, str(r.date), r.sales, r.sell_price) for r in clean.collect()) == want
    assert api.load_data(spark, f"{tmp_dir}/out").where(F.col("item_id") == "A").count() == 3 and clean.columns == etl.CLEAN_COLUMNS
