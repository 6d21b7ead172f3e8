"""Per-series operators: F2, F7, F9, F10, O1-O4, O8 (and G5)."""
import datetime as dt

from pyspark.sql import functions as F

from retailcast.operators import series as S
from tests.helpers import series_df


def test_min_history_F9_boundary(spark):
    df = series_df(spark, range(29), item="a").unionByName(series_df(spark, range(30), item="b"))
    assert {r.item_id for r in S.min_history(df).select("item_id").distinct().collect()} == {"b"}
    counts = {r.item_id: (r.n_rows, r.has_history) for r in S.series_counts(df).collect()}
    assert counts == {"a": (29, False), "b": (30, True)}


def test_holdout_split_F10_O2(spark):
    df = series_df(spark, range(149), item="a").unionByName(series_df(spark, range(150), item="b"))
    sp = S.holdout_split(df)
    agg = {r.item_id: (r.n_test, r.ev) for r in sp.groupBy("item_id").agg(
        F.count_if("is_test").alias("n_test"), F.first("evaluable").alias("ev")).collect()}
    assert agg == {"a": (90, False), "b": (90, True)}
    # test rows are the LAST 90 by date, whatever the input order
    last = sp.filter("item_id = 'b' AND is_test").agg(F.min("ds")).first()[0]
    assert last == dt.date(2015, 1, 5) + dt.timedelta(days=60)


def test_tail_and_day_index_O1_O4(spark):
    df = series_df(spark, range(10)).orderBy(F.rand(7))  # shuffled input order
    tail = S.tail_rows(df, 3)
    assert sorted(r.y for r in tail.collect()) == [7.0, 8.0, 9.0]
    idx = {r.y: r.day for r in S.day_index(df).collect()}
    assert idx[0.0] == 0 and idx[9.0] == 9


def test_single_series_F2(spark):
    df = series_df(spark, [1, 2], item="a").unionByName(series_df(spark, [3], item="b"))
    assert S.single_series(df, "b", "S").count() == 1


def test_future_spine_O3_and_after_last_F7(spark):
    df = series_df(spark, [1, 2, 3])
    sp = S.future_spine(df, 5)
    assert sp.count() == 8 and sp.filter("is_future").count() == 5
    assert sp.agg(F.max("ds")).first()[0] == dt.date(2015, 1, 12)
    fut = S.after_last(sp, df)
    assert fut.count() == 5
