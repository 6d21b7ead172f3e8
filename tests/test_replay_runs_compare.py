"""Replay (O5, O6), saved runs (S7-S10, O9, T1-T4, A10, F5, F8, J9), compare."""
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from retailcast.operators import compare as CMP
from retailcast.operators import policy as P
from retailcast.operators import replay as RP
from retailcast.operators import runs as R
from retailcast.operators.ids import dense_ids
from retailcast.sources.runs_store import RunStore
from tests.test_forecast_policy import policy_frame


def python_replay(demand, eoq, rop):
    level, out = eoq, []
    for d in demand:
        ordered = level <= rop
        if ordered:
            level += eoq
        level = max(0.0, level - d)
        out.append((level, ordered))
    return out


def test_replay_matches_loop_O5_O6(spark):
    demand = [4.0, 9.0, 0.0, 12.0, 3.0, 7.0, 1.0, 8.0]
    fr = policy_frame(spark, demand, price=50.0)
    params = P.PolicyParams(len(demand), 2, 90.0, 0.2)
    lv = RP.replay(fr, params).orderBy("day").collect()
    eoq, rop = lv[0].eoq, lv[0].rop
    expect = python_replay(demand, eoq, rop)
    assert [(r.level, r.ordered) for r in lv] == expect
    assert all(r.level >= 0 for r in lv)
    orders = RP.replay_orders(RP.replay(fr, params)).first()
    assert orders.n_orders == sum(o for _, o in expect) and orders.n_days == len(demand)


def test_dense_ids_match_global_row_number(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("p"), (F.col("id") % 17).cast("string").alias("k"),
                                 F.col("id").alias("v"))
    got = dense_ids(df, ["p", "k", "v"], 10, "rid", ranges=5)
    ref = df.withColumn("rid2", F.row_number().over(Window.orderBy("p", "k", "v")) + 10)
    j = got.join(ref, ["p", "k", "v"])
    assert j.filter(F.col("rid") != F.col("rid2")).count() == 0 and j.count() == 500


def fake_policy(spark):
    rows = [("A", "S1", 5.0, 12.0, 3.0), ("B", "S1", 9.0, None, 2.0), ("C", "S2", 9.0, 30.0, 1.0)]
    pol = spark.createDataFrame(rows, "item_id string, store_id string, avg_daily_demand double, "
                                      "mape double, std_daily_demand double")
    pol = pol.select("item_id", "store_id", F.lit(1).alias("param_set"), F.lit(90).alias("forecast_days"),
                     F.lit(7).alias("lead_time_days"), F.lit(10.0).alias("ordering_cost"),
                     F.lit(0.2).alias("holding_cost"), "avg_daily_demand", "std_daily_demand",
                     (F.col("std_daily_demand") * 2).alias("safety_stock"), F.lit(40.0).alias("rop"),
                     F.lit(3.0).alias("eoq"))
    met = spark.createDataFrame(rows, "item_id string, store_id string, a double, mape double, b double") \
        .select("item_id", "store_id", "mape", F.col("b").alias("rmse"))
    return pol, met


def test_run_store_roundtrip_S7_S10_G20(spark, tmp_dir):
    store = RunStore(spark, tmp_dir + "/db")
    assert store.runs().count() == 0 and store.load_all_runs().count() == 0  # S10 typed empty
    pol, met = fake_policy(spark)
    fr = policy_frame(spark, [1.0, 2.0]).withColumn("item_id", F.lit("A")).withColumn("store_id", F.lit("S1"))
    first = store.save(fr, pol, met, P.PolicyParams(2), run_at=dt.datetime(2024, 1, 1))
    assert sorted(r.run_id for r in first.collect()) == [1, 2, 3]
    second = store.save(fr, pol, met, P.PolicyParams(2), run_at=dt.datetime(2024, 1, 2))
    assert sorted(r.run_id for r in second.collect()) == [4, 5, 6]  # re-running appends (G20)
    assert store.runs().count() == 6
    days = store.load_run_forecast(1).collect()  # run 1 = (A, S1) -> 2 future days in order
    assert [r.ds for r in days] == sorted(r.ds for r in days) and len(days) == 2
    latest = store.load_all_runs(4).collect()
    assert [r.run_id for r in latest] == [6, 5, 4, 3]
    assert store.query_runs(store_id="S1").count() == 4
    assert store.query_runs(item_id="", store_id=None).count() == 6  # falsy = no filter (G17)
    top = store.query_runs(top_n_by_demand=1).first()
    assert top.avg_daily_demand == 9.0 and top.run_id == 2  # tie on demand -> lower id


def test_sort_nulls_last_and_kpis_G4_G8(spark):
    pol, met = fake_policy(spark)
    runs = R.build_runs(pol, met, dt.datetime(2024, 1, 1), 0)
    latest = R.latest_runs(runs, 200)
    srt = [r.mape for r in R.sort_runs(latest, "mape", True).collect()]
    assert srt == [12.0, 30.0, None]
    k = R.runs_kpis(latest).first()
    assert (k.n_runs, k.n_items, k.n_stores, k.avg_mape) == (3, 3, 2, 21.0)
    assert spark.range(1).select(R.next_run_id(runs)).first()[0] == 3
    disp = R.DISPLAY_NAMES
    assert "Run #" in [disp[c] for c in R.RUN_COLUMNS if c in disp]


def test_compare_and_takeaway_C3(spark):
    summ = spark.createDataFrame(
        [("A", "S", 90, 2.0, 1.0, 180.0, 5.0, 19.0, 3.0, 10.0, 1.0),
         ("B", "S", 90, 4.0, 0.5, 360.0, 2.0, 30.0, 2.0, None, None),
         ("C", "S", 90, 1.0, 0.1, 90.0, 1.0, 8.0, 1.0, 5.0, 1.0)],
        "item_id string, store_id string, forecast_days int, avg_daily_demand double, "
        "std_daily_demand double, total_forecast double, safety_stock double, rop double, "
        "eoq double, mape double, rmse double")
    pairs = CMP.top_pairs(summ)
    assert [(r.item_a, r.item_b) for r in pairs.collect()] == [("B", "A")]
    t = CMP.compare_takeaway(summ, pairs).first()
    assert t.demand_ratio == 2.0 and t.higher_item == "B" and t.lower_item == "A"
    assert t.ratio_val == 2.0 and t.higher_ss_item == "A"
    t2 = CMP.takeaway_top_two(summ).first()
    assert (t2.higher_item, t2.higher_ss_item) == ("B", "A")
    m = {r.metric: (r.A, r.B) for r in CMP.compare_top_two(summ).collect()}
    assert m["Total Forecast (90 days)"] == (360.0, 180.0) and m["MAPE (Backtest)"] == (None, 10.0)
    m2 = {r.metric: (r.A, r.B) for r in CMP.compare_metrics(summ, pairs).collect()}
    assert m2 == m


def test_rank_within_matches_row_number(spark):
    from retailcast.operators.ids import rank_within
    df = spark.range(3000).select((F.col("id") % 4).cast("string").alias("g"),
                                  F.when(F.col("id") % 97 == 0, F.lit(None))
                                  .otherwise((F.col("id") * 7919 % 101).cast("double")).alias("v"),
                                  F.format_string("i%05d", "id").alias("k"))
    got = rank_within(df, "g", "v", "k", ranges=16)
    ref = df.withColumn("r2", F.row_number().over(
        Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), "k")))
    j = got.join(ref, ["g", "k"])
    assert j.count() == 3000 and j.filter(F.col("rank") != F.col("r2")).count() == 0
