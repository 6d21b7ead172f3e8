"""Seasonal model (M6, M2-M4), backtest (M5, A5, A6), policy (I1-I5) and traps."""
import datetime as dt
import math

from pyspark.sql import functions as F

from retailcast.operators import evaluate as E
from retailcast.operators import policy as P
from retailcast.operators.seasonal import seasonal_frame
from tests.helpers import series_df, synthetic


def test_seasonal_recovers_noise_free_series_M6_M5(spark):
    fr = seasonal_frame(series_df(spark, synthetic(200)))
    hist = fr.filter("NOT is_future")
    err = hist.agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert err < 0.02
    assert fr.filter("is_future").count() == 90
    # components add up (M4) and the band brackets yhat (M3)
    bad = fr.filter(F.abs(F.col("trend") + F.col("weekly") + F.col("yearly") - F.col("yhat")) > 1e-9)
    assert bad.count() == 0
    assert fr.filter((F.col("yhat_lower") > F.col("yhat")) | (F.col("yhat") > F.col("yhat_upper"))).count() == 0
    m = E.backtest_metrics(fr).first()
    assert m.mape < 1.0 and m.n_compared == 90 and m.holdout_days == 90


def test_backtest_needs_150_rows_and_nonzero_G12(spark):
    short = seasonal_frame(series_df(spark, synthetic(149)))
    assert E.backtest_metrics(short).first().mape is None
    zeros = [1.0] * 110 + [0.0] * 90
    m = E.backtest_metrics(seasonal_frame(series_df(spark, zeros))).first()
    assert m.mape is None and m.rmse is None and m.n_compared == 90


def test_backtest_gaps_compare_fewer_days_G11(spark):
    start = dt.date(2015, 1, 5)
    days = [start + dt.timedelta(days=i) for i in range(100)] + \
           [start + dt.timedelta(days=100 + 2 * i) for i in range(90)]  # test rows every other day
    df = series_df(spark, synthetic(190), days=days)
    m = E.backtest_metrics(seasonal_frame(df)).first()
    assert m.n_compared == 45  # only the first 90 calendar days after training end


def policy_frame(spark, yhat, price=2.0, hist_days=40):
    """A hand-made frame: history rows then future rows with a given yhat."""
    import pandas as pd
    start = dt.date(2020, 1, 1)
    last = start + dt.timedelta(days=hist_days - 1)
    rows = []
    for i in range(hist_days):
        rows.append((start + dt.timedelta(days=i), False, 1.0))
    for h, v in enumerate(yhat, 1):
        rows.append((last + dt.timedelta(days=h), True, v))
    pdf = pd.DataFrame(rows, columns=["ds", "is_future", "yhat"])
    pdf["item_id"], pdf["store_id"], pdf["last_ds"], pdf["avg_price"] = "I", "S", last, price
    pdf["yhat_lower"], pdf["yhat_upper"] = pdf["yhat"] - 1, pdf["yhat"] + 1
    return spark.createDataFrame(pdf)


def test_policy_hand_computed_I1_I4(spark):
    yhat = [4.0, -2.0, 6.0]  # clipped: 4, 0, 6 -> mean 10/3, sample std
    p = P.inventory_policy(policy_frame(spark, yhat), P.PolicyParams(3, 7, 10.0, 0.2)).first()
    mu = 10 / 3
    sd = math.sqrt(((4 - mu) ** 2 + mu ** 2 + (6 - mu) ** 2) / 2)
    ss = 1.645 * sd * math.sqrt(7)
    assert math.isclose(p.avg_daily_demand, mu) and math.isclose(p.std_daily_demand, sd)
    assert math.isclose(p.safety_stock, ss) and math.isclose(p.rop, mu * 7 + ss)
    assert math.isclose(p.eoq, math.sqrt(2 * 365 * mu * 10 / (0.2 * 2.0)))


def test_policy_zero_price_G1_and_one_day_G13(spark):
    p = P.inventory_policy(policy_frame(spark, [5.0, 5.0], price=0.0), P.PolicyParams(2)).first()
    assert p.eoq is None and p.safety_stock == 0.0
    p1 = P.inventory_policy(policy_frame(spark, [5.0]), P.PolicyParams(1)).first()
    assert p1.std_daily_demand is None and p1.safety_stock is None and p1.rop is None
    assert p1.eoq is not None


def test_policy_properties(spark):
    yhat = [3.0, 1.0, 8.0, 2.0, 5.0]
    base = P.inventory_policy(policy_frame(spark, yhat), P.PolicyParams(5, 7, 10.0)).first()
    quad = P.inventory_policy(policy_frame(spark, yhat), P.PolicyParams(5, 7, 40.0)).first()
    assert base.safety_stock >= 0 and base.rop >= base.safety_stock
    assert math.isclose(quad.eoq, 2 * base.eoq)  # EOQ scales with sqrt(ordering cost)


def test_insights_ties_first_day_G6_and_empty_sum_G14(spark):
    ins = P.forecast_insights(policy_frame(spark, [1.0, 7.0, 7.0, -1.0, 0.0])).first()
    start = dt.date(2020, 1, 1) + dt.timedelta(days=39)
    assert ins.peak_ds == start + dt.timedelta(days=2) and ins.peak_yhat == 7.0
    assert ins.low_ds == start + dt.timedelta(days=4) and ins.low_yhat == 0.0
    assert ins.total_forecast == 15.0


def test_series_summary_equals_separate_aggregates(spark):
    fr = seasonal_frame(series_df(spark, synthetic(200)))
    s = P.series_summary(fr).first()
    p = P.inventory_policy(fr).first()
    m = E.backtest_metrics(fr).first()
    assert math.isclose(s.eoq, p.eoq) and math.isclose(s.rop, p.rop)
    assert math.isclose(s.mape, m.mape) and s.n_compared == m.n_compared


def test_rmse_at_least_mae(spark):
    fr = seasonal_frame(series_df(spark, [float((i * 7) % 5) for i in range(200)]))
    cmp = E.backtest_comparison(fr)
    mae = cmp.agg(F.avg(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert E.backtest_metrics(fr).first().rmse >= mae - 1e-12
