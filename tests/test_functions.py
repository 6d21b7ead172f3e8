"""Scalar functions and the traps G1, G2, G3, G7."""
import datetime as dt

from pyspark.sql import functions as F

from retailcast.functions import scalar as X


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols)) if cols else spark.range(1)
    return df.select(expr.alias("v")).first()["v"]


def test_clip_keeps_null_G2(spark):
    df = spark.createDataFrame([(-2.0,), (3.0,), (None,)], "x double")
    got = [r.v for r in df.select(X.clip0("x").alias("v")).collect()]
    assert got == [0.0, 3.0, None]
    # the trap: greatest(0, NULL) is 0 in Spark
    assert one(spark, F.greatest(F.lit(0.0), F.lit(None).cast("double"))) == 0.0


def test_safe_div_G1(spark):
    assert one(spark, X.safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, X.safe_div(F.lit(1.0), F.lit(4.0))) == 0.25


def test_nan_to_null_G3(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (4.0,)], "x double")
    assert df.select(F.avg(X.nan_to_null("x"))).first()[0] == 3.0


def test_round_half_up_G7(spark):
    assert one(spark, X.round_half_up(F.lit(2.5), 0)) == 3.0
    assert one(spark, X.round_half_up(F.lit(1.234567891), 6)) == 1.234568
    assert one(spark, X.round_half_up(F.lit(-1.25), 1)) == -1.3


def test_accuracy_band_X10(spark):
    df = spark.createDataFrame([(None,), (5.0,), (20.0,), (39.9,), (40.0,)], "m double")
    got = [r.v for r in df.select(X.accuracy_band("m").alias("v")).collect()]
    assert got == ["N/A", "good", "fair", "fair", "poor"]


def test_intermittent_X11(spark):
    assert one(spark, X.is_intermittent(F.lit(1.49))) is True
    assert one(spark, X.is_intermittent(F.lit(1.5))) is False


def test_labels_X8_X9(spark):
    assert one(spark, X.demand_label(F.lit("A_1"), F.lit(1.234))) == "A_1  —  1.23 units/day"
    assert one(spark, X.date_label(F.lit(dt.date(2016, 3, 7)))) == "Mar 07, 2016"


def test_map_lookup_J5_J6_J7(spark):
    m = {"CA_1": "California - Store 1"}
    assert one(spark, X.map_lookup(m, F.lit("CA_1"))) == "California - Store 1"
    assert one(spark, X.map_lookup(m, F.lit("ZZ"))) is None
    assert one(spark, X.map_lookup(m, F.lit("ZZ"), default_to_key=True)) == "ZZ"
    assert one(spark, X.reverse_lookup(m, F.lit("California - Store 1"))) == "CA_1"


def test_ratios_X13_X14(spark):
    assert one(spark, X.demand_ratio(F.lit(1.0), F.lit(0.0))) == 100.0
    assert one(spark, X.symmetric_ratio(F.lit(0.5))) == 2.0
    assert one(spark, X.symmetric_ratio(F.lit(3.0))) == 3.0
    assert one(spark, X.pick_by(F.lit(1.0) >= 1, F.lit("a"), F.lit("b"))) == "a"
    assert one(spark, X.pick_by(F.lit(None).cast("boolean"), F.lit("a"), F.lit("b"))) == "b"
