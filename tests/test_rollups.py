"""Aggregates kept up by appended days equal a new pass (A1, A2, A10)."""
import datetime as dt
import random

from pyspark.sql import functions as F

from retailcast.operators import catalog as C
from retailcast.operators import rollups as RU
from retailcast.operators.rollups import RollupStore

R = random.Random(8)
SCHEMA = "item_id string, dept_id string, cat_id string, store_id string, state_id string, date date, sales int"


def rows(n, first, days):
    pick = lambda *xs: R.choice(xs)
    return [(pick("a", "b", "c", None), pick("d", "d2", None), pick("k", None, "k"), pick("s1", "s2", None), "S", pick(dt.date(2020, 1, first + R.randint(0, days - 1)), None), pick(1, 2, 7, None)) for _ in range(n)]


def answers(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def check(store, data):
    parts = store.read()
    assert answers(RU.demand_summary(parts)) == answers(C.demand_summary(data))
    assert answers(RU.daily_total(parts)) == answers(data.groupBy("date").agg(F.sum("sales").cast("long")))
    known = data.where("store_id IS NOT NULL")
    assert tuple(RU.kpis(parts).first()) == (known.count(), data.select("item_id").where("item_id IS NOT NULL").distinct().count(), known.select("store_id").distinct().count(),
                                             *data.agg(F.min("date"), F.max("date")).first())


def test_appended_days_and_repeated_batches(spark, tmp_dir):
    store = RollupStore(spark, f"{tmp_dir}/r")
    assert store.read().count() == 0 and tuple(RU.kpis(store.read()).first()) == (0, 0, 0, None, None)
    batches = [spark.createDataFrame(rows(300, 1 + 5 * k, 6), SCHEMA).cache() for k in range(3)]
    store.append(batches[0], "0")
    check(store, batches[0])
    store.append(batches[1], "1")
    store.append(batches[1], "1")
    store.append(batches[2], "2")
    everything = batches[0].union(batches[1]).union(batches[2])
    check(store, everything)
    small = store.compact(f"{tmp_dir}/small")
    check(small, everything)
    for k in range(3):
        small.append(batches[k], str(k))  # a compacted store knows its batches
    check(small, everything)
    more = spark.createDataFrame(rows(50, 20, 2), SCHEMA)
    small.append(more, "3")
    check(small, everything.union(more))
    assert small.stored().count() < store.stored().count() + 40
    assert answers(RU.merged(small.read())) == answers(small.read())


def test_a_broken_append_is_finished(spark, tmp_dir):
    data = spark.createDataFrame(rows(200, 1, 9), SCHEMA).cache()
    store = RollupStore(spark, f"{tmp_dir}/r")
    RU.partials(data).withColumn("batch_id", F.lit("0")).where("kind = 'day' OR item_id = 'a'").select(*RU.SCHEMA.names).write.parquet(store.path)
    store.append(data, "0")
    check(store, data)


def test_one_pass_over_the_days(spark):
    plan = RU.partials(spark.createDataFrame(rows(20, 1, 3), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Scan") == 1
