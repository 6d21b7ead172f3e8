"""Ids and ranks over ranges of the whole sort key."""
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from retailcast.operators.catalog import dept_products
from retailcast.operators.ids import dense_ids, place_in_ranges, rank_within
from retailcast.plans.queries import Inputs, registered

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(i % 7 if i % 5 else None, f"k{i % 11}") for i in range(500)], "a int, b string")
    got = dense_ids(df, ["a", "b"], 100, "id", ranges=9).orderBy("id").collect()
    assert [r.id for r in got] == list(range(101, 601))
    keys = [(r.a is not None, r.a or 0, r.b) for r in got]
    assert keys == sorted(keys)
    assert dense_ids(df.limit(0), ["a", "b"]).count() == 0


def test_ids_keep_other_columns_and_names(spark):
    df = spark.createDataFrame([(i, i, i) for i in range(20)], "k int, _range int, _position int")
    got = dense_ids(df, ["k"], ranges=4)
    assert got.columns == ["k", "_range", "_position", "id"]
    assert all(r.id == r.k + 1 == r._range + 1 == r._position + 1 for r in got.collect())


def rows_to_one_task(plan):
    """Exchanges to one partition of anything but the partial results of an aggregate (a row of each task)."""
    lines = plan.splitlines()
    return [a for a, b in zip(lines, lines[1:]) if "SinglePartition" in a and "partial_" not in b]


def test_no_single_task_in_the_plans_of_saved_runs(spark):
    i = Inputs(spark, SF)
    plans = {"runs": i.runs()} | {n: registered()[n](spark, SF) for n in ("runs_latest", "runs_top_by_demand", "runs_sorted_nulls_last", "run_detail", "runs_next_id")}
    for name, df in plans.items():
        assert rows_to_one_task(plan_of(df)) == [], name
    assert rows_to_one_task(plan_of(i.runs().withColumn("r", F.row_number().over(Window.orderBy("run_id")))))  # the test sees one


def test_one_department_of_ties_is_split(spark):
    """All products have the same demand: the ranges split by the tie, and no task gets most of them."""
    n = 4000
    df = spark.range(n).select(F.lit("D").alias("dept_id"), F.format_string("item%05d", F.col("id")).alias("item_id"), F.lit(1.5).alias("avg_daily_demand")).repartition(6)
    order = [F.col("dept_id").asc_nulls_first(), F.col("avg_daily_demand").desc_nulls_last(), F.col("item_id").asc()]
    placed, part, _ = place_in_ranges(df, order, 10)
    sizes = Counter(r[0] for r in placed.select(part).collect())
    assert len(sizes) == 10 and max(sizes.values()) < 2 * n / 10
    ranked = rank_within(df, "dept_id", "avg_daily_demand", "item_id", ranges=10)
    assert [r.item_id for r in ranked.orderBy("rank").collect()] == [f"item{i:05d}" for i in range(n)]
    assert [r.rank for r in ranked.orderBy("rank").collect()] == list(range(1, n + 1))


def test_ranks_match_a_window(spark):
    rows = [(None if i % 97 == 0 else f"g{i % 3}", None if i % 13 == 0 else float(i % 6), i) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, v double, k int")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), F.col("k"))
    want = {r.k: r.r for r in df.withColumn("r", F.row_number().over(w)).collect()}
    assert {r.k: r["rank"] for r in rank_within(df, "g", "v", "k", ranges=12).collect()} == want
    labelled = dept_products(df.select(F.col("g").alias("dept_id"), F.col("k").cast("string").alias("item_id"), F.col("v").alias("avg_daily_demand")), with_label=True)
    assert labelled.count() == 700
