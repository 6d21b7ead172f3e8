"""Catalog drill-down.

Category -> department -> products by mean demand; state -> stores.  The
demand summary is one partially aggregated ``groupBy``; per-department ranks
are a window over the (small) summary, where ``rank <= k`` is planned as a
per-group top-k before the exchange.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import demand_label, map_lookup, reverse_lookup
from .ids import rank_within


def demand_summary(sales: DataFrame) -> DataFrame:
    """Mean daily demand per (item, category, department) over its store-days.

    NULL keys are dropped first (pandas group-by drops them)."""
    return (sales.filter(F.col("item_id").isNotNull() & F.col("cat_id").isNotNull()
                         & F.col("dept_id").isNotNull())
            .groupBy("item_id", "cat_id", "dept_id")
            .agg(F.avg("sales").alias("avg_daily_demand")))


def dept_products(summary: DataFrame, dept_id: str | None = None, top: int | None = None,
                  with_label: bool = False) -> DataFrame:
    """Products of a department (or of every department) by demand, descending.

    Ties are broken by ``item_id``; ``rank`` is 1-based within the department.
    """
    df = summary if dept_id is None else summary.filter(F.col("dept_id") == F.lit(dept_id))
    if top:
        # top-k: planned as a per-group limit before the exchange
        w = Window.partitionBy("dept_id").orderBy(F.col("avg_daily_demand").desc_nulls_last(),
                                                  F.col("item_id"))
        df = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    else:
        # full ranking: ranges over (department, demand, item), so ties split too
        df = rank_within(df, "dept_id", "avg_daily_demand", "item_id")
    if with_label:
        df = df.withColumn("label", demand_label("item_id", "avg_daily_demand"))
    return df


def departments_of_category(depts: DataFrame, cat_col: str = "cat_id",
                            dept_col: str = "dept_id") -> DataFrame:
    """Departments whose id starts with the category id."""
    return depts.filter(F.col(dept_col).startswith(F.col(cat_col)))


def stores_of_state(stores: DataFrame, state_id: str | None = None) -> DataFrame:
    """State -> its stores (J8), sorted."""
    df = stores.select("state_id", "store_id").distinct()
    if state_id is not None:
        df = df.filter(F.col("state_id") == F.lit(state_id))
    return df.orderBy("state_id", "store_id")


def stores_by_state_map(spark: SparkSession, mapping: Mapping[str, list[str]]) -> DataFrame:
    """Explode a literal state -> [stores] mapping into rows."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return spark.range(1).select(F.explode(m).alias("state_id", "stores")) \
        .select("state_id", F.explode("stores").alias("store_id"))


def with_labels(df: DataFrame, col: str, mapping: Mapping[str, str], label_col: str,
                default_to_key: bool = True) -> DataFrame:
    """Attach a label from a literal map (J5), optionally defaulting to the id."""
    return df.withColumn(label_col, map_lookup(mapping, col, default_to_key))


def id_from_label(df: DataFrame, label_col: str, mapping: Mapping[str, str], id_col: str) -> DataFrame:
    """Reverse lookup label -> id."""
    return df.withColumn(id_col, reverse_lookup(mapping, label_col))
