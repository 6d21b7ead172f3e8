"""Catalog drill-down (A1, F3, F4, T5, J5-J8) and profiling (Q1-Q6), incl. G10."""
import datetime as dt

from retailcast import constants as K
from retailcast.operators import catalog as C
from retailcast.operators import profile as Q


def sales(spark):
    rows = [("F_1_a", "F_1", "F", "CA_1", "CA", 4), ("F_1_a", "F_1", "F", "CA_2", "CA", 2),
            ("F_1_b", "F_1", "F", "CA_1", "CA", 3), ("F_1_c", "F_1", "F", "TX_1", "TX", 3),
            ("H_1_a", "H_1", "H", "TX_1", "TX", 1), (None, "H_1", "H", "TX_1", "TX", 99)]
    return spark.createDataFrame(rows, "item_id string, dept_id string, cat_id string, "
                                       "store_id string, state_id string, sales int")


def test_demand_summary_drops_null_keys_A1_G10(spark):
    s = {r.item_id: r.avg_daily_demand for r in C.demand_summary(sales(spark)).collect()}
    assert s == {"F_1_a": 3.0, "F_1_b": 3.0, "F_1_c": 3.0, "H_1_a": 1.0}


def test_dept_products_ties_by_item_T5(spark):
    ranked = C.dept_products(C.demand_summary(sales(spark)), "F_1", with_label=True).orderBy("rank")
    assert [r.item_id for r in ranked.collect()] == ["F_1_a", "F_1_b", "F_1_c"]
    assert ranked.first().label == "F_1_a  —  3.00 units/day"


def test_prefix_and_stores_F4_J8(spark):
    depts = spark.createDataFrame([(c, d) for d in K.DEPT_LABELS for c in K.CATEGORY_LABELS],
                                  "cat_id string, dept_id string")
    got = C.departments_of_category(depts).filter("cat_id = 'HOBBIES'")
    assert sorted(r.dept_id for r in got.collect()) == ["HOBBIES_1", "HOBBIES_2"]
    st = C.stores_by_state_map(spark, K.STORES_BY_STATE)
    assert [r.store_id for r in st.filter("state_id = 'TX'").orderBy("store_id").collect()] == ["TX_1", "TX_2", "TX_3"]
    assert C.stores_of_state(sales(spark), "TX").count() == 1


def test_labels_J5_J6_J7(spark):
    df = spark.createDataFrame([("FOODS",), ("OTHER",)], "cat_id string")
    out = C.with_labels(df, "cat_id", K.CATEGORY_LABELS, "label")
    out = C.id_from_label(out, "label", K.CATEGORY_LABELS, "back")
    got = {r.cat_id: (r.label, r.back) for r in out.collect()}
    assert got == {"FOODS": ("Foods", "FOODS"), "OTHER": ("OTHER", None)}


def test_profiles_Q1_Q6(spark):
    df = sales(spark)
    p = Q.null_profile(df, "t").first()
    assert (p.n_rows, p.n_cols, p.n_nulls) == (6, 6, 1)
    assert Q.shape(df) == (6, 6)
    assert Q.column_nulls(df, "item_id").first().n_null_item_id == 1
    dv = [(r.column_name, r.value) for r in Q.distinct_values(df, ["state_id"]).collect()]
    assert dv == [("state_id", "CA"), ("state_id", "TX")]
    dated = spark.createDataFrame([("a", "s", dt.date(2020, 1, 2)), ("b", "s", dt.date(2020, 1, 1))],
                                  "item_id string, store_id string, date date")
    r = Q.value_range(dated).first()
    assert (r.min_date, r.max_date, r.n_items, r.n_stores) == (dt.date(2020, 1, 1), dt.date(2020, 1, 2), 2, 1)
    assert [x.item_id for x in Q.tail(dated, 1, ["date"]).collect()] == ["a"]
