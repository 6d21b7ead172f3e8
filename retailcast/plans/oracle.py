"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on the driver's tables registered as views (``lineitem``,
``part``, ...).  Shared CTEs mirror ``fixtures`` and ``seasonal``; values are
rounded the same way as on the Spark side (``round(x * 1e6) / 1e6``).
"""

from __future__ import annotations

import math

from ..constants import BAND_Z
from ..operators import additive_model as A
from .queries import CATEGORY_NAMES, ONE_DEPT, ONE_RUN, ONE_SERIES, RUN_BATCHES, RUNS_STORE, RUNS_TOP_N


def r(expr: str, places: int = 6) -> str:
    s = 10 ** places
    return f"(round(({expr}) * {s}.0) / {s}.0)"


BASE = """
bounds AS (
  SELECT min(cast(l_shipdate AS DATE)) AS lo, max(cast(l_shipdate AS DATE)) AS hi FROM lineitem),
calendar AS (
  SELECT g.date, 'd_' || cast(datediff('day', b.lo, g.date) + 1 AS VARCHAR) AS d,
         cast(floor(datediff('day', b.lo, g.date) / 7) AS INTEGER) AS wm_yr_wk
  FROM bounds b,
       (SELECT cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds) g),
li AS (
  SELECT p_brand AS item_id, r_name AS store_id, cast(l_shipdate AS DATE) AS ds,
         l_quantity AS q, l_extendedprice / l_quantity AS px, l_linestatus AS ls
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
series_keys AS (SELECT DISTINCT item_id, store_id FROM li),
obs AS (SELECT item_id, store_id, ds, sum(q) AS units FROM li GROUP BY item_id, store_id, ds),
sales_long AS (
  SELECT k.item_id || '_' || k.store_id AS id, k.item_id, k.item_id AS dept_id, 'Brand' AS cat_id,
         k.store_id, k.store_id AS state_id, c.d, cast(coalesce(o.units, 0) AS BIGINT) AS sales
  FROM series_keys k CROSS JOIN calendar c
  LEFT JOIN obs o ON o.item_id = k.item_id AND o.store_id = k.store_id AND o.ds = c.date),
sell_prices AS (
  SELECT li.store_id, li.item_id, c.wm_yr_wk, avg(li.px) AS sell_price
  FROM li JOIN calendar c ON li.ds = c.date WHERE li.ls = 'O'
  GROUP BY li.store_id, li.item_id, c.wm_yr_wk),
sales_priced AS (
  SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, s.d, s.sales,
         c.date, c.wm_yr_wk, p.sell_price
  FROM sales_long s LEFT JOIN calendar c ON s.d = c.d
  LEFT JOIN sell_prices p ON p.store_id = s.store_id AND p.item_id = s.item_id
                         AND p.wm_yr_wk = c.wm_yr_wk),
sales_clean AS (SELECT * FROM sales_priced WHERE sell_price IS NOT NULL),
model_input AS (
  SELECT item_id, store_id, date AS ds, cast(sales AS DOUBLE) AS y, sell_price FROM sales_clean)"""

CATALOG = """
cat_li AS (
  SELECT p_type || '_' || substr(p_brand, 7) || '_' || cast(p_partkey AS VARCHAR) AS item_id,
         p_type || '_' || substr(p_brand, 7) AS dept_id, p_type AS cat_id,
         r_name || '_' || cast(n_nationkey AS VARCHAR) AS store_id, r_name AS state_id,
         cast(l_shipdate AS DATE) AS ds, l_quantity AS q
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
catalog AS (
  SELECT item_id, dept_id, cat_id, store_id, state_id, ds AS date, cast(sum(q) AS BIGINT) AS sales
  FROM cat_li GROUP BY item_id, dept_id, cat_id, store_id, state_id, ds),
summary AS (
  SELECT item_id, cat_id, dept_id, avg(sales) AS avg_daily_demand FROM catalog
  GROUP BY item_id, cat_id, dept_id)"""


def frame_ctes(horizon: int = 90, holdout: int = 90, min_rows: int = 30, extra: int = 60) -> str:
    """The seasonal model frame as windows (same shape as the Spark plan)."""
    z = repr(BAND_Z)
    return f"""
mf_base AS (
  SELECT *, count(*) OVER w AS n_rows, min(ds) OVER w AS first_ds, max(ds) OVER w AS last_ds,
         row_number() OVER (PARTITION BY item_id, store_id ORDER BY ds DESC) AS rn_desc
  FROM model_input WINDOW w AS (PARTITION BY item_id, store_id)),
mf_ext AS (
  SELECT item_id, store_id, ds, FALSE AS is_future, y, sell_price, n_rows, first_ds, last_ds, rn_desc
  FROM mf_base WHERE n_rows >= {min_rows}
  UNION ALL
  SELECT item_id, store_id, cast(last_ds + h * INTERVAL 1 DAY AS DATE), TRUE, NULL, NULL,
         n_rows, first_ds, last_ds, rn_desc
  FROM mf_base, (SELECT unnest(generate_series(1, {horizon})) AS h) g
  WHERE rn_desc = 1 AND n_rows >= {min_rows}),
mf1 AS (
  SELECT *,
         (NOT is_future) AND rn_desc <= {holdout} AS is_test,
         n_rows >= {holdout + extra} AS evaluable,
         (NOT is_future) AND rn_desc > {holdout} AND n_rows >= {holdout + extra} AS is_train,
         CASE WHEN (NOT is_future) AND rn_desc > {holdout} AND n_rows >= {holdout + extra}
              THEN y END AS y_tr,
         cast(datediff('day', first_ds, ds) AS DOUBLE) AS t,
         dayofweek(ds) AS dow, month(ds) AS month
  FROM mf_ext),
mf2 AS (
  SELECT *, regr_intercept(y, t) OVER w AS a, regr_slope(y, t) OVER w AS b,
         regr_intercept(y_tr, t) OVER w AS a_tr, regr_slope(y_tr, t) OVER w AS b_tr,
         avg(sell_price) OVER w AS avg_price,
         max(CASE WHEN is_train THEN ds END) OVER w AS last_train_ds
  FROM mf1 WINDOW w AS (PARTITION BY item_id, store_id)),
mf3 AS (
  SELECT *, a + b * t AS trend, a_tr + b_tr * t AS trend_tr,
         y - (a + b * t) AS e, y_tr - (a_tr + b_tr * t) AS e_tr
  FROM mf2),
mf4 AS (
  SELECT *, coalesce(avg(e) OVER wd, 0.0) AS weekly, coalesce(avg(e_tr) OVER wd, 0.0) AS weekly_tr
  FROM mf3 WINDOW wd AS (PARTITION BY item_id, store_id, dow)),
mf5 AS (
  SELECT *, coalesce(avg(e - weekly) OVER wm, 0.0) AS yearly,
         coalesce(avg(e_tr - weekly_tr) OVER wm, 0.0) AS yearly_tr
  FROM mf4 WINDOW wm AS (PARTITION BY item_id, store_id, month)),
mf6 AS (
  SELECT *, stddev_samp(e - weekly - yearly) OVER w AS sd,
         stddev_samp(e_tr - weekly_tr - yearly_tr) OVER w AS sd_tr
  FROM mf5 WINDOW w AS (PARTITION BY item_id, store_id)),
frame AS (
  SELECT item_id, store_id, ds, is_future, y, n_rows, last_ds, rn_desc, avg_price, is_test,
         evaluable, last_train_ds, trend, weekly, yearly,
         trend + weekly + yearly AS yhat,
         (trend + weekly + yearly) - {z} * sd AS yhat_lower,
         (trend + weekly + yearly) + {z} * sd AS yhat_upper,
         trend_tr + weekly_tr + yearly_tr AS yhat_tr,
         (trend_tr + weekly_tr + yearly_tr) - {z} * sd_tr AS yhat_tr_lower,
         (trend_tr + weekly_tr + yearly_tr) + {z} * sd_tr AS yhat_tr_upper
  FROM mf6)"""


def clip(x: str) -> str:
    return f"(CASE WHEN ({x}) < 0 THEN 0.0 ELSE ({x}) END)"


def params_cte(batches) -> str:
    rows = ", ".join(f"({i + 1}, {p.forecast_days}, {p.lead_time_days}, "
                     f"CAST({float(p.ordering_cost)!r} AS DOUBLE), "
                     f"CAST({float(p.holding_cost)!r} AS DOUBLE), CAST({float(p.z)!r} AS DOUBLE))"
                     for i, p in enumerate(batches))
    return f"""
params(param_set, forecast_days, lead_time_days, ordering_cost, holding_cost, z) AS (
  VALUES {rows})"""


FUTURE = f"""
future AS (
  SELECT f.item_id, f.store_id, f.ds, f.avg_price, p.*, datediff('day', f.last_ds, f.ds) AS h,
         {clip('f.yhat')} AS yhat, {clip('f.yhat_lower')} AS yhat_lower,
         {clip('f.yhat_upper')} AS yhat_upper
  FROM frame f, params p
  WHERE f.is_future AND datediff('day', f.last_ds, f.ds) <= p.forecast_days),
pol_agg AS (
  SELECT item_id, store_id, param_set, forecast_days, lead_time_days, ordering_cost, holding_cost, z,
         avg(yhat) AS avg_daily_demand, stddev_samp(yhat) AS std_daily_demand,
         first(avg_price) AS avg_price
  FROM future
  GROUP BY item_id, store_id, param_set, forecast_days, lead_time_days, ordering_cost,
           holding_cost, z),
policy AS (
  SELECT item_id, store_id, param_set, forecast_days, lead_time_days, ordering_cost, holding_cost,
         avg_daily_demand, std_daily_demand,
         z * std_daily_demand * sqrt(cast(lead_time_days AS DOUBLE)) AS safety_stock,
         avg_daily_demand * cast(lead_time_days AS DOUBLE)
           + z * std_daily_demand * sqrt(cast(lead_time_days AS DOUBLE)) AS rop,
         sqrt(CASE WHEN holding_cost * avg_price = 0 THEN NULL
                   ELSE (2.0 * (avg_daily_demand * 365.0) * ordering_cost) / (holding_cost * avg_price)
              END) AS eoq,
         avg_price
  FROM pol_agg)"""

METRICS = """
bt AS (
  SELECT *, is_test AND evaluable AND ds <= cast(last_train_ds + INTERVAL 90 DAY AS DATE) AS cmp,
         CASE WHEN yhat_tr < 0 THEN 0.0 ELSE yhat_tr END AS yhc
  FROM frame WHERE NOT is_future),
bt_agg AS (
  SELECT item_id, store_id,
         cast(count_if(cmp) AS BIGINT) AS n_compared, count_if(cmp AND y > 0) AS n_nonzero,
         avg(CASE WHEN cmp AND y > 0 THEN abs(y - yhc) / y END) AS mape_raw,
         avg(CASE WHEN cmp THEN (y - yhc) * (y - yhc) END) AS mse
  FROM bt GROUP BY item_id, store_id),
metrics AS (
  SELECT item_id, store_id,
         CASE WHEN n_nonzero > 0 THEN mape_raw * 100.0 END AS mape,
         CASE WHEN n_nonzero > 0 THEN sqrt(mse) END AS rmse,
         n_compared, 90 AS holdout_days
  FROM bt_agg)"""

INSIGHTS = """
insights AS (
  SELECT item_id, store_id, param_set,
         coalesce(sum(yhat), 0.0) AS total_forecast,
         max(yhat) AS peak_yhat, min(yhat) AS low_yhat, avg(yhat_upper) AS avg_upper
  FROM future GROUP BY item_id, store_id, param_set),
peak AS (
  SELECT item_id, store_id, param_set, ds AS peak_ds FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id, store_id, param_set
                                 ORDER BY yhat DESC, ds ASC) AS rk FROM future) WHERE rk = 1),
low AS (
  SELECT item_id, store_id, param_set, ds AS low_ds FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id, store_id, param_set
                                 ORDER BY yhat ASC, ds ASC) AS rk FROM future) WHERE rk = 1)"""


def w(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n"


DEFAULT = [RUN_BATCHES[0]]
FR90 = frame_ctes(90)
FR_RUNS = frame_ctes(max(p.forecast_days for p in RUN_BATCHES))

SUMMARY = f"""
summary_s AS (
  SELECT p.item_id, p.store_id, p.forecast_days, p.avg_daily_demand, p.std_daily_demand,
         i.total_forecast, p.safety_stock, p.rop, p.eoq, m.mape, m.rmse
  FROM policy p JOIN (
    SELECT item_id, store_id, coalesce(sum(yhat), 0.0) AS total_forecast
    FROM future GROUP BY item_id, store_id) i USING (item_id, store_id)
  LEFT JOIN metrics m USING (item_id, store_id)),
pairs AS (
  SELECT store_id, max(CASE WHEN rk = 1 THEN item_id END) AS item_a,
         max(CASE WHEN rk = 2 THEN item_id END) AS item_b
  FROM (SELECT *, row_number() OVER (PARTITION BY store_id
                                     ORDER BY avg_daily_demand DESC NULLS LAST, item_id) AS rk
        FROM summary_s)
  WHERE rk <= 2 GROUP BY store_id HAVING max(CASE WHEN rk = 2 THEN item_id END) IS NOT NULL)"""

R2 = {"avg_daily_demand": 2, "std_daily_demand": 2, "safety_stock": 1, "rop": 1, "eoq": 1,
      "mape": 1, "rmse": 2}

RUNS = f"""
runs_base AS (
  SELECT p.*, m.mape, m.rmse,
         cast(row_number() OVER (ORDER BY p.param_set, p.item_id, p.store_id) AS INTEGER) AS run_id
  FROM policy p LEFT JOIN metrics m USING (item_id, store_id)),
runs AS (
  SELECT run_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(run_id) AS run_at, item_id,
         store_id, forecast_days, lead_time_days, ordering_cost, holding_cost, avg_daily_demand,
         std_daily_demand, safety_stock, rop, eoq, mape, rmse, param_set
  FROM runs_base),
latest AS (
  SELECT run_id, run_at, item_id, store_id, forecast_days, lead_time_days, ordering_cost,
         holding_cost, {", ".join(f"{r(c, n)} AS {c}" for c, n in R2.items())}
  FROM runs ORDER BY run_at DESC, run_id DESC LIMIT 200)"""


def _sql() -> dict[str, str]:
    base = BASE
    q: dict[str, str] = {}
    q["melt_sales"] = w(base) + """
SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, cast(sales AS INTEGER) AS sales
FROM sales_long"""
    q["sales_clean"] = w(base) + f"""
SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, cast(sales AS INTEGER) AS sales,
       date, wm_yr_wk, {r('sell_price')} AS sell_price
FROM sales_clean"""
    q["profile_nulls"] = w(base) + """
SELECT 'calendar' AS table_name, count(*) AS n_rows, cast(3 AS BIGINT) AS n_cols,
       cast(count_if(date IS NULL) + count_if(d IS NULL) + count_if(wm_yr_wk IS NULL) AS BIGINT) AS n_nulls
FROM calendar
UNION ALL
SELECT 'sell_prices', count(*), 4,
       cast(count_if(store_id IS NULL) + count_if(item_id IS NULL) + count_if(wm_yr_wk IS NULL)
       + count_if(sell_price IS NULL) AS BIGINT)
FROM sell_prices
UNION ALL
SELECT 'sales_long', count(*), 8,
       cast(count_if(id IS NULL) + count_if(item_id IS NULL) + count_if(dept_id IS NULL)
       + count_if(cat_id IS NULL) + count_if(store_id IS NULL) + count_if(state_id IS NULL)
       + count_if(d IS NULL) + count_if(sales IS NULL) AS BIGINT)
FROM sales_long
UNION ALL
SELECT 'sales_priced', count(*), 11,
       cast(count_if(id IS NULL) + count_if(item_id IS NULL) + count_if(dept_id IS NULL)
       + count_if(cat_id IS NULL) + count_if(store_id IS NULL) + count_if(state_id IS NULL)
       + count_if(d IS NULL) + count_if(sales IS NULL) + count_if(date IS NULL)
       + count_if(wm_yr_wk IS NULL) + count_if(sell_price IS NULL) AS BIGINT)
FROM sales_priced"""
    q["price_nulls"] = w(base) + """
SELECT count(*) AS n_rows, cast(count_if(sell_price IS NULL) AS BIGINT) AS n_null_sell_price
FROM sales_priced"""
    q["profile_range"] = w(base) + """
SELECT min(date) AS min_date, max(date) AS max_date, count(DISTINCT item_id) AS n_items,
       count(DISTINCT store_id) AS n_stores
FROM sales_clean"""
    q["distinct_sorted"] = w(CATALOG) + """
SELECT DISTINCT column_name, value FROM (
  SELECT 'store_id' AS column_name, store_id AS value FROM catalog
  UNION ALL SELECT 'state_id', state_id FROM catalog
  UNION ALL SELECT 'cat_id', cat_id FROM catalog
  UNION ALL SELECT 'dept_id', dept_id FROM catalog)
ORDER BY column_name, value"""
    q["daily_total"] = w(base) + """
SELECT date, cast(sum(sales) AS BIGINT) AS total_sales FROM sales_clean GROUP BY date ORDER BY date"""
    q["daily_labels"] = w(base) + """
SELECT date, strftime(date, '%b %d, %Y') AS label, cast(sum(sales) AS BIGINT) AS total_sales
FROM sales_clean GROUP BY date ORDER BY date"""
    q["demand_summary"] = w(CATALOG) + f"""
SELECT item_id, cat_id, dept_id, {r('avg_daily_demand')} AS avg_daily_demand FROM summary"""
    q["dept_products_ranked"] = w(CATALOG) + f"""
SELECT dept_id,
       cast(row_number() OVER (PARTITION BY dept_id ORDER BY avg_daily_demand DESC NULLS LAST,
                               item_id) AS INTEGER) AS rank,
       item_id, {r('avg_daily_demand')} AS avg_daily_demand
FROM summary"""
    q["dept_by_category_prefix"] = w(CATALOG) + """
SELECT DISTINCT cat_id, dept_id FROM catalog WHERE starts_with(dept_id, cat_id)
ORDER BY cat_id, dept_id"""
    q["stores_by_state"] = w(CATALOG) + """
SELECT DISTINCT state_id, store_id FROM catalog ORDER BY state_id, store_id"""
    labels = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORY_NAMES.items())
    back = " ".join(f"WHEN '{v}' THEN '{k}'" for k, v in CATEGORY_NAMES.items())
    q["label_lookup_default"] = w(CATALOG) + f"""
SELECT cat_id, cat_label, CASE cat_label {back} END AS cat_id_from_label FROM (
  SELECT cat_id, coalesce(CASE cat_id {labels} END, cat_id) AS cat_label
  FROM (SELECT DISTINCT cat_id FROM catalog))"""
    q["series_filter"] = w(base) + f"""
SELECT item_id, store_id, ds, y, {r('sell_price')} AS sell_price FROM model_input
WHERE item_id = '{ONE_SERIES[0]}' AND store_id = '{ONE_SERIES[1]}'"""
    q["series_min_history"] = w(base) + """
SELECT item_id, store_id, count(*) AS n_rows, count(*) >= 30 AS has_history
FROM model_input GROUP BY item_id, store_id"""
    q["history_tail"] = w(base) + """
SELECT item_id, store_id, ds, y FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, store_id ORDER BY ds DESC) AS rk
  FROM model_input) WHERE rk <= 180"""
    q["holdout_split_counts"] = w(base) + """
SELECT item_id, store_id, count(*) AS n_rows, cast(count_if(rk > 90) AS BIGINT) AS n_train,
       cast(count_if(rk <= 90) AS BIGINT) AS n_test, count(*) >= 150 AS evaluable
FROM (SELECT *, row_number() OVER (PARTITION BY item_id, store_id ORDER BY ds DESC) AS rk
      FROM model_input)
GROUP BY item_id, store_id"""
    q["future_spine"] = w(base) + """
SELECT item_id, store_id, ds, FALSE AS is_future FROM model_input
UNION ALL
SELECT item_id, store_id, cast(last_ds + h * INTERVAL 1 DAY AS DATE), TRUE
FROM (SELECT item_id, store_id, max(ds) AS last_ds FROM model_input GROUP BY item_id, store_id),
     (SELECT unnest(generate_series(1, 90)) AS h)"""
    fr = w(base, FR90)
    q["forecast_seasonal"] = fr + f"""
SELECT item_id, store_id, ds, is_future, {r('yhat')} AS yhat, {r('yhat_lower')} AS yhat_lower,
       {r('yhat_upper')} AS yhat_upper
FROM frame"""
    q["forecast_components"] = fr + f"""
SELECT item_id, store_id, ds, {r('trend')} AS trend, {r('weekly')} AS weekly,
       {r('yearly')} AS yearly
FROM frame"""
    frm = w(base, FR90, METRICS)
    q["backtest_metrics"] = frm + f"""
SELECT item_id, store_id, {r('mape')} AS mape, {r('rmse')} AS rmse, n_compared, holdout_days
FROM metrics"""
    q["backtest_comparison"] = frm + f"""
SELECT item_id, store_id, ds, y, {r('yhc')} AS yhat, {r('yhat_tr_lower')} AS yhat_lower,
       {r('yhat_tr_upper')} AS yhat_upper
FROM (SELECT *, count_if(cmp AND y > 0) OVER (PARTITION BY item_id, store_id) AS nz FROM bt)
WHERE cmp AND nz > 0"""
    frp = w(base, FR90, params_cte(DEFAULT), FUTURE, METRICS)
    q["accuracy_band"] = frp + """
SELECT p.item_id, p.store_id,
       CASE WHEN m.mape IS NULL THEN 'N/A' WHEN m.mape < 20 THEN 'good'
            WHEN m.mape < 40 THEN 'fair' ELSE 'poor' END AS accuracy,
       p.avg_daily_demand < 1.5 AS intermittent
FROM policy p LEFT JOIN metrics m USING (item_id, store_id)"""
    pv = ["avg_daily_demand", "std_daily_demand", "safety_stock", "rop", "eoq", "avg_price"]
    q["inventory_policy"] = frp + f"""
SELECT item_id, store_id, forecast_days, lead_time_days, ordering_cost, holding_cost,
       {", ".join(f"{r(c)} AS {c}" for c in pv)}
FROM policy"""
    fr6 = FR90.replace("         trend + weekly + yearly AS yhat,",
                       "         " + r("trend + weekly + yearly") + " AS yhat,")
    assert fr6 != FR90
    q["forecast_insights"] = w(base, fr6, params_cte(DEFAULT), FUTURE, INSIGHTS) + f"""
SELECT i.item_id, i.store_id, {r('total_forecast')} AS total_forecast, p.peak_ds,
       {r('peak_yhat')} AS peak_yhat, l.low_ds, {r('low_yhat')} AS low_yhat,
       {r('avg_upper')} AS avg_upper
FROM insights i JOIN peak p USING (item_id, store_id, param_set)
JOIN low l USING (item_id, store_id, param_set)"""
    replay = f"""
rp_pol AS (SELECT item_id, store_id, {r('rop')} AS rop, {r('eoq')} AS eoq FROM policy),
rp_days AS (
  SELECT f.item_id, f.store_id, f.ds, {r('f.yhat')} AS demand, p.rop, p.eoq,
         cast(row_number() OVER (PARTITION BY f.item_id, f.store_id ORDER BY f.ds) - 1 AS INTEGER) AS day
  FROM future f JOIN rp_pol p USING (item_id, store_id)),
rp(item_id, store_id, day, ds, demand, level, ordered) AS (
  SELECT item_id, store_id, day, ds, demand,
         CASE WHEN eoq + (CASE WHEN eoq <= rop THEN eoq ELSE 0.0 END) - demand < 0 THEN 0.0
              ELSE eoq + (CASE WHEN eoq <= rop THEN eoq ELSE 0.0 END) - demand END,
         coalesce(eoq <= rop, FALSE)
  FROM rp_days WHERE day = 0
  UNION ALL
  SELECT d.item_id, d.store_id, d.day, d.ds, d.demand,
         CASE WHEN r.level + (CASE WHEN r.level <= d.rop THEN d.eoq ELSE 0.0 END) - d.demand < 0
              THEN 0.0
              ELSE r.level + (CASE WHEN r.level <= d.rop THEN d.eoq ELSE 0.0 END) - d.demand END,
         coalesce(r.level <= d.rop, FALSE)
  FROM rp r JOIN rp_days d ON d.item_id = r.item_id AND d.store_id = r.store_id
                          AND d.day = r.day + 1)"""
    frr = w(base, FR90, params_cte(DEFAULT), FUTURE, replay)
    q["inventory_replay"] = frr + f"""
SELECT item_id, store_id, day, ds, {r('demand')} AS demand, {r('level')} AS level, ordered
FROM rp"""
    q["replay_orders"] = frr + f"""
SELECT item_id, store_id, cast(count_if(ordered) AS BIGINT) AS n_orders, count(*) AS n_days,
       {r('min(level)')} AS min_level
FROM rp GROUP BY item_id, store_id"""
    history = f"""
rh_days AS (
  SELECT item_id, store_id, list(ds ORDER BY ds) AS days, list(CASE WHEN y > 0 THEN y ELSE 0.0 END ORDER BY ds) AS demand
  FROM frame WHERE NOT is_future GROUP BY item_id, store_id),
rh_series AS (
  SELECT d.*, {r('p.rop')} AS rop, {r('p.eoq')} AS eoq FROM rh_days d JOIN policy p USING (item_id, store_id)),
rh(item_id, store_id, day, level, ordered) AS (
  SELECT item_id, store_id, 0, greatest(0.0, eoq + (CASE WHEN eoq <= rop THEN eoq ELSE 0.0 END) - demand[1]), coalesce(eoq <= rop, FALSE)
  FROM rh_series
  UNION ALL
  SELECT h.item_id, h.store_id, h.day + 1,
         greatest(0.0, h.level + (CASE WHEN h.level <= s.rop THEN s.eoq ELSE 0.0 END) - s.demand[h.day + 2]), coalesce(h.level <= s.rop, FALSE)
  FROM rh h JOIN rh_series s ON h.item_id = s.item_id AND h.store_id = s.store_id WHERE h.day + 1 < len(s.days))"""
    q["inventory_replay_history"] = w(base, FR90, params_cte(DEFAULT), FUTURE, history) + f"""
SELECT h.item_id, h.store_id, h.day, s.days[h.day + 1] AS ds, s.demand[h.day + 1] AS demand, {r('h.level')} AS level, h.ordered
FROM rh h JOIN rh_series s ON h.item_id = s.item_id AND h.store_id = s.store_id"""
    frs = w(base, FR90, params_cte(DEFAULT), FUTURE, METRICS, SUMMARY)
    cols = ["avg_daily_demand", "std_daily_demand", "total_forecast", "safety_stock", "rop",
            "eoq", "mape", "rmse"]
    labels_m = ["'Avg Daily Demand'", "'Demand Std Dev'",
                "'Total Forecast (' || cast(a.forecast_days AS VARCHAR) || ' days)'",
                "'Safety Stock'", "'Reorder Point (ROP)'", "'Economic Order Qty (EOQ)'",
                "'MAPE (Backtest)'", "'RMSE (Backtest)'"]
    parts = [f"""SELECT pr.store_id, pr.item_a, pr.item_b, {i + 1} AS metric_no, {lab} AS metric,
       {r('a.' + c)} AS A, {r('b.' + c)} AS B
FROM pairs pr JOIN summary_s a ON a.store_id = pr.store_id AND a.item_id = pr.item_a
JOIN summary_s b ON b.store_id = pr.store_id AND b.item_id = pr.item_b"""
             for i, (c, lab) in enumerate(zip(cols, labels_m))]
    q["compare_products"] = frs + "\nUNION ALL\n".join(parts)
    q["compare_takeaway"] = frs + f"""
SELECT store_id, item_a, item_b, {r('ratio')} AS demand_ratio,
       CASE WHEN ratio >= 1 THEN item_a ELSE item_b END AS higher_item,
       CASE WHEN ratio >= 1 THEN item_b ELSE item_a END AS lower_item,
       {r('greatest(ratio, 1.0 / greatest(ratio, 0.01))')} AS ratio_val,
       CASE WHEN ss_a >= ss_b THEN item_a ELSE item_b END AS higher_ss_item
FROM (SELECT pr.store_id, pr.item_a, pr.item_b,
             a.avg_daily_demand / greatest(b.avg_daily_demand, 0.01) AS ratio,
             a.safety_stock AS ss_a, b.safety_stock AS ss_b
      FROM pairs pr JOIN summary_s a ON a.store_id = pr.store_id AND a.item_id = pr.item_a
      JOIN summary_s b ON b.store_id = pr.store_id AND b.item_id = pr.item_b)"""
    fru = w(base, FR_RUNS, params_cte(RUN_BATCHES), FUTURE, METRICS, RUNS)
    q["runs_next_id"] = fru + """
SELECT coalesce(max(run_id), 0) + 1 AS next_run_id FROM runs"""
    q["runs_latest"] = fru + """
SELECT * FROM latest"""
    q["runs_top_by_demand"] = fru + f"""
SELECT run_id, run_at, item_id, store_id, {r('avg_daily_demand', 2)} AS avg_daily_demand,
       {r('safety_stock', 1)} AS safety_stock, {r('rop', 1)} AS rop, {r('eoq', 1)} AS eoq,
       {r('mape', 1)} AS mape, {r('rmse', 2)} AS rmse
FROM runs WHERE store_id = '{RUNS_STORE}'
ORDER BY avg_daily_demand DESC NULLS LAST, run_id LIMIT {RUNS_TOP_N}"""
    q["runs_kpis"] = fru + f"""
SELECT count(*) AS n_runs, count(DISTINCT item_id) AS n_items, count(DISTINCT store_id) AS n_stores,
       {r('avg(mape)')} AS avg_mape
FROM latest"""
    q["runs_sorted_nulls_last"] = fru + """
SELECT * FROM latest ORDER BY mape ASC NULLS LAST, run_id"""
    q["run_detail"] = fru + f"""
SELECT r.run_id, r.item_id, r.store_id, f.ds, {r('f.yhat')} AS yhat,
       {r('f.yhat_lower')} AS yhat_lower, {r('f.yhat_upper')} AS yhat_upper,
       {r('r.rop')} AS rop, {r('r.safety_stock')} AS safety_stock
FROM runs r JOIN future f ON f.item_id = r.item_id AND f.store_id = r.store_id
                         AND f.param_set = r.param_set"""
    q["run_forecast"] = fru + f"""
SELECT f.ds, {r('f.yhat')} AS yhat, {r('f.yhat_lower')} AS yhat_lower,
       {r('f.yhat_upper')} AS yhat_upper
FROM runs r JOIN future f ON f.item_id = r.item_id AND f.store_id = r.store_id
                         AND f.param_set = r.param_set
WHERE r.run_id = {ONE_RUN} ORDER BY f.ds"""
    q["stored_series"] = w(base) + f"""
SELECT item_id, store_id, date, cast(sales AS INTEGER) AS sales, {r('sell_price')} AS sell_price FROM sales_clean
WHERE item_id = '{ONE_SERIES[0]}' AND store_id = '{ONE_SERIES[1]}'"""
    saved = """
saved AS (SELECT * REPLACE (TIMESTAMP '2024-01-01 00:00:00' + to_days(param_set - 1) AS run_at) FROM runs)"""
    frv = w(base, FR_RUNS, params_cte(RUN_BATCHES), FUTURE, METRICS, RUNS, saved)
    q["saved_runs_roundtrip"] = frv + f"""
SELECT s.run_id, s.run_at, s.item_id, s.store_id, s.forecast_days, {r('s.rop')} AS rop, count(*) AS n_days,
       min(f.ds) AS first_ds, max(f.ds) AS last_ds, {r('sum(f.yhat)', 4)} AS total_forecast
FROM saved s JOIN future f ON f.item_id = s.item_id AND f.store_id = s.store_id AND f.param_set = s.param_set
GROUP BY s.run_id, s.run_at, s.item_id, s.store_id, s.forecast_days, s.rop"""
    q["saved_runs_view"] = frv + f"""
SELECT cast(row_number() OVER (ORDER BY mape ASC NULLS LAST, run_id) AS INTEGER) AS position,
       run_id AS "Run #", run_at AS "Timestamp", item_id AS "Product", store_id AS "Store", forecast_days AS "Horizon (days)",
       lead_time_days AS "Lead Time", avg_daily_demand AS "Avg Demand/day", safety_stock AS "Safety Stock", rop AS "ROP",
       eoq AS "EOQ", mape AS "MAPE (%)", rmse AS "RMSE"
FROM (SELECT run_id, run_at, item_id, store_id, forecast_days, lead_time_days, {", ".join(f"{r(c, n)} AS {c}" for c, n in R2.items())}
      FROM saved ORDER BY run_at DESC, run_id DESC LIMIT 200)
WHERE store_id = '{RUNS_STORE}'"""
    q["dept_products_labels"] = w(CATALOG) + f"""
SELECT cast(row_number() OVER (ORDER BY avg_daily_demand DESC NULLS LAST, item_id) AS INTEGER) AS rank, item_id,
       item_id || '  —  ' || printf('%.2f', round(avg_daily_demand * 100) / 100) || ' units/day' AS label
FROM summary WHERE dept_id = '{ONE_DEPT}'"""
    q["csv_curated"] = w(base) + f"""
SELECT item_id, store_id, state_id, cat_id, dept_id, date, cast(sales AS INTEGER) AS sales, {r('sell_price')} AS sell_price FROM sales_clean"""
    q["stored_forecast"] = fr + f"""
SELECT item_id, store_id, ds, is_future, {", ".join(f"{r(c)} AS {c}" for c in ("yhat", "yhat_lower", "yhat_upper", "trend"))} FROM frame"""
    q["table_shapes"] = w(base) + """
SELECT 'calendar' AS table_name, count(*) AS n_rows, cast(3 AS BIGINT) AS n_cols FROM calendar
UNION ALL SELECT 'sell_prices', count(*), 4 FROM sell_prices
UNION ALL SELECT 'sales_long', count(*), 8 FROM sales_long
UNION ALL SELECT 'sales_clean', count(*), 11 FROM sales_clean"""
    q["table_preview"] = w(base) + f"""
SELECT item_id, store_id, date, sales, {r('sell_price')} AS sell_price, side FROM (
  (SELECT *, 'head' AS side FROM sales_clean ORDER BY item_id, store_id, date LIMIT 5)
  UNION ALL
  (SELECT *, 'tail' AS side FROM sales_clean ORDER BY item_id DESC, store_id DESC, date DESC LIMIT 5))"""
    q["demand_summary_kept_up"] = q["demand_summary"]
    q["daily_total_kept_up"] = w(CATALOG) + """
SELECT date, cast(sum(sales) AS BIGINT) AS total_sales FROM catalog GROUP BY date"""
    q["kpis_kept_up"] = w(CATALOG) + """
SELECT count(*) AS n_rows, count(DISTINCT item_id) AS n_items, count(DISTINCT store_id) AS n_stores, min(date) AS first_date, max(date) AS last_date
FROM catalog"""
    q["predict_components"] = w(base, _projected()) + f"""
SELECT item_id, store_id, ds, {r('trend + weekly + yearly')} AS yhat, {r(f'trend + weekly + yearly - {BAND_Z!r} * sd')} AS yhat_lower,
       {r(f'trend + weekly + yearly + {BAND_Z!r} * sd')} AS yhat_upper, {r('trend')} AS trend, {r('weekly')} AS weekly, {r('yearly')} AS yearly
FROM predicted"""
    return q


def _projected() -> str:
    """Coefficients by projection, and trend, seasonal and band terms at each day of the spine."""
    cps = [A.CHANGEPOINT_RANGE * j / A.N_CHANGEPOINTS for j in range(1, A.N_CHANGEPOINTS + 1)]

    def waves(period: float, order: int) -> list[str]:
        return [f"{f}({2.0 * math.pi * i / period!r}::DOUBLE * day)" for i in range(1, order + 1) for f in ("sin", "cos")]

    year, week = waves(A.YEAR_PERIOD, A.YEAR_ORDER), waves(A.WEEK_PERIOD, A.WEEK_ORDER)
    jumps = [f"coalesce(0.1 * (avg(v) FILTER (WHERE t > {s!r}) - avg(v) FILTER (WHERE t <= {s!r})), 0.0)" for s in cps]
    coefficients = {f"j{i}": x for i, x in enumerate(jumps)} | {f"a{i}": f"2.0 * avg(v * {x})" for i, x in enumerate(year)} | {f"b{i}": f"2.0 * avg(v * {x})" for i, x in enumerate(week)}
    return f"""
px AS (
  SELECT *, CASE WHEN most > 0 THEN most ELSE 1.0 END AS y_scale FROM (
    SELECT item_id, store_id, ds, y, cast(datediff('day', DATE '1970-01-01', ds) AS DOUBLE) AS day,
           min(cast(datediff('day', DATE '1970-01-01', ds) AS DOUBLE)) OVER s AS d0, greatest(cast(datediff('day', min(ds) OVER s, max(ds) OVER s) AS DOUBLE), 1.0) AS span, max(abs(y)) OVER s AS most
    FROM model_input WINDOW s AS (PARTITION BY item_id, store_id))),
pm AS (
  SELECT item_id, store_id, any_value(d0) AS d0, any_value(span) AS span, any_value(y_scale) AS y_scale, coalesce(regr_slope(v, t), 0.0) AS k, coalesce(regr_intercept(v, t), avg(v)) AS m,
         coalesce(stddev_samp(v), 0.0) AS sigma, max(ds) AS last_ds, {", ".join(f"{x} AS {c}" for c, x in coefficients.items())}
  FROM (SELECT *, (day - d0) / span AS t, y / y_scale AS v FROM px) GROUP BY item_id, store_id),
spine AS (
  SELECT item_id, store_id, ds FROM model_input
  UNION ALL
  SELECT item_id, store_id, cast(last_ds + h * INTERVAL 1 DAY AS DATE) FROM pm, (SELECT unnest(generate_series(1, 90)) AS h)),
at_day AS (
  SELECT s.ds, m.*, cast(datediff('day', DATE '1970-01-01', s.ds) AS DOUBLE) AS day, (cast(datediff('day', DATE '1970-01-01', s.ds) AS DOUBLE) - d0) / span AS t,
         ({" + ".join(f"abs(j{i})" for i in range(len(cps)))}) / {len(cps)}.0 AS lam
  FROM spine s JOIN pm m USING (item_id, store_id)),
predicted AS (
  SELECT item_id, store_id, ds,
         (k * t + m + {" + ".join(f"j{i} * greatest(t - {s!r}, 0.0)" for i, s in enumerate(cps))}) * y_scale AS trend,
         ({" + ".join(f"a{i} * {x}" for i, x in enumerate(year))}) * y_scale AS yearly,
         ({" + ".join(f"b{i} * {x}" for i, x in enumerate(week))}) * y_scale AS weekly,
         sqrt(sigma * sigma + CASE WHEN t > 1 THEN 2.0 / 3.0 * {len(cps)} * lam * lam * pow(t - 1, 3) ELSE 0.0 END) * y_scale AS sd
  FROM at_day)"""


SQL = _sql()
