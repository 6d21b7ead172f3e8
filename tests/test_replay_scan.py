"""The replay as a state scan (O5): any length, any batches, missing values."""
import datetime as dt
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import series_df, synthetic
from retailcast.operators import policy as P
from retailcast.operators import replay as RP
from retailcast.operators.seasonal import seasonal_frame


def loop(demand, eoq, rop):
    level, out = eoq, []
    for d in demand:
        ordered = level <= rop
        level = max(0.0, level + (eoq if ordered else 0.0) - d)
        out.append((level, ordered))
    return out


def batches(rows, sizes):
    names = ["item_id", "store_id", "param_set", "ds", "demand", "rop", "eoq"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.date32(), pa.float64(), pa.float64(), pa.float64()]
    at = 0
    for n in sizes:
        cols = list(zip(*rows[at:at + n])) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names=names)
        at += n


def rows_of(keys, n):
    day = dt.date(2015, 1, 1)
    return [(i, s, p, day + dt.timedelta(days=t), float((t * 7 + len(i or "")) % 5), 6.0, 11.0) for i, s, p in keys for t in range(n)]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_state_goes_on_over_batches(size):
    rows = rows_of([("A", "S", 1), ("A", "S", 2), ("B", "S", 2), (None, "S", 2)], 40)
    got = [r for b in RP.scan_levels(batches(rows, [size] * (len(rows) // size + 1))) for r in b.to_pylist()]
    for k in range(4):
        part = got[40 * k:40 * k + 40]
        assert [r["day"] for r in part] == list(range(40))
        assert [(r["level"], r["ordered"]) for r in part] == loop([r["demand"] for r in part], 11.0, 6.0)


def test_missing_policy_and_demand():
    rows = [("A", "S", 1, dt.date(2015, 1, 1 + t), d, rop, eoq) for t, (d, rop, eoq) in enumerate([(1.0, None, 5.0), (9.0, None, 5.0), (None, None, 5.0), (1.0, None, 5.0)])]
    got = [(r["level"], r["ordered"]) for b in RP.scan_levels(batches(rows, [4])) for r in b.to_pylist()]
    assert got == [(4.0, False), (0.0, False), (None, False), (None, False)]
    got = [(r["level"], r["ordered"]) for b in RP.scan_levels(batches([("A", "S", 1, dt.date(2015, 1, 1), 1.0, 3.0, None)], [1])) for r in b.to_pylist()]
    assert got == [(None, False)]


def test_time_is_linear_in_the_days():
    def took(n):
        rows = [("A", "S", 1, dt.date(1900, 1, 1), 1.0, 6.0, 11.0)] * n
        ready = list(batches(rows, [10_000] * (n // 10_000)))
        t = time.perf_counter()
        for _ in RP.scan_levels(iter(ready)):
            pass
        return time.perf_counter() - t

    took(20_000)
    assert took(400_000) < 20 * max(took(40_000), 0.01)


def test_history_replay(spark):
    """Every past day of a long series, and of one with missing days, against a loop."""
    long = [abs(v) + (t % 9) for t, v in enumerate(synthetic(2300))]
    frame = seasonal_frame(series_df(spark, long).union(series_df(spark, synthetic(200), item="J")), horizon=90)
    levels = RP.replay_history(frame, P.PolicyParams()).orderBy("item_id", "ds")
    pol = {r.item_id: r for r in P.inventory_policy(frame).collect()}
    got = {}
    for r in levels.collect():
        got.setdefault(r.item_id, []).append(r)
    assert {k: len(v) for k, v in got.items()} == {"I": 2300, "J": 200}
    for item, rows in got.items():
        assert [r.day for r in rows] == list(range(len(rows)))
        want = loop([r.demand for r in rows], pol[item].eoq, pol[item].rop)
        assert [r.ordered for r in rows] == [o for _, o in want]
        assert max(abs(r.level - lv) for r, (lv, _) in zip(rows, want)) < 1e-9
    assert RP.replay_orders(RP.replay_history(frame)).where("n_days = 2300").count() == 1


def test_no_array_is_folded(spark):
    frame = seasonal_frame(series_df(spark, synthetic(200)), horizon=30)
    plan = RP.replay(frame, P.PolicyParams(forecast_days=30))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "array_append" not in plan and "collect_list" not in plan
    assert RP.replay(frame.where(F.lit(False)), P.PolicyParams(forecast_days=30)).count() == 0
