import datetime as dt

import pandas as pd


def series_df(spark, values, item="I", store="S", start=dt.date(2015, 1, 5), price=1.0, days=None):
    """One series with consecutive (or given) days."""
    days = days or [start + dt.timedelta(days=i) for i in range(len(values))]
    pdf = pd.DataFrame({"item_id": item, "store_id": store, "ds": days,
                        "y": [float(v) for v in values], "sell_price": price})
    return spark.createDataFrame(pdf, "item_id string, store_id string, ds date, y double, sell_price double")


WEEKDAY = [0.5, -0.3, 0.1, 0.0, 0.4, -0.4, -0.3]


def synthetic(n=200, start=dt.date(2015, 1, 5)):
    """y = 2 + 0.01 t + weekday effect, no noise."""
    return [2 + 0.01 * t + WEEKDAY[(start + dt.timedelta(days=t)).weekday()] for t in range(n)]
