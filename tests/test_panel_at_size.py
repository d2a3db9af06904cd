"""Dense panels without windows or sorts of their rows."""

import datetime as dt

from merchlens.operators import forecast
from merchlens.plans.registry import rounded
from pyspark.sql import functions as F


def sold_and_who(spark):
    day = dt.date(2024, 2, 20)
    rows = [("a", day + dt.timedelta(i), 1 + i % 3) for i in range(0, 30, 4)] + [("b", day + dt.timedelta(3), 5), ("b", day + dt.timedelta(3), 2), ("b", None, 4), ("x", day, 9)]
    sold = spark.createDataFrame(rows, "series_id string, date date, daily_sales bigint")
    who = spark.createDataFrame([("a", "c"), ("b", "c"), ("b", "c"), ("none", None), (None, "d")], "series_id string, category string")
    return sold, who


def listed(df):
    return sorted((tuple(repr(round(v, 9)) if isinstance(v, float) else repr(v) for v in r) for r in df.collect()))


def test_lags_of_dense_series_equal_those_of_windows(spark):
    sold, who = sold_and_who(spark)
    for fill in ("series", "past"):
        assert listed(forecast.lags(forecast.dense_series(sold, who), fill=fill)) == listed(forecast.lags(forecast.dense_panel(sold, who), fill=fill))
        assert listed(forecast.supervised(forecast.dense_series(sold, who), fill=fill)) == listed(forecast.supervised(forecast.dense_panel(sold, who), fill=fill))
    whole = forecast.dense_series(sold, who)
    assert [listed(x) for x in forecast.holdout(whole, 5)] == [listed(x) for x in forecast.holdout(whole.rows(), 5)]
    panel = forecast.dense_panel(sold, who)
    assert panel.count() == 4 * 29 + 1 and panel.where("series_id = 'b'").agg(F.sum("daily_sales")).first()[0] == 2 * (5 + 2 + 4)
    assert forecast.dense_panel(sold.where("date is null"), who).count() == 0


def test_rows_of_a_panel_are_neither_sorted_nor_grouped(spark):
    sold, who = sold_and_who(spark)
    plan = forecast.lags(forecast.dense_series(sold, who))._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate posexplode")]
    assert not any(step in above for step in ("Window", "Sort", "Aggregate", "Exchange")), above


def test_rounding_equals_the_decimal_one(spark):
    values = [0.0, -0.0, 1.0, 3 / 7, 2.5, 0.00005, 1.00005, -1.23456789012345, 1e15, 1e20, 123456.78905, float("nan"), float("inf"), None, 1 / 3, 0.1 + 0.2]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in (0, 2, 4, 6):
        got = df.select(rounded(F.col("x"), n).alias("g"), F.round(F.round("x", n + 5), n).alias("w")).collect()
        assert [repr(r.g) for r in got] == [repr(r.w) for r in got]
