from datetime import date

import pytest
from conftest import by
from pyspark.sql import functions as F

from panelspark.operators import growth


def test_change_on_the_row_before(panel_clean):
    out = by(growth.pct_change(panel_clean, ["geo"], "month", "value", digits=2), "geo", "month")
    assert out["BG", date(2022, 1, 1)].change_pct is None
    assert out["BG", date(2022, 2, 1)].previous_value == 100.0
    assert out["BG", date(2022, 2, 1)].change_pct == 0.5
    assert out["DE", date(2022, 2, 1)].change_pct == 0.5


def test_modes_agree_without_gaps(panel_clean):
    one = growth.pct_change(panel_clean, ["geo"], "month", "value", 12)
    two = growth.pct_change(panel_clean, ["geo"], "month", "value", 12, mode="calendar")
    assert one.exceptAll(two).count() == 0
    assert one.where("change_pct IS NOT NULL").count() == 36


def test_calendar_mode_sees_the_gap(panel_gap):
    calendar = by(
        growth.pct_change(panel_gap, ["geo"], "month", "value", 12, mode="calendar"), "geo", "month"
    )
    positional = by(growth.pct_change(panel_gap, ["geo"], "month", "value", 12), "geo", "month")
    gap = ("BG", date(2023, 6, 1))
    assert calendar[gap].previous_value is None
    assert positional[gap].previous_value == 102.0  # 2022-05, one month off
    after = ("BG", date(2023, 7, 1))
    assert calendar[after].previous_value == 103.0
    assert positional["DE", date(2023, 6, 1)].previous_value == 205.0


def test_calendar_mode_on_years(spark):
    df = spark.createDataFrame([(2020, "a", 1.0), (2022, "a", 2.0), (2023, "a", 3.0)], "year INT, k STRING, v DOUBLE")
    out = by(growth.pct_change(df, ["k"], "year", "v", mode="calendar"), "year")
    assert out[2022,].previous_value is None
    assert out[2023,].change_pct == 50.0


def test_zero_base_gives_null(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, "a", 5.0), (3, "a", 10.0)], "year INT, k STRING, v DOUBLE")
    out = by(growth.pct_change(df, ["k"], "year", "v"), "year")
    assert out[2,].change_pct is None and out[2,].previous_value == 0.0
    assert out[3,].change_pct == 100.0


def test_abs_change_keeps_the_type(spark):
    df = spark.createDataFrame([(1, "a", "1.10"), (2, "a", "1.35")], "year INT, k STRING, v STRING")
    df = df.withColumn("v", F.col("v").cast("decimal(10,4)"))
    out = by(growth.abs_change(df, ["k"], "year", "v"), "year")
    assert str(out[2,].change) == "0.2500"


def test_lags_share_one_window(panel_clean):
    out = growth.add_lags(panel_clean, ["geo"], "month", "value", {"a": 1, "b": 2, "c": 3})
    row = by(out, "geo", "month")["DE", date(2022, 4, 1)]
    assert (row.a, row.b, row.c) == (202.0, 201.0, 200.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def test_period_gaps_and_last_periods(panel_gap):
    gaps = by(growth.period_gaps(panel_gap, ["geo"]), "geo", "month")
    assert gaps["BG", date(2022, 7, 1)].month_gap == 2
    assert gaps["DE", date(2022, 7, 1)].month_gap == 1
    assert gaps["DE", date(2022, 1, 1)].month_gap is None
    last = growth.last_periods(panel_gap, ["geo"], "month", 3)
    assert {r.month for r in last.collect()} == {date(2024, 4, 1), date(2024, 5, 1), date(2024, 6, 1)}
    assert "WindowGroupLimit" in last._jdf.queryExecution().executedPlan().toString()


def test_a_series_key_is_required(panel_clean):
    with pytest.raises(ValueError):
        growth.pct_change(panel_clean, [], "month", "value")
