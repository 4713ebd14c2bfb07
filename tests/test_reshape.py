from datetime import date

import pytest
from conftest import by
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelspark.operators import reshape

WEEKS = [
    (date(2024, 1, 1), "a", 1.0),
    (date(2024, 1, 8), "a", None),
    (date(2024, 1, 15), "a", 4.0),
    (date(2024, 3, 4), "a", 7.0),
    (date(2024, 2, 5), "b", 2.0),
]


@pytest.fixture(scope="module")
def weekly(spark):
    return spark.createDataFrame(WEEKS, "date DATE, geo STRING, v DOUBLE")


def test_resample_ignores_missing_weeks(weekly):
    out = by(reshape.resample_month(weekly, ["geo"], "date", "v"), "geo", "month")
    assert {k: r.v for k, r in out.items()} == {
        ("a", date(2024, 1, 1)): 2.5,
        ("a", date(2024, 3, 1)): 7.0,
        ("b", date(2024, 2, 1)): 2.0,
    }


def test_spine_within_series_and_over_all(weekly):
    series = by(reshape.resample_month(weekly, ["geo"], "date", "v", spine="series"), "geo", "month")
    assert len(series) == 4 and series["a", date(2024, 2, 1)].v is None
    every = by(reshape.resample_month(weekly, ["geo"], "date", "v", spine="all"), "geo", "month")
    assert len(every) == 6
    assert every["b", date(2024, 1, 1)].v is None and every["b", date(2024, 2, 1)].v == 2.0
    pair = reshape.resample_month(
        weekly, ["geo"], "date", "v", spine=("2023-12-01", "2024-03-01")
    )
    assert by(pair, "geo", "month")["a", date(2023, 12, 1)].v is None and pair.count() == 8
    with pytest.raises(Exception, match="month outside the span"):
        reshape.resample_month(
            weekly, ["geo"], "date", "v", spine=("2024-02-01", "2024-03-01")
        ).collect()
    since = reshape.resample_month(weekly, ["geo"], "date", "v", since="2024-02-01")
    assert since.count() == 2


def test_pivot_and_unpivot_are_inverse(panel_clean):
    wide = reshape.pivot_panel(panel_clean, ["month"], "geo", ["BG", "DE"], "value")
    assert wide.columns == ["month", "BG", "DE"]
    long = reshape.unpivot_panel(wide, ["month"], ["BG", "DE"], "geo", "value")
    assert long.exceptAll(panel_clean).count() == 0 and long.count() == panel_clean.count()


def test_pivot_refuses_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "i INT, c STRING, v DOUBLE")
    with pytest.raises(Exception, match="duplicate entries"):
        reshape.pivot_panel(df, ["i"], "c", ["a"], "v").collect()


def test_unpivot_keeps_missing_cells(spark):
    wide = spark.createDataFrame([(1, 1.0, None)], "i INT, a DOUBLE, b DOUBLE")
    assert reshape.unpivot_panel(wide, ["i"], ["a", "b"], "geo", "v").count() == 2


def test_custom_order_keeps_absent_members(spark):
    df = spark.createDataFrame([("DE", 1.0), ("BG", 2.0), ("XX", 3.0)], "geo STRING, v DOUBLE")
    rows = reshape.in_order(df, "geo", ["RO", "BG", "DE"]).collect()
    assert [(r.geo, r.v) for r in rows] == [("RO", None), ("BG", 2.0), ("DE", 1.0)]


def test_exact_mean_of_decimals(spark):
    df = spark.createDataFrame(WEEKS, "date DATE, geo STRING, v DOUBLE").withColumn(
        "v", F.col("v").cast("decimal(10,4)")
    )
    out = by(reshape.resample_month(df, ["geo"], "date", "v"), "geo", "month")
    assert out["a", date(2024, 1, 1)].v == 2.5


def test_pivot_refuses_a_value_without_a_column(spark):
    df = spark.createDataFrame([("a", 2022, 1.0), ("a", 2026, 2.0)], "g STRING, y INT, v DOUBLE")
    with pytest.raises(PySparkException, match="no column for y 2026"):
        reshape.pivot_panel(df, ["g"], "y", [2022, 2023], "v").collect()
    row = reshape.pivot_panel(df, ["g"], "y", [2022, 2023, 2026], "v").first()
    assert (row["2022"], row["2023"], row["2026"]) == (1.0, None, 2.0)
