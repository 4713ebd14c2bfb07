from datetime import date

import pytest
from conftest import by, months
from pyspark.sql import functions as F

from panelspark.functions.numeric import adjusted_growth_pct
from panelspark.operators import align
from panelspark.plans.statements import run
from panelspark.schema import Scope, Tables

# Published values: income growth, price growth, adjusted growth in percent.
PUBLISHED = [
    (17.25, 14.05, 2.81),
    (4.59, 12.70, -7.20),
    (6.74, 12.65, -5.24),
    (17.49, 14.63, 2.49),
    (13.49, 2.78, 10.42),
    (5.57, 2.34, 3.15),
    (6.56, 2.32, 4.15),
    (-1.24, 2.89, -4.02),
]


@pytest.fixture(scope="module")
def tables(spark):
    food = []
    for geo, base in (("BG", 100.0), ("EU27_2020", 110.0)):
        for i, month in enumerate(months(date(2022, 1, 1), 30)):
            food.append((month, geo, base * (1 + 0.01 * i)))
    food = spark.createDataFrame(food, "month DATE, geo STRING, hicp_index DOUBLE").select(
        "month",
        "geo",
        F.lit("CP01").alias("coicop18"),
        F.lit("I25").alias("unit"),
        F.lit("M").alias("freq"),
        F.col("hicp_index").cast("decimal(10,4)").alias("hicp_index"),
    )
    income = [(2023, "BG", 1000), (2024, "BG", 1100), (2025, "BG", 1210), (2023, "RO", 900)]
    income = spark.createDataFrame(income, "year INT, geo STRING, v INT").select(
        "year", "geo", F.col("v").cast("decimal(12,2)").alias("income_pps")
    )
    return Tables(food=food, income=income)


def test_adjusted_growth_reproduces_the_published_values(spark):
    df = spark.createDataFrame(PUBLISHED, "g DOUBLE, f DOUBLE, published DOUBLE")
    adjusted = df.select("published", adjusted_growth_pct(F.col("g"), F.col("f")).alias("a"))
    assert all(abs(row.a - row.published) <= 0.01 for row in adjusted.collect())


def test_annual_mean_and_complete_years(tables):
    means = by(align.annual_mean(tables.food, ["geo"], "month", "hicp_index", digits=4), "geo", "year")
    assert means["BG", 2022].annual_mean == 105.5
    assert ("BG", 2024) in means
    complete = align.annual_mean(tables.food, ["geo"], "month", "hicp_index", min_periods=12)
    assert {r.year for r in complete.collect()} == {2022, 2023}


def test_year_range_reaches_the_scan(spark, tmp_path, tables):
    path = str(tmp_path / "food")
    tables.food.write.parquet(path)
    stored = spark.read.parquet(path)
    means = align.annual_mean(stored, ["geo"], "month", "hicp_index", years=(2023, 2023))
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(month" in plan and "LessThan(month" in plan
    assert "coicop18" not in plan.split("ReadSchema")[1]


def test_same_year_and_reference_year(tables):
    same = by(run("annual_join_income", tables), "geo", "year")
    assert set(same) == {("BG", 2023), ("BG", 2024)}
    shifted = by(run("annual_join_income_ref_year", tables), "geo", "income_survey_year")
    assert set(shifted) == {("BG", 2023), ("BG", 2024), ("BG", 2025)}
    assert shifted["BG", 2023].income_reference_year == 2022
    assert shifted["BG", 2023].avg_hicp_food_index == 105.5


def test_first_joined_year_has_no_growth(tables):
    out = by(run("affordability_gap", tables), "income_survey_year")
    assert out[2023,].income_change_pct is None
    assert out[2024,].income_change_pct == 10.0
    food = round((117.5 / 105.5 - 1) * 100, 2)
    assert out[2024,].food_hicp_change_pct == food
    assert out[2024,].affordability_gap_pp == round(10.0 - food, 2)
    kept = run("affordability_gap_nonnull", tables).collect()
    assert [r.income_reference_year for r in kept] == [2023, 2024]


def test_adjusted_growth_lags_before_the_join(tables):
    out = by(run("food_adjusted_income_growth", tables), "reference_year")
    # Income of 2023 is the base of 2024's growth, so reference year 2022 drops out.
    assert set(out) == {(2023,), (2024,)}
    price = 117.5 / 105.5 - 1
    assert out[2023,].food_adjusted_income_growth_pct == round((1.1 / (1 + price) - 1) * 100, 2)


def test_wide_table_in_the_stated_order(tables):
    rows = run("adjusted_growth_by_year", tables, Scope()).collect()
    assert [r.geo for r in rows] == ["BG", "DE", "RO", "EU27_2020"]
    assert rows[0]["2022"] is None and rows[0]["2023"] is not None
    assert rows[1]["2023"] is None
