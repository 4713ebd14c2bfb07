from datetime import date

from conftest import by
from pyspark.sql import functions as F

from panelspark.operators import compare

RATES = "month DATE, geo STRING, rate DOUBLE"


def rates(spark, *rows):
    return spark.createDataFrame([(date(2024, m, 1), g, v) for m, g, v in rows], RATES)


def test_gap_needs_a_benchmark_row(spark):
    df = rates(spark, (1, "EU", 2.0), (1, "BG", 5.25), (2, "BG", 4.0), (3, "EU", None), (3, "BG", 1.0))
    out = by(compare.gap_vs_benchmark(df, "geo", "month", "rate", "EU", digits=2), "month", "geo")
    assert set(out) == {(date(2024, 1, 1), "BG"), (date(2024, 3, 1), "BG")}
    assert out[date(2024, 1, 1), "BG"].gap_pp == 3.25
    assert out[date(2024, 3, 1), "BG"].gap_pp is None


def test_gap_within_further_columns(spark):
    df = rates(spark, (1, "EU", 2.0), (1, "BG", 5.0)).withColumn("item", F.lit("x"))
    other = rates(spark, (1, "EU", 9.0), (1, "BG", 5.0)).withColumn("item", F.lit("y"))
    out = by(
        compare.gap_vs_benchmark(
            df.unionByName(other), "geo", "month", "rate", "EU", within=["item"]
        ),
        "item",
    )
    assert out["x",].gap_pp == 3.0 and out["y",].gap_pp == -4.0


def test_extremes_break_ties_by_the_earliest_month(spark):
    df = rates(spark, (1, "a", 1.0), (2, "a", 7.0), (3, "a", 7.0), (4, "a", 1.0), (1, "b", 3.0))
    out = by(compare.extremes(df, ["geo"], "month", "rate"), "geo", "change_type")
    assert out["a", "Highest"].month == date(2024, 2, 1)
    assert out["a", "Lowest"].month == date(2024, 1, 1)
    assert out["b", "Highest"].rate == 3.0
    assert ("b", "Lowest") not in out


def test_null_counts_as_lowest(spark):
    df = rates(spark, (1, "a", 1.0), (2, "a", None), (3, "a", -5.0))
    out = by(compare.extremes(df, ["geo"], "month", "rate"), "change_type")
    assert out["Lowest",].rate is None and out["Lowest",].month == date(2024, 2, 1)
    assert out["Highest",].rate == 1.0


def test_summary_uses_the_population_deviation(spark):
    df = rates(spark, (1, "a", 1.0), (2, "a", 3.0))
    names = {"avg": "m", "min": "lo", "max": "hi", "stddev_pop": "sd"}
    (row,) = compare.summary(df, ["geo"], "rate", names).collect()
    assert (row.m, row.lo, row.hi, row.sd) == (2.0, 1.0, 3.0, 1.0)


def test_endpoints(spark, panel_clean):
    out = by(compare.endpoint_change(panel_clean, ["geo"], "month", "value"), "geo")
    assert (out["BG",].first_value, out["BG",].last_value) == (100.0, 114.5)
    assert out["BG",].absolute_change == 14.5 and out["BG",].percent_change == 14.5
    assert compare.endpoints(panel_clean, ["geo"], "month", "value").count() == 2


def test_benchmark_of_the_same_series_and_no_forced_broadcast(spark):
    rows = [("2024-01", g, c, v) for g, c, v in
            [("EU", "CP01", 24.0), ("BG", "CP01", 12.0), ("EU", "CP02", 72.0), ("BG", "CP02", 70.0)]]
    rates = spark.createDataFrame(rows, "month STRING, geo STRING, item STRING, pct DOUBLE")
    gaps = compare.gap_vs_benchmark(rates, "geo", "month", "pct", "EU", within=["item"])
    assert {r.item: r.gap_pp for r in gaps.collect()} == {"CP01": -12.0, "CP02": -2.0}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = compare.gap_vs_benchmark(rates, "geo", "month", "pct", "EU")._jdf.queryExecution()
        assert "Broadcast" not in plan.executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
