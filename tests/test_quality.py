from datetime import date

from conftest import by

from panelspark.operators import quality


def test_missing_and_observed(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k STRING, v DOUBLE")
    (row,) = quality.missing_by_column(df).collect()
    assert (row.k, row.v) == (0, 2)
    out = by(quality.observed_counts(df, ["k"], "v"), "k")
    assert (out["a",].observations, out["a",].non_null_values, out["a",].missing_values) == (2, 1, 1)
    assert out["b",].missing_values == 1


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "a")], "year INT, geo STRING")
    (row,) = quality.duplicate_keys(df, ["year", "geo"]).collect()
    assert (row.year, row.row_count) == (1, 3)
    assert quality.duplicate_count(df, ["year", "geo"]).first().duplicate_rows == 2
    assert quality.duplicate_count(df.limit(0), ["year", "geo"]).first().duplicate_rows == 0


def test_calendar(panel_gap):
    (gap,) = quality.month_gaps(panel_gap, ["geo"]).collect()
    assert (gap.geo, gap.previous_month, gap.month, gap.month_gap) == (
        "BG", date(2022, 5, 1), date(2022, 7, 1), 2,
    )
    out = by(quality.calendar_integrity(panel_gap, ["geo"]), "geo")
    assert out["BG",].expected_months == 30 and out["BG",].missing_months == 1
    assert out["DE",].missing_months == 0
    coverage = by(quality.month_coverage(panel_gap, ["geo"]), "geo", "year")
    assert coverage["BG", 2022].months_available == 11
    assert coverage["DE", 2024].months_available == 6


def test_ranges(spark):
    rows = [(date(2024, 1, 1), "a", None), (date(2024, 2, 1), "a", 5.0), (date(2024, 3, 1), "a", 4.0)]
    df = spark.createDataFrame(rows, "month DATE, geo STRING, v DOUBLE")
    (row,) = quality.valid_range(df, ["geo"], "month", "v").collect()
    assert (row.observations, row.first_month, row.last_month) == (2, date(2024, 2, 1), date(2024, 3, 1))
    (row,) = quality.value_range(df, "v").collect()
    assert (row.min_value, row.max_value) == (4.0, 5.0)
    (row,) = quality.missing_periods(df, ["geo"], "month", "v").collect()
    assert row.month == date(2024, 1, 1)
    (row,) = quality.profile(df, ["geo"], "month", "v", "x").collect()
    assert (row.observations, row.min_x, row.max_x, row.avg_x) == (3, 4.0, 5.0, 4.5)
    assert quality.span(df, [], "month").first().last_month == date(2024, 3, 1)


def test_reconcile_has_every_status(spark):
    left = spark.createDataFrame(
        [("same", 1.0), ("other", 2.0), ("left", 3.0), ("twice", 4.0), ("twice", 5.0)],
        "k STRING, v DOUBLE",
    )
    right = spark.createDataFrame(
        [("same", 1.0), ("other", 2.5), ("right", 6.0), ("twice", 4.0)], "k STRING, v DOUBLE"
    )
    out = by(quality.reconcile(left, right, ["k"], "v"), "k")
    assert {k[0]: r.status for k, r in out.items()} == {
        "same": "match",
        "other": "differ",
        "left": "only_left",
        "right": "only_right",
        "twice": "duplicate",
    }
    assert out["other",].difference == -0.5
    merged = by(quality.merge_sources(left, right, ["k"], "v"), "k")
    assert set(merged) == {("same",), ("other",), ("twice",)}
    assert merged["same",].v_api == 1.0 and merged["same",].difference == 0.0


def test_equality_counts_rows_and_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a INT, b STRING")
    b = spark.createDataFrame([(2, None), (1, "x"), (1, "x")], "a INT, b STRING")
    assert quality.frames_equal(a, b).first().equal
    (row,) = quality.frames_equal(a, b.where("a = 1").limit(1)).collect()
    assert (row.only_left, row.only_right, row.equal) == (2, 0, False)
