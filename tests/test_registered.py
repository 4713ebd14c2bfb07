"""Every registered query against its SQL, and what its plan must not contain."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification.compare import connect, differences
from verification.oracles import all_oracles
from verification.registry import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()
SMALL, GATE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def databases():
    return {sf_dir: connect(sf_dir) for sf_dir in (SMALL, GATE)}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    result = entry(spark)
    assert result.columns == [
        "month", "geo", "yoy_change_pct", "eu27_yoy_change_pct", "gap_vs_eu27_pp",
    ]
    assert result.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, databases, name):
    assert differences(spark, databases[GATE], GATE, QUERIES[name], ORACLES[name]) == []


# Those that see single months or nations; the rest do not depend on gaps.
WITH_GAPS = [
    "yoy_gap_vs_benchmark",
    "lag_correlation",
    "calendar_integrity",
    "unpivot_panel",
    "resample_monthly",
    "resample_monthly_spine",
    "fill_months_by_series",
    "positional_yoy",
    "calendar_yoy",
    "calendar_lags",
    "last_n_periods",
    "nation_extremes",
    "gap_within_segment",
    "lag_correlation_pairwise",
    "direction_regime_missing",
    "missing_by_column",
    "observed_counts",
    "month_gaps",
    "nation_calendar_integrity",
    "valid_range",
    "missing_periods",
    "reconcile_sources",
    "frames_equal",
    "cube_decode",
    "cube_decode_with_missing",
    "grid_columns_monthly",
]


@pytest.mark.parametrize("name", WITH_GAPS)
def test_matches_sql_on_series_with_gaps(spark, databases, name):
    """At the smallest scale months are missing from many series."""
    assert differences(spark, databases[SMALL], SMALL, QUERIES[name], ORACLES[name]) == []


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_pairs_no_python_and_no_unkeyed_window(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert forbidden not in plan
    for line in plan.splitlines():
        if "Window [" in line:
            assert not line.rstrip().endswith("], [], []") and "], [], [" not in line


SCANNED_ONCE = [
    "yoy_gap_vs_benchmark",
    "gap_within_segment",
    "custom_order",
]


@pytest.mark.parametrize("name", SCANNED_ONCE)
def test_the_fact_table_is_read_once(spark, name):
    frame = QUERIES[name](spark, GATE)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet [o_") <= 1
