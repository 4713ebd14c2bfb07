from conftest import by
from pyspark.sql import functions as F
import pytest

from panelspark.operators import regime


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 1.0), ("a", 3.0, 5.0), ("a", None, 9.0)]
    return spark.createDataFrame(rows, "geo STRING, x DOUBLE, y DOUBLE")


def test_moments_differ_from_pairs_when_one_side_is_missing(pairs):
    (row,) = regime.lag_correlation(pairs, ["geo"], {"x": "r"}, "y", digits=None).collect()
    assert row.r == pytest.approx(-0.852573586519139)
    (row,) = regime.lag_correlation(
        pairs, ["geo"], {"x": "r"}, "y", method="pairwise", digits=None
    ).collect()
    assert row.r == pytest.approx(0.720576692122892)


def test_constant_side_has_no_correlation(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0)], "geo STRING, x DOUBLE, y DOUBLE")
    for method in ("moments", "pairwise"):
        (row,) = regime.lag_correlation(df, ["geo"], {"x": "r"}, "y", method=method).collect()
        assert row.r is None


@pytest.fixture(scope="module")
def signals(spark):
    rows = [("a", 1.0, 10.0), ("a", 2.0, 20.0), ("a", -1.0, 4.0), ("a", 0.0, 7.0), ("a", None, 9.0)]
    return spark.createDataFrame(rows, "geo STRING, s DOUBLE, f DOUBLE")


def test_flat_takes_zero_and_missing(signals):
    label = regime.direction(F.col("s"), "up", "down", "flat")
    out = by(regime.regime_summary(signals, ["geo"], label, "f", name="d", out="mean"), "d")
    assert {k[0]: (r.observations, r["mean"]) for k, r in out.items()} == {
        "up": (2, 15.0),
        "down": (1, 4.0),
        "flat": (2, 8.0),
    }
    assert sum(r.observations for r in out.values()) == signals.count()
    label = regime.direction(F.col("s"), "up", "down", "flat", "none")
    out = by(regime.regime_summary(signals, ["geo"], label, "f", name="d", out="mean"), "d")
    assert out["flat",].observations == 1 and out["none",].observations == 1


def test_comparison_ignores_zero_and_missing(signals):
    (row,) = regime.regime_compare(signals, ["geo"], "s", "f").collect()
    assert (row.diesel_up_observations, row.diesel_down_observations) == (2, 1)
    assert (row.avg_food_when_diesel_up, row.avg_food_when_diesel_down) == (15.0, 4.0)
    assert row.difference_pp == 11.0


def test_observation_counts(pairs):
    (row,) = regime.observation_counts(pairs, ["geo"], {"x": "nx", "y": "ny"}).collect()
    assert (row.total_rows, row.nx, row.ny) == (4, 3, 4)
