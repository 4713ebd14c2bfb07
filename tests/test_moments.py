"""Moments: equal to numpy, and equal to the bit under any partitioning."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators.moments import Moments
from panelspark.operators.regime import lag_correlation


def _rows(base, n=400):
    rng = random.Random(base)
    rows = []
    for i in range(n):
        x = base + rng.gauss(0, 1e-3) if base else rng.gauss(3, 40)
        rows.append((["a", "b", None][i % 3], x, 0.4 * x + rng.random() if i % 7 else None))
    return rows


def _measured(df):
    m = Moments(df, ["g"], {"x": F.col("x"), "y": F.col("y")})
    out = m.agg(
        m.mean("x").alias("mean"), m.stddev_pop("x").alias("sd"), m.correlation("x", "y").alias("r")
    )
    return {r["g"]: (r["mean"], r["sd"], r["r"]) for r in out.collect()}


@pytest.mark.parametrize("base", [0, 1e9, -1e200])
def test_same_bits_in_any_order(spark, base):
    rows = _rows(base)
    first = _measured(spark.createDataFrame(rows, "g string, x double, y double").repartition(7, "x"))
    random.Random(1).shuffle(rows)
    assert _measured(spark.createDataFrame(rows, "g string, x double, y double").coalesce(1)) == first


@pytest.mark.parametrize("base", [0, 1e9])
def test_equal_to_numpy(spark, base):
    rows = _rows(base)
    found = _measured(spark.createDataFrame(rows, "g string, x double, y double"))
    assert set(found) == {"a", "b", None}
    for g, (mean, sd, r) in found.items():
        x = np.array([v for k, v, _ in rows if k == g])
        assert mean == pytest.approx(x.mean(), rel=1e-11)
        assert sd == pytest.approx(x.std(), rel=1e-6)
        if not base:  # elsewhere the moments over different rows cancel, as the statement has it
            pairs = np.array([(a, b) for k, a, b in rows if k == g and b is not None])
            y = pairs[:, 1]
            covariance = (pairs[:, 0] * y).mean() - x.mean() * y.mean()
            assert r == pytest.approx(covariance / (x.std() * y.std()), abs=1e-8)


def test_pairwise_is_pearson(spark):
    rows = _rows(1e9)
    df = spark.createDataFrame(rows, "g string, x double, y double")
    found = lag_correlation(df, ["g"], {"x": "r"}, "y", method="pairwise", digits=None).collect()
    for row in found:
        pairs = np.array([(a - 1e9, b) for g, a, b in rows if g == row["g"] and b is not None])
        assert row["r"] == pytest.approx(np.corrcoef(pairs.T)[0, 1], abs=1e-6)


def test_constants_nulls_nans_and_empty_tables(spark):
    rows = [("c", 5.5, 1.0), ("c", 5.5, 2.0), ("n", None, 1.0), ("x", math.nan, 1.0), ("x", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    found = _measured(df)
    assert found["c"] == (5.5, 0.0, None)
    assert found["n"] == (None, None, None)
    assert math.isnan(found["x"][0]) and math.isnan(found["x"][1])
    assert _measured(df.limit(0)) == {}
    with pytest.raises(ValueError):
        lag_correlation(df, ["g"], {"x": "r"}, "y", method="other")
