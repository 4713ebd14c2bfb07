"""A driver series beside a target series: lag correlation and up/down regimes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelspark.functions.numeric import rounded
from panelspark.operators.moments import Moments


def direction(signal: Column, up: str, down: str, flat: str, missing: str | None = None) -> Column:
    """Label of the sign of a signal.  NULL counts as flat unless ``missing`` names it."""
    label = F.when(signal > 0, up).when(signal < 0, down)
    if missing is not None:
        label = label.when(signal.isNull(), missing)
    return label.otherwise(flat)


def lag_correlation(
    df: DataFrame,
    key: Sequence[str],
    signals: dict[str, str],
    target: str,
    *,
    method: str = "moments",
    digits: int = 3,
) -> DataFrame:
    """Correlation of the target with each ``signal -> output`` column.

    ``moments`` takes each moment over its column's own non-null rows, ``pairwise`` all of them over
    the rows that have both.
    """
    y = F.col(target)
    columns = {target: y, **{x: F.col(x) for x in signals}}
    names = {x: (x, target) for x in signals}
    if method == "pairwise":
        columns, names = {}, {}
        for x in signals:
            both = F.col(x).isNotNull() & y.isNotNull()
            names[x] = f"{x} of both", f"{target} beside {x}"
            columns.update(zip(names[x], (F.when(both, F.col(x)), F.when(both, y)), strict=True))
    elif method != "moments":
        raise ValueError(f"method is moments or pairwise, not {method!r}")
    moments = Moments(df, key, columns)
    return moments.agg(
        *[rounded(moments.correlation(*names[x]), digits).alias(out) for x, out in signals.items()]
    )


def observation_counts(df: DataFrame, key: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Rows per group, and the non-null rows of each ``column -> output``."""
    return df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(column).alias(out) for column, out in columns.items()],
    )


def regime_summary(
    df: DataFrame,
    key: Sequence[str],
    label: Column,
    target: str,
    *,
    name: str,
    out: str,
    digits: int = 2,
) -> DataFrame:
    """Observations and mean target per group and regime label."""
    moments = Moments(df.withColumn(name, label), [*key, name], {target: F.col(target)})
    return moments.agg(
        F.count(F.lit(1)).alias("observations"),
        rounded(moments.mean(target), digits).alias(out),
    )


def regime_compare(
    df: DataFrame,
    key: Sequence[str],
    signal: str,
    target: str,
    *,
    prefix: str = "diesel",
    subject: str = "food",
    digits: int = 2,
) -> DataFrame:
    """One row per group: counts and mean target while the signal is up and down, and the
    difference of the unrounded means.  Rows without a signal, or with 0, are in neither."""
    up, down = F.col(signal) > 0, F.col(signal) < 0
    masked = {"up": F.when(up, F.col(target)), "down": F.when(down, F.col(target))}
    moments = Moments(df, key, masked)
    mean_up, mean_down = moments.mean("up"), moments.mean("down")
    return moments.agg(
        F.count(F.when(up, 1)).alias(f"{prefix}_up_observations"),
        F.count(F.when(down, 1)).alias(f"{prefix}_down_observations"),
        rounded(mean_up, digits).alias(f"avg_{subject}_when_{prefix}_up"),
        rounded(mean_down, digits).alias(f"avg_{subject}_when_{prefix}_down"),
        rounded(mean_up - mean_down, digits).alias("difference_pp"),
    )
