"""Earlier values of the same series, and changes against them.

Windows here are partitioned by the series key and hold one row per period, so a window
partition never has more rows than the calendar has periods, however many raw rows stand
behind a series: raw data are aggregated to the period first (``reshape.resample_month``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql.types import DateType

from panelspark.functions.calendar import month_number, months_apart
from panelspark.functions.numeric import growth_pct, rounded


def series_window(key: Sequence[str], period: str) -> WindowSpec:
    """One window per series in period order.  A key is required: without one, all rows
    would go through a single task."""
    if not key:
        raise ValueError("a series key is required")
    return Window.partitionBy(*key).orderBy(period)


def earlier(
    df: DataFrame,
    key: Sequence[str],
    period: str,
    value: str,
    n: int = 1,
    mode: str = "positional",
) -> Column:
    """The value ``n`` steps back.

    ``positional`` counts rows of the series.  ``calendar`` counts months (years for an
    integer period) and is NULL where that period is missing; on a series without gaps both
    agree.
    """
    window = series_window(key, period)
    if mode == "positional":
        return F.lag(value, n).over(window)
    if mode != "calendar":
        raise ValueError(f"unknown mode {mode!r}")
    is_date = isinstance(df.schema[period].dataType, DateType)
    step = month_number(F.col(period)) if is_date else F.col(period)
    return F.max(value).over(Window.partitionBy(*key).orderBy(step).rangeBetween(-n, -n))


def pct_change(
    df: DataFrame,
    key: Sequence[str],
    period: str,
    value: str,
    n: int = 1,
    *,
    mode: str = "positional",
    previous: str = "previous_value",
    out: str = "change_pct",
    digits: int | None = None,
) -> DataFrame:
    """Adds the value ``n`` periods back and the percent change against it."""
    with_previous = df.withColumn(previous, earlier(df, key, period, value, n, mode))
    change = growth_pct(F.col(value), F.col(previous))
    return with_previous.withColumn(out, rounded(change, digits))


def abs_change(
    df: DataFrame,
    key: Sequence[str],
    period: str,
    value: str,
    n: int = 1,
    *,
    mode: str = "positional",
    previous: str = "previous_value",
    out: str = "change",
) -> DataFrame:
    """Adds the value ``n`` periods back and the difference to it, in the type of the value."""
    with_previous = df.withColumn(previous, earlier(df, key, period, value, n, mode))
    return with_previous.withColumn(out, F.col(value) - F.col(previous))


def add_lags(
    df: DataFrame,
    key: Sequence[str],
    period: str,
    value: str,
    lags: dict[str, int],
    *,
    mode: str = "positional",
) -> DataFrame:
    """Adds one column per entry ``name -> steps back``; all share one window."""
    return df.withColumns({name: earlier(df, key, period, value, n, mode) for name, n in lags.items()})


def period_gaps(df: DataFrame, key: Sequence[str], month: str = "month") -> DataFrame:
    """Adds the previous month of the series and the whole months between the two."""
    previous = F.lag(month).over(series_window(key, month))
    return df.withColumn("previous_month", previous).withColumn(
        "month_gap", months_apart(F.col("previous_month"), F.col(month))
    )


def last_periods(df: DataFrame, key: Sequence[str], period: str, n: int) -> DataFrame:
    """Rows of the latest ``n`` distinct periods of each series.

    A rank compared with a constant is cut on the map side already (window group limit), so
    only the candidates are shuffled.
    """
    newest_first = Window.partitionBy(*key).orderBy(F.col(period).desc())
    ranked = df.withColumn("_rank", F.dense_rank().over(newest_first))
    return ranked.where(F.col("_rank") <= n).drop("_rank")
