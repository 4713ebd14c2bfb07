"""Resampling to months, long/wide reshaping and presentation order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from panelspark.functions.calendar import month_start
from panelspark.functions.numeric import mean_of
from panelspark.operators.growth import series_window


# "series", "all", or the first and the last month (a scalar subquery is a Column too)
Spine = str | tuple[Column | date | str, Column | date | str]


def resample_month(
    df: DataFrame,
    key: Sequence[str],
    day: str,
    value: str,
    *,
    since: date | str | None = None,
    spine: Spine | None = None,
    month: str = "month",
) -> DataFrame:
    """Mean of the observations of each calendar month, ignoring missing ones.

    ``spine`` adds the months without any row as NULL, see :func:`fill_months`.
    """
    if since is not None:
        df = df.where(F.col(day) >= F.lit(str(since)).cast("date"))
    means = df.groupBy(*key, month_start(F.col(day)).alias(month)).agg(
        mean_of(df, value).alias(value)
    )
    return means if spine is None else fill_months(means, key, month, value, spine)


def fill_months(
    df: DataFrame, key: Sequence[str], month: str, value: str, spine: Spine = "series"
) -> DataFrame:
    """One row for every month of the span, NULL where there was none.

    The span is ``"series"``, from the first to the last month of each series; a pair of
    months; or ``"all"``, from the first to the last month of the data, as resampling a wide
    frame does.  ``"all"`` looks the two months up in a second pass: give the pair if ``df``
    is expensive to compute.  A pair must contain the months of ``df``; others raise.

    Each row also produces the empty months up to the next row of its series, so there is no
    calendar table and no join.
    """
    own = F.col(month)
    if spine == "series":
        lower, upper = own, own
    elif spine == "all":
        ends = df.select(F.struct(F.min(month).alias("first"), F.max(month).alias("last"))).scalar()
        lower, upper = ends["first"], ends["last"]
    elif isinstance(spine, str):
        raise ValueError(f"unknown spine {spine!r}")
    else:
        lower, upper = (
            end if isinstance(end, Column) else F.lit(str(end)).cast("date") for end in spine
        )
        outside = F.raise_error(F.concat(F.lit("month outside the span: "), own.cast("string")))
        df = df.withColumn(month, F.when(own.between(lower, upper), own).otherwise(outside))
    window = series_window(key, month)
    following = F.lead(month).over(window)
    is_first = F.lag(month).over(window).isNull()
    ends = df.withColumn("_from", F.when(is_first, lower).otherwise(own)).withColumn(
        "_to", F.when(following.isNull(), upper).otherwise(F.add_months(following, -1))
    )
    months = F.sequence("_from", "_to", F.expr("interval 1 month"))
    return ends.withColumn("_month", F.explode(months)).select(
        *key,
        F.col("_month").alias(month),
        F.when(F.col("_month") == own, F.col(value)).alias(value),
    )


def unpivot_panel(
    wide: DataFrame, ids: Sequence[str], members: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per member column; missing cells are kept as NULL."""
    return wide.unpivot(list(ids), list(members), name, value)


def pivot_panel(
    df: DataFrame, index: Sequence[str], columns: str, values: Sequence, value: str
) -> DataFrame:
    """One column per listed value.  The list is given, so no extra job looks it up.

    A value that is not listed raises instead of vanishing, and a repeated (index, column) pair
    raises instead of picking one of its values.
    """
    unlisted = F.raise_error(
        F.concat(F.lit(f"pivot: no column for {columns} "), F.col(columns).cast("string"))
    )
    known = F.col(columns).isNull() | F.col(columns).isin(*values)
    df = df.withColumn(columns, F.when(known, F.col(columns)).otherwise(unlisted))
    single = F.when(F.count(F.lit(1)) <= 1, F.max(value)).otherwise(
        F.raise_error(F.lit("pivot: duplicate entries for one cell"))
    )
    cells = df.groupBy(*index, columns).agg(single.alias(value))
    return cells.groupBy(*index).pivot(columns, list(values)).agg(F.max(value))


def in_order(df: DataFrame, column: str, members: Sequence[str], *then: str) -> DataFrame:
    """Rows of the listed members in the order of the list; a listed member without rows
    appears once with NULLs.  For presentation: the input has a row, or a few, per member."""
    listed = F.array(*[F.lit(m) for m in members])
    names = df.sparkSession.range(1).select(F.posexplode(listed).alias("_place", column))
    rows = names.join(df, column, "left")
    return rows.orderBy("_place", *then).select(*df.columns)
