"""Comparisons between members and within a series: gaps, extremes, summaries, endpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType

from panelspark.functions.numeric import growth_pct, rounded
from panelspark.operators.moments import Moments


def gap_vs_benchmark(
    rates: DataFrame,
    geo: str,
    period: str,
    value: str,
    benchmark: str,
    *,
    within: Sequence[str] = (),
    benchmark_value: str = "benchmark_value",
    out: str = "gap_pp",
    digits: int | None = None,
) -> DataFrame:
    """Every member's value beside the benchmark member's value of the same period.

    The benchmark is looked up by conditional aggregation instead of a filtered self join:
    both sides then read the same exchange and the input is computed once (the filter on the
    member is there for that: the join would infer it for one side only).  ``within`` names
    further key columns, so that series of one kind are compared with the benchmark's of that kind.
    The lookup is broadcast if AQE measures it small.
    """
    on = [period, *within]
    rates = rates.where(F.col(geo).isNotNull())
    is_benchmark = F.col(geo) == benchmark
    lookup = rates.groupBy(*on).agg(
        F.max(F.when(is_benchmark, F.col(geo))).alias("_benchmark"),
        F.max(F.when(is_benchmark, F.col(value))).alias(benchmark_value),
    )
    left, right = rates.alias("member"), lookup.alias("lookup")
    # The inequality also drops periods without a benchmark row (NULL on the right).
    condition = F.col(f"member.{geo}") != F.col("lookup._benchmark")
    for column in on:
        condition = condition & (F.col(f"member.{column}") == F.col(f"lookup.{column}"))
    joined = left.join(right, condition).select("member.*", f"lookup.{benchmark_value}")
    return joined.withColumn(out, rounded(F.col(value) - F.col(benchmark_value), digits))


def extremes(
    df: DataFrame,
    key: Sequence[str],
    period: str,
    value: str,
    *,
    highest: str = "Highest",
    lowest: str = "Lowest",
    label: str = "change_type",
) -> DataFrame:
    """The row with the highest and the row with the lowest value of each series.

    Ties go to the earliest period; a NULL counts as the lowest; a row that is both appears
    once, as the highest.  Minimum and maximum of a struct need no sort by value.
    """
    is_date = isinstance(df.schema[period].dataType, DateType)
    order = F.unix_date(period) if is_date else F.col(period)
    both = df.groupBy(*key).agg(
        F.max(F.struct(F.col(value), (-order).alias("_order"), F.col(period))).alias("_high"),
        F.min(F.struct(F.col(value), order.alias("_order"), F.col(period))).alias("_low"),
    )

    def row(side: str, name: str) -> Column:
        return F.struct(
            F.col(f"{side}.{period}").alias(period),
            F.col(f"{side}.{value}").alias(value),
            F.lit(name).alias(label),
        )

    other_row = F.when(F.col(f"_low.{period}") != F.col(f"_high.{period}"), row("_low", lowest))
    rows = F.array_compact(F.array(row("_high", highest), other_row))
    return both.select(*key, F.inline(rows))


def summary(
    df: DataFrame, key: Sequence[str], value: str, names: dict[str, str], digits: int = 2
) -> DataFrame:
    """Mean, minimum, maximum and population standard deviation; rounded at the end only.

    ``names`` maps ``avg``, ``min``, ``max``, ``stddev_pop`` to output columns.
    """
    moments = Moments(df, key, {value: F.col(value)})
    how_to = {
        "avg": lambda: moments.mean(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "stddev_pop": lambda: moments.stddev_pop(value),
    }
    return moments.agg(*[F.round(how_to[how](), digits).alias(out) for how, out in names.items()])


def endpoints(
    df: DataFrame,
    key: Sequence[str],
    period: str,
    value: str,
    first: str = "first_value",
    last: str = "last_value",
) -> DataFrame:
    """First and last value of each series, in one aggregation."""
    return df.groupBy(*key).agg(
        F.min_by(value, period).alias(first), F.max_by(value, period).alias(last)
    )


def endpoint_change(
    df: DataFrame,
    key: Sequence[str],
    period: str,
    value: str,
    first: str = "first_value",
    last: str = "last_value",
    digits: int = 2,
) -> DataFrame:
    """Endpoints with the absolute and the percent change between them."""
    ends = endpoints(df, key, period, value, first, last)
    return ends.withColumn("absolute_change", F.col(last) - F.col(first)).withColumn(
        "percent_change", rounded(growth_pct(F.col(last), F.col(first)), digits)
    )
