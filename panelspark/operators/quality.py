"""Data-quality reports.

All of them are aggregations with a partial step before the shuffle, so a key that holds
most of the rows is reduced to one row per map task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelspark.functions.calendar import months_apart
from panelspark.functions.numeric import mean_of
from panelspark.operators.growth import period_gaps


def missing_by_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: missing values per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def observed_counts(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Rows, non-null values and missing values per group."""
    counted = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("observations"), F.count(value).alias("non_null_values")
    )
    return counted.withColumn(
        "missing_values", F.col("observations") - F.col("non_null_values")
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") > 1)


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier key."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def month_gaps(df: DataFrame, key: Sequence[str], month: str = "month") -> DataFrame:
    """Pairs of neighbouring rows of a series that are not one month apart."""
    gaps = period_gaps(df, key, month).where(F.col("month_gap") != 1)
    return gaps.select(*key, month, "previous_month", "month_gap")


def calendar_integrity(df: DataFrame, key: Sequence[str], month: str = "month") -> DataFrame:
    """Rows, distinct months, months the span should have, and months missing from it."""
    spans = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("observations"),
        F.count_distinct(month).alias("distinct_months"),
        (months_apart(F.min(month), F.max(month)) + 1).alias("expected_months"),
    )
    return spans.withColumn(
        "missing_months", F.col("expected_months") - F.col("distinct_months")
    )


def month_coverage(df: DataFrame, key: Sequence[str], month: str = "month") -> DataFrame:
    """Months available per series and year."""
    return df.groupBy(F.year(month).alias("year"), *key).agg(
        F.count(F.lit(1)).alias("months_available")
    )


def span(df: DataFrame, key: Sequence[str], period: str) -> DataFrame:
    """Row count, first and last period, overall (empty key) or per group."""
    return df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("observations"),
        F.min(period).alias(f"first_{period}"),
        F.max(period).alias(f"last_{period}"),
    )


def profile(df: DataFrame, key: Sequence[str], period: str, value: str, suffix: str) -> DataFrame:
    """Span of each series with the minimum, maximum and mean of its values."""
    return df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("observations"),
        F.min(period).alias(f"first_{period}"),
        F.max(period).alias(f"last_{period}"),
        F.min(value).alias(f"min_{suffix}"),
        F.max(value).alias(f"max_{suffix}"),
        mean_of(df, value).alias(f"avg_{suffix}"),
    )


def valid_range(df: DataFrame, key: Sequence[str], period: str, value: str) -> DataFrame:
    """Non-null observations of each series and the periods of its first and last one."""
    valid = F.when(F.col(value).isNotNull(), F.col(period))
    return df.groupBy(*key).agg(
        F.count(value).alias("observations"),
        F.min(valid).alias(f"first_{period}"),
        F.max(valid).alias(f"last_{period}"),
    )


def value_range(df: DataFrame, value: str, key: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest value."""
    return df.groupBy(*key).agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def missing_periods(df: DataFrame, key: Sequence[str], period: str, value: str) -> DataFrame:
    """Periods for which a row exists but its value is missing."""
    return df.where(F.col(value).isNull()).select(*key, period)


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    value: str,
    *,
    names: tuple[str, str] = ("left", "right"),
    digits: int = 4,
) -> DataFrame:
    """Two versions of a table side by side, with the rounded difference and a status.

    Status is ``match``, ``differ``, ``only_<name>`` or ``duplicate``.  The sides are put
    under each other and grouped rather than joined: one shuffle, no row of either side gets
    lost, and a repeated key is reported instead of multiplying out.
    """
    first, second = names

    def side(df: DataFrame, number: int) -> DataFrame:
        return df.select(*key, F.col(value).alias("_value"), F.lit(number).alias("_side"))

    def value_of(number: int):
        return F.max(F.when(F.col("_side") == number, F.col("_value")))

    def rows_of(number: int):
        return F.count(F.when(F.col("_side") == number, 1))

    grouped = (
        side(left, 1)
        .unionByName(side(right, 2))
        .groupBy(*key)
        .agg(
            value_of(1).alias(f"{value}_{first}"),
            value_of(2).alias(f"{value}_{second}"),
            rows_of(1).alias("_left_rows"),
            rows_of(2).alias("_right_rows"),
        )
    )
    a, b = F.col(f"{value}_{first}"), F.col(f"{value}_{second}")
    status = (
        F.when((F.col("_left_rows") > 1) | (F.col("_right_rows") > 1), "duplicate")
        .when(F.col("_right_rows") == 0, f"only_{first}")
        .when(F.col("_left_rows") == 0, f"only_{second}")
        .when(a.eqNullSafe(b), "match")
        .otherwise("differ")
    )
    difference = F.round(a.cast("double") - b.cast("double"), digits)
    return grouped.select(*key, a, b, difference.alias("difference"), status.alias("status"))


def merge_sources(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    value: str,
    *,
    names: tuple[str, str] = ("api", "db"),
    digits: int = 4,
) -> DataFrame:
    """The keys both sides have, with their rounded difference (see :func:`reconcile`)."""
    compared = reconcile(left, right, key, value, names=names, digits=digits)
    return compared.where(~F.col("status").startswith("only_")).drop("status")


def frames_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows only in the left, only in the right (as multisets), and whether both are 0."""
    columns = left.columns
    tagged = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    surplus = tagged.groupBy(*columns).agg(F.sum("_n").alias("_n"))
    total = lambda n: F.coalesce(F.sum(n), F.lit(0))
    counted = surplus.agg(
        total(F.greatest(F.col("_n"), F.lit(0))).alias("only_left"),
        total(F.greatest(-F.col("_n"), F.lit(0))).alias("only_right"),
    )
    return counted.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))
