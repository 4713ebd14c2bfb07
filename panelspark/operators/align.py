"""Monthly prices against annual income: annual means, reference years, growth comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelspark.functions.calendar import within_years
from panelspark.functions.numeric import (
    adjusted_growth_pct,
    mean_of,
    ratio_growth_pct,
    rounded,
)
from panelspark.operators.growth import pct_change, series_window


def annual_mean(
    df: DataFrame,
    key: Sequence[str],
    month: str,
    value: str,
    *,
    years: tuple[int, int] | None = None,
    min_periods: int | None = None,
    year: str = "year",
    out: str = "annual_mean",
    digits: int | None = None,
) -> DataFrame:
    """Mean of the monthly values of each year.

    ``years`` bounds the years read; ``min_periods`` drops years with fewer months.
    """
    if years:
        df = df.where(within_years(F.col(month), *years))
    means = df.groupBy(F.year(month).alias(year), *key).agg(
        rounded(mean_of(df, value), digits).alias(out),
        F.count(value).alias("_periods"),
    )
    if min_periods:
        means = means.where(F.col("_periods") >= min_periods)
    return means.drop("_periods")


def join_income(
    prices: DataFrame, income: DataFrame, geo: str = "geo", reference_shift: int = 0
) -> DataFrame:
    """Annual prices beside the income of the same geography.

    Income surveyed in a year refers to ``reference_shift`` years before; prices join on
    that reference year.  Both come out as ``survey_year`` and ``reference_year``.
    """
    surveyed = income.withColumnRenamed("year", "survey_year").withColumn(
        "reference_year", F.col("survey_year") - reference_shift
    )
    return prices.withColumnRenamed("year", "reference_year").join(
        surveyed, ["reference_year", geo]
    )


def growth_after_join(
    joined: DataFrame, key: Sequence[str], period: str, columns: dict[str, str], digits: int = 2
) -> DataFrame:
    """Adds growth on the previous joined row for each ``value -> output`` pair.

    The lag is taken after the join, so the first joined year of a series has no growth.
    One window serves all columns.
    """
    window = series_window(key, period)
    return joined.withColumns(
        {
            out: rounded(ratio_growth_pct(F.col(value), F.lag(value).over(window)), digits)
            for value, out in columns.items()
        }
    )


def adjusted_growth(
    income: DataFrame,
    annual_prices: DataFrame,
    *,
    geo: str = "geo",
    price_key: Sequence[str] = ("geo",),
    income_value: str = "income_pps",
    price_value: str = "annual_mean",
    shift: int = 1,
    digits: int = 2,
) -> DataFrame:
    """Income growth, price growth, their difference and the ratio-adjusted growth.

    Each side takes its growth over its own years before the join; rounding comes last.
    """
    income_growth = pct_change(
        income.withColumn("reference_year", F.col("year") - shift),
        [geo],
        "reference_year",
        income_value,
        out="_income",
    ).where(F.col("_income").isNotNull())
    price_growth = pct_change(
        annual_prices.withColumnRenamed("year", "reference_year"),
        price_key,
        "reference_year",
        price_value,
        out="_price",
    )
    joined = income_growth.select("reference_year", geo, "_income").join(
        price_growth.select("reference_year", *price_key, "_price"), ["reference_year", geo]
    )
    mine, theirs = F.col("_income"), F.col("_price")
    return joined.select(
        "reference_year",
        geo,
        rounded(mine, digits).alias("income_growth_pct"),
        rounded(theirs, digits).alias("food_hicp_growth_pct"),
        rounded(mine - theirs, digits).alias("simple_difference_pp"),
        rounded(adjusted_growth_pct(mine, theirs), digits).alias("food_adjusted_income_growth_pct"),
    )
