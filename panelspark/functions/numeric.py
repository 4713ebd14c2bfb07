"""Numeric expressions: growth rates, lenient numbers, exact means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType


def rounded(value: Column, digits: int | None) -> Column:
    """Round half up to ``digits``; None leaves the value as it is."""
    return value if digits is None else F.round(value, digits)


def growth_pct(current: Column, previous: Column) -> Column:
    """Percent change from ``previous``; NULL where there is no base or the base is 0."""
    now, base = current.cast("double"), previous.cast("double")
    return (now - base) / F.nullif(base, F.lit(0.0)) * 100


def ratio_growth_pct(current: Column, previous: Column) -> Column:
    """Percent change written as ``current / previous - 1``."""
    return (current.cast("double") / F.nullif(previous.cast("double"), F.lit(0.0)) - 1) * 100


def adjusted_growth_pct(growth: Column, deflator: Column) -> Column:
    """Growth net of a price growth, as a ratio: ``((1 + g) / (1 + f) - 1) * 100``."""
    return ((1 + growth / 100) / F.nullif(1 + deflator / 100, F.lit(0.0)) - 1) * 100


# Java would also read 12d, 0x1p3 and the like as numbers.
_NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?)$"


def lenient_double(text: Column) -> Column:
    """Text to a number; what is no number, and NaN, becomes NULL.

    The shape is checked first: a failed cast costs an exception per row, and a number that carries a
    type letter is none.
    """
    return F.when(F.trim(text).rlike(_NUMBER), F.trim(text).try_cast("double"))


def fixed_sum(value: Column, digits: int = 2) -> Column:
    """Sum of a DOUBLE that carries at most ``digits`` decimals, as a BIGINT of its last digit.

    Integer sums do not depend on the order of the rows, so a retried task or another
    partitioning gives the same result, and they stay in generated code.  ANSI mode raises
    on overflow.
    """
    return F.sum(F.rint(value * 10**digits).cast("bigint"))


def fixed_mean(value: Column, digits: int = 2) -> Column:
    """Mean of a DOUBLE with at most ``digits`` decimals: exact sum, one division."""
    return fixed_sum(value, digits).cast("double") / (F.count(value) * 10**digits)


def mean_of(df: DataFrame, name: str) -> Column:
    """Mean of a column of ``df``: exact sum and one division for DECIMAL, ``avg`` otherwise."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, DecimalType):
        return F.sum(value).cast("double") / F.count(value)
    return F.avg(value)
