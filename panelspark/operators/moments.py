"""Means, deviations and correlations whose bits do not depend on the order of the rows.

A sum of DOUBLEs depends on the order in which they are added, so a retried task or another partitioning
may change its last bits.  Here every value is placed on a grid of ``GRID`` steps between the smallest
and the largest value of its group; places are integers, and their sums, and the sums of their squares and
products, are exact DECIMALs that merge in any order.  The group's bounds come from an aggregate of
their own and are joined back by key, so both passes combine on the map side.  As a group's values
span the whole grid, nothing cancels: values near 1e9 that differ by a thousandth keep their spread.

NULLs take no part.  A group that holds a NaN or an infinite value has NaN as its mean, deviation and
correlation; one whose bounds lie further apart than a DOUBLE can say counts as such.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Steps between the bounds of a group.  A sum of squares then fits a DECIMAL(38) for 8e13 rows.
GRID = 1 << 40


class Moments:
    """Rows with the places of some columns on their group's grid, and aggregates over them.

    ``columns`` maps names to expressions over ``df``; the aggregates name them.
    """

    def __init__(self, df: DataFrame, key: Sequence[str], columns: Mapping[str, Column]):
        self._number = {name: i for i, name in enumerate(columns)}
        self._key = list(key)
        rows = df.withColumns(
            {f"__value{self._number[n]}": c.cast("double") for n, c in columns.items()}
        )
        numbers = self._number.values()
        bounds = rows.groupBy(*self._key).agg(
            *[F.min(f"__value{i}").alias(f"__low{i}") for i in numbers],
            *[(F.max(f"__value{i}") - F.min(f"__value{i}")).alias(f"__range{i}") for i in numbers],
        )
        bounds = bounds.withColumnsRenamed({k: f"__key{i}" for i, k in enumerate(self._key)})
        condition = F.lit(True)
        for i, k in enumerate(self._key):
            condition = condition & F.col(k).eqNullSafe(F.col(f"__key{i}"))
        self._rows = rows.join(bounds, condition).withColumns(
            {f"__at{i}": self._place(i) for i in numbers}
        )

    @staticmethod
    def _place(i: int) -> Column:
        value, low, spread = F.col(f"__value{i}"), F.col(f"__low{i}"), F.col(f"__range{i}")
        inside = (spread > 0) & (spread < float("inf"))
        place = F.when(inside, F.rint((value - low) / spread * GRID)).otherwise(F.lit(0.0))
        return F.when(value.isNotNull(), place).cast("decimal(13,0)")

    def agg(self, *columns: Column) -> DataFrame:
        """One row per key with the given aggregates."""
        return self._rows.groupBy(*self._key).agg(*columns)

    def _of(self, name: str) -> tuple[Column, Column, Column]:
        i = self._number[name]
        return F.col(f"__at{i}"), F.max(f"__low{i}"), F.max(f"__range{i}")

    @staticmethod
    def _average(place: Column, scale: float) -> Column:
        total = F.sum(place.cast("decimal(28,0)")).cast("double")
        return total / F.nullif(F.count(place), F.lit(0)) / scale

    def mean(self, name: str) -> Column:
        """Arithmetic mean; NULL without a value."""
        place, low, spread = self._of(name)
        return low + spread * self._average(place, float(GRID))

    def _deviation(self, name: str) -> Column:
        place, _, _ = self._of(name)
        mean = self._average(place, float(GRID))
        square = self._average(place * place, float(GRID) ** 2)
        return F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))

    def stddev_pop(self, name: str) -> Column:
        """Population standard deviation; 0 for a constant, NULL without a value."""
        _, _, spread = self._of(name)
        return spread * self._deviation(name)

    def correlation(self, x: str, y: str) -> Column:
        """``(E[xy] - E[x]E[y]) / (sd(x) sd(y))`` with each moment over its own non-null rows.

        With NULLs on one side only this is not Pearson's coefficient: mask both columns with the
        rows that have both for that.  NULL where one side is constant or no row has both.
        """
        u, low_x, range_x = self._of(x)
        v, low_y, range_y = self._of(y)
        one = float(GRID)
        both = u.isNotNull() & v.isNotNull()
        mean_u, mean_v = self._average(u, one), self._average(v, one)
        paired_u = self._average(F.when(both, u), one)
        paired_v = self._average(F.when(both, v), one)
        # E[xy] - E[x]E[y] for x = low + range u; the first two terms are 0 without one-sided NULLs.
        shifted = low_x * range_y * (paired_v - mean_v) + low_y * range_x * (paired_u - mean_u)
        covariance = shifted + range_x * range_y * (self._average(u * v, one * one) - mean_u * mean_v)
        return covariance / F.nullif(self.stddev_pop(x) * self.stddev_pop(y), F.lit(0.0))
