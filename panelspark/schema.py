"""The four stored tables, their keys, and the checks a load runs before it writes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


@dataclass(frozen=True)
class TableSpec:
    """A panel table: columns, the period, the measure and the length limits of its codes."""

    name: str
    schema: StructType
    period: str
    measure: str
    lengths: dict[str, int] = field(default_factory=dict)

    @property
    def key(self) -> list[str]:
        """Primary key: every column but the measure."""
        return [c for c in self.schema.names if c != self.measure]

    @property
    def series(self) -> list[str]:
        """Series key: the primary key without the period."""
        return [c for c in self.key if c != self.period]

    @property
    def period_year(self) -> Column:
        period = F.col(self.period)
        is_date = isinstance(self.schema[self.period].dataType, DateType)
        return F.year(period) if is_date else period


def _spec(name: str, columns: list[tuple], period: str, measure: str, **lengths: int) -> TableSpec:
    fields = [StructField(column, kind, False) for column, kind in columns]
    return TableSpec(name, StructType(fields), period, measure, lengths)


# Names, types and code lengths of the stored tables.
FOOD_INDEX = _spec(
    "hicp_food_index",
    [
        ("month", DateType()),
        ("geo", StringType()),
        ("coicop18", StringType()),
        ("unit", StringType()),
        ("freq", StringType()),
        ("hicp_index", DecimalType(10, 4)),
    ],
    "month",
    "hicp_index",
    geo=16,
    coicop18=16,
    unit=10,
    freq=1,
)
INCOME = _spec(
    "income_pps",
    [("year", IntegerType()), ("geo", StringType()), ("income_pps", DecimalType(12, 2))],
    "year",
    "income_pps",
    geo=16,
)
FOOD_SHARE = _spec(
    "household_food_expenditure_share",
    [
        ("year", IntegerType()),
        ("geo", StringType()),
        ("food_expenditure_share_pct", DecimalType(5, 2)),
    ],
    "year",
    "food_expenditure_share_pct",
    geo=16,
)
DIESEL = _spec(
    "diesel_prices",
    [
        ("month", DateType()),
        ("geo", StringType()),
        ("diesel_price_per_1000l", DecimalType(10, 4)),
    ],
    "month",
    "diesel_price_per_1000l",
    geo=16,
)
TABLES = {spec.name: spec for spec in (FOOD_INDEX, INCOME, FOOD_SHARE, DIESEL)}


@dataclass(frozen=True)
class Tables:
    """The four tables as DataFrames; a statement uses only those it needs."""

    food: DataFrame | None = None
    income: DataFrame | None = None
    share: DataFrame | None = None
    diesel: DataFrame | None = None


@dataclass(frozen=True)
class Scope:
    """What an analysis is about: members, dates and years.  The defaults are fixed values."""

    # The index that analyses of the index table are about; its other rows are other series.
    item: str = "CP01"
    unit: str = "I25"
    freq: str = "M"
    benchmark: str = "EU27_2020"
    diesel_geos: tuple[str, ...] = ("BG", "DE", "RO")
    income_geos: tuple[str, ...] = ("BG", "DE", "RO", "EU27_2020")
    geo_order: tuple[str, ...] = ("BG", "DE", "RO", "EU27_2020")
    series_geo: str | None = "BG"  # None: every series
    series_item: str | None = "CP01"  # None: every category
    share_geo: str = "BG"
    since_display: str = "2026-01-01"
    since_statistics: str = "2023-01-01"
    same_years: tuple[int, int] = (2023, 2025)
    reference_years: tuple[int, int] = (2022, 2024)
    # Columns of the growth table; a reference year that is not listed is an error.
    growth_years: tuple[int, ...] = (2022, 2023, 2024)


def normalise_codes(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Codes in upper case without blanks, so that key comparison does not depend on spelling."""
    codes = {c: F.upper(F.trim(c)) for c in spec.lengths if c in df.columns}
    return df.withColumns(codes)


def narrow(df: DataFrame, spec: TableSpec, *extra: str) -> DataFrame:
    """The table's columns in order, cast to the declared types, and the ``extra`` ones.

    A number is rounded half up to the declared scale; NaN becomes NULL; one too large for
    the declared precision raises (ANSI mode).
    """
    columns = []
    types = dict(df.dtypes)
    for column in spec.schema:
        value = F.col(column.name)
        if types[column.name] in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        columns.append(value.cast(column.dataType).alias(column.name))
    return df.select(*columns, *extra)


def broken_rules(spec: TableSpec) -> dict[str, Column]:
    """Per rule (NOT NULL of each column, length of each code) a condition that is true for a breach."""
    rules = {f"{c}_is_null": F.col(c).isNull() for c in spec.schema.names}
    for column, limit in spec.lengths.items():
        rules[f"{column}_longer_than_{limit}"] = F.length(column) > limit
    return rules


def rule_counts(spec: TableSpec) -> dict[str, Column]:
    """Per rule the aggregate that counts its breaches."""
    return {
        rule: F.count_if(F.coalesce(bad, F.lit(False))).alias(rule)
        for rule, bad in broken_rules(spec).items()
    }


def rule_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: how many rows break each rule."""
    return df.agg(*rule_counts(spec).values())


def broken_rule_names(spec: TableSpec) -> Column:
    """The names of the rules that a row breaks, in the order of :func:`broken_rules`."""
    rules = broken_rules(spec)
    named = F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(rule)) for rule, bad in rules.items()])
    return F.array_compact(named)


def tag_rows(df: DataFrame, spec: TableSpec, order: Column | str) -> DataFrame:
    """``df`` with ``broken``, the rules that each row breaks; ``superseded`` is one of them.

    A row is superseded if a row with the same key comes later in ``order`` and breaks no other rule.  The last
    row of each key comes from an aggregate that combines before the shuffle and is joined back, so that
    a key may hold most of the rows.  Rows of a key that tie for the last are all kept.
    """
    place = F.col(order) if isinstance(order, str) else order
    tagged = df.withColumns({"_rules": broken_rule_names(spec), "_place": place})
    sound = tagged.where(F.size("_rules") == 0)
    last = sound.groupBy(*spec.key).agg(F.max("_place").alias("_last"))
    late = F.array_append("_rules", F.lit("superseded"))
    is_late = (F.size("_rules") == 0) & (F.col("_place") < F.col("_last"))
    joined = tagged.join(last, spec.key, "left")
    broken = F.when(F.coalesce(is_late, F.lit(False)), late).otherwise(F.col("_rules"))
    return joined.select(*df.columns, broken.alias("broken"))


def key_breaches(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Primary-key values that occur more than once, with their count."""
    counted = df.groupBy(*spec.key).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") > 1)


def schema_report(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, str | None]]:
    """(column, declared type, found type or None) for every column whose type differs."""
    found = dict(df.dtypes)
    return [
        (f.name, f.dataType.simpleString(), found.get(f.name))
        for f in spec.schema
        if found.get(f.name) != f.dataType.simpleString()
    ]
