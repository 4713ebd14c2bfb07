"""The four loads: landed documents and sheets into the stored tables.

Each returns the number of rows of its batch.  Running a load again changes nothing, and loads of several
landing folders give the same table in any order: for a key, the file that arrived last counts.  Monthly
means of weekly sheets carry no arrival of their own; of two loads of those, the later call counts.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelspark.functions.calendar import parse_month
from panelspark.operators.reshape import Spine, resample_month
from panelspark.schema import DIESEL, FOOD_INDEX, FOOD_SHARE, INCOME
from panelspark.sources.cube import decode_cube, read_documents
from panelspark.sources.grid import columns_to_long, rows_to_long
from panelspark.sources.store import upsert_table

# Constant codes, members, periods and sheet positions of the sources.
FOOD_CODES = {"coicop18": "CP01", "unit": "I25", "freq": "M"}
GEOS = ("BG", "RO", "DE", "EU27_2020")
FOOD_MONTHS = ("2022-01", "2026-08")
INCOME_DIMS = {"freq": "A", "age": "TOTAL", "sex": "T", "statinfo": "MED_EI", "unit": "PPS"}
INCOME_YEARS = ("2023", "2025")
SHARE_ROWS = {"year_row": 2, "value_row": 46}
SHARE_GEO = "BG"
DIESEL_COLUMNS = {"EU": 3, "BG": 32, "DE": 55, "RO": 189}
DIESEL_FIRST_ROW = 3
DIESEL_SINCE = date(2008, 1, 7)

# A later document wins over an earlier one, a later cell over an earlier one.
ARRIVAL = ("arrived", "document", "offset")


def food_index_rows(
    raw: DataFrame,
    *,
    on_missing: str = "drop",
    geos: tuple[str, ...] = GEOS,
    months: tuple[str, str] = FOOD_MONTHS,
) -> DataFrame:
    """Documents of the monthly index to rows of the table, with their order of arrival."""
    cells = decode_cube(
        raw,
        ["freq", "unit", "coicop18", "geo", "time"],
        FOOD_INDEX.measure,
        on_missing=on_missing,
        where={**{dim: [code] for dim, code in FOOD_CODES.items()}, "geo": geos},
        keep=["document", "arrived"],
    )
    return cells.where(F.col("time").between(*months)).select(
        parse_month(F.col("time")).alias("month"),
        "geo",
        *FOOD_CODES,
        FOOD_INDEX.measure,
        F.struct(*ARRIVAL).alias("seq"),
    )


def income_rows(
    raw: DataFrame,
    *,
    geos: tuple[str, ...] = GEOS,
    years: tuple[str, str] = INCOME_YEARS,
) -> DataFrame:
    """Documents of the annual income to rows of the table; empty cells are left out."""
    cells = decode_cube(
        raw,
        [*INCOME_DIMS, "geo", "time"],
        INCOME.measure,
        where={**{dim: [code] for dim, code in INCOME_DIMS.items()}, "geo": geos},
        keep=["document", "arrived"],
    )
    return cells.where(F.col("time").between(*years)).select(
        F.col("time").cast("int").alias("year"), "geo", INCOME.measure, F.struct(*ARRIVAL).alias("seq")
    )


def food_share_rows(grid: DataFrame, geo: str = SHARE_GEO) -> DataFrame:
    """The household sheet to rows of the table: a row of years, a row of shares, one geography.

    Of several sheets the one that arrived last wins, of several columns the last.
    """
    arrival = [c for c in ("arrived", "file", "sheet") if c in grid.columns]
    return rows_to_long(grid, **SHARE_ROWS, value=FOOD_SHARE.measure).select(
        "year",
        F.lit(geo).alias("geo"),
        FOOD_SHARE.measure,
        F.struct(*arrival, "column").alias("seq"),
    )


def diesel_rows(
    grid: DataFrame,
    columns: Mapping[str, int] = DIESEL_COLUMNS,
    *,
    first_row: int = DIESEL_FIRST_ROW,
    since: date = DIESEL_SINCE,
    spine: Spine | None = "all",
) -> DataFrame:
    """Weekly sheets to monthly means per geography; a later sheet wins for the weeks it holds.

    With a spine, months without an observation come out as NULL, for reports; a load drops
    them, since the table takes no NULL.
    """
    weekly = columns_to_long(grid, columns, DIESEL.measure, first_row=first_row)
    # Decimal, so that the mean does not depend on the order in which tasks add up.
    weekly = weekly.withColumn(DIESEL.measure, F.col(DIESEL.measure).cast("decimal(18,6)"))
    monthly = resample_month(
        weekly, ["geo"], "date", DIESEL.measure, since=since, spine=spine
    )
    return monthly.select("month", "geo", DIESEL.measure)


def load_food_index(spark: SparkSession, landing: str, root: str, **options) -> int:
    rows = food_index_rows(read_documents(spark, landing), **options)
    return upsert_table(spark, root, FOOD_INDEX, rows, "seq", arrived="seq.arrived")


def load_income(spark: SparkSession, landing: str, root: str, **options) -> int:
    rows = income_rows(read_documents(spark, landing), **options)
    return upsert_table(spark, root, INCOME, rows, "seq", arrived="seq.arrived")


def load_food_share(spark: SparkSession, grid: DataFrame, root: str, **options) -> int:
    rows = food_share_rows(grid, **options)
    arrived = "seq.arrived" if "arrived" in grid.columns else None
    return upsert_table(spark, root, FOOD_SHARE, rows, "seq", arrived=arrived)


def load_diesel(spark: SparkSession, grid: DataFrame, root: str, **options) -> int:
    rows = diesel_rows(grid, spine=None, **options).where(F.col(DIESEL.measure).isNotNull())
    # One row per key after the aggregation, so any order will do.
    return upsert_table(spark, root, DIESEL, rows, F.lit(0))
