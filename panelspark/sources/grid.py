"""Header-less worksheets as rows ``(sheet, row_idx, cells)``, addressed by position.

Positions count from 0 in both directions.  Files have no row order in Spark, so the row
number is a column of the grid from the start.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelspark.functions.calendar import MONTH_FIRST, lenient_date
from panelspark.functions.numeric import lenient_double


# A quote opens a quotation only as the first character of a cell; elsewhere it is text (5" pipe).  A
# cell runs to a comma or line break outside its quotation.  Possessive repeats and the atomic choice never
# go back, so all are linear in the text and need no stack.
_QUOTED = r'"(?:[^"]++|"")*+"?+'
_IN_LINE = rf'(?>{_QUOTED}[^,\r\n]*+|[^,\r\n]*+)'
_RECORD = rf'((?:{_IN_LINE},)*+{_IN_LINE})(?:\r?\n|\r|$)'
_CELL = rf',({_QUOTED}[^,]*+|[^,]*+)'
#: The quotation of a cell, and what follows its closing quote.
_PARTS = r'(?s)^"((?:[^"]++|"")*+)"?(.*)$'
#: Columns that say which sheet a row is from.
IDENTITY = ("file", "arrived", "sheet")


def read_grid(spark: SparkSession, path: str, *, sheet: str | None = None) -> DataFrame:
    """Worksheets exported as comma-separated text, one file per sheet.

    A row is ``(file, arrived, sheet, row_idx, cells)``: the path is the identity of a sheet, its
    name (the file's, or ``sheet``) a label, ``arrived`` the file's time.  A quoted cell may
    hold line breaks, commas and doubled quotes, and a quote inside an unquoted cell is text; rows are as
    long as they are, and empty cells are NULL.  A byte-order mark is left out.  The row number is taken inside the file and counts blank rows, so a sheet is one task and
    many sheets are many.
    """
    files = spark.read.text(path, wholetext=True)
    name = F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1)
    # Some programs start a file with a byte-order mark.
    records = F.regexp_extract_all(F.regexp_replace("value", "^\ufeff", ""), F.lit(_RECORD), F.lit(1))
    lines = files.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("arrived"),
        (name if sheet is None else F.lit(sheet)).alias("sheet"),
        F.posexplode(records).alias("row_idx", "line"),
    ).where(F.length("line") > 0)
    cells = F.regexp_extract_all(F.concat(F.lit(","), "line"), F.lit(_CELL), F.lit(1))

    def plain(cell: Column) -> Column:
        inner = F.regexp_replace(F.regexp_extract(cell, _PARTS, 1), '""', '"')
        quoted = F.concat(inner, F.regexp_extract(cell, _PARTS, 2))
        text = F.when(cell.startswith('"'), quoted).otherwise(cell)
        return F.when(F.length(text) > 0, text)

    return lines.select(
        "file",
        "arrived",
        "sheet",
        F.col("row_idx").cast("bigint").alias("row_idx"),
        F.transform(cells, plain).alias("cells"),
    )


def identity(grid: DataFrame) -> list[str]:
    """The columns of ``grid`` that tell its sheets apart."""
    return [c for c in IDENTITY if c in grid.columns]


def grid_shape(grid: DataFrame) -> DataFrame:
    """Rows and columns of each sheet."""
    return grid.groupBy(*identity(grid)).agg(
        (F.max("row_idx") + 1).alias("rows"), F.max(F.size("cells")).alias("columns")
    )


def grid_rows(grid: DataFrame, first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last`` of each sheet, both included."""
    return grid.where(F.col("row_idx").between(first, last))


def header_mismatches(grid: DataFrame, expected: Mapping[tuple[int, int], str]) -> DataFrame:
    """Cells whose text is not the expected one, for ``(row, column) -> text``.

    Positions are configuration; this shows a sheet whose layout has moved.
    """
    checks = F.array(
        *[
            F.struct(F.lit(r).cast("bigint").alias("row"), F.lit(c).alias("column"), F.lit(t).alias("expected"))
            for (r, c), t in expected.items()
        ]
    )
    rows = sorted({r for r, _ in expected})
    here = F.filter(checks, lambda check: check["row"] == F.col("row_idx"))
    looked_up = F.transform(
        here, lambda check: check.withField("found", F.get(F.col("cells"), check["column"]))
    )
    return (
        grid.where(F.col("row_idx").isin(*rows))
        .select("sheet", F.inline(looked_up))
        .where(~F.col("found").eqNullSafe(F.col("expected")))
    )


def columns_to_wide(
    grid: DataFrame,
    columns: Mapping[str, int],
    *,
    first_row: int,
    date_column: int = 0,
    formats: Sequence[tuple[str, str | None]] = MONTH_FIRST,
    keep: Sequence[str] = (),
) -> DataFrame:
    """A date and one number column per named position, from ``first_row`` on.

    Rows without a date are dropped (``rejected_dates`` shows those that hold text there); a cell
    that is no number is NULL.
    """
    cell = lambda i: F.get(F.col("cells"), F.lit(i))
    dated = grid.where(F.col("row_idx") >= first_row).withColumn(
        "date", lenient_date(cell(date_column), formats)
    )
    return dated.where(F.col("date").isNotNull()).select(
        *keep, "date", *[lenient_double(cell(i)).alias(name) for name, i in columns.items()]
    )


def rejected_dates(
    grid: DataFrame,
    *,
    first_row: int,
    date_column: int = 0,
    formats: Sequence[tuple[str, str | None]] = MONTH_FIRST,
) -> DataFrame:
    """How many rows of each sheet have text in the date column that is no date."""
    cell = F.get(F.col("cells"), F.lit(date_column))
    bad = cell.isNotNull() & lenient_date(cell, formats).isNull()
    counted = grid.where(F.col("row_idx") >= first_row).groupBy(*identity(grid))
    return counted.agg(F.count_if(bad).alias("rejected"))


def columns_to_long(
    grid: DataFrame,
    columns: Mapping[str, int],
    value: str,
    *,
    first_row: int,
    date_column: int = 0,
    member: str = "geo",
    formats: Sequence[tuple[str, str | None]] = MONTH_FIRST,
) -> DataFrame:
    """The same as rows ``(date, member, value)``, one per date and member.

    Of several rows for a date, in one sheet or in a later version of it, the last wins: by the
    sheet's time, its file, and the row.
    """
    order = [c for c in (*IDENTITY, "row_idx") if c in grid.columns]
    wide = columns_to_wide(
        grid, columns, first_row=first_row, date_column=date_column, formats=formats, keep=order
    )
    long = wide.unpivot([*order, "date"], list(columns), member, value)
    arrival = [c for c in ("arrived", "file", "sheet", "row_idx") if c in order]
    return long.groupBy("date", member).agg(F.max_by(value, F.struct(*arrival)).alias(value))


def rows_to_long(
    grid: DataFrame,
    year_row: int,
    value_row: int,
    value: str,
    *,
    first_column: int = 1,
    year: str = "year",
) -> DataFrame:
    """Two rows of each sheet, years and values, as ``(sheet, column, year, value)``.

    The casts are strict: text where a year or a number belongs raises.
    """
    wanted = grid.where(F.col("row_idx").isin(year_row, value_row))
    row = lambda i: F.max(F.when(F.col("row_idx") == i, F.col("cells")))
    sheet = identity(grid)
    pairs = wanted.groupBy(*sheet).agg(row(year_row).alias("y"), row(value_row).alias("v"))
    tail = lambda c: F.slice(c, first_column + 1, F.greatest(F.size(c) - first_column, F.lit(0)))
    zipped = F.arrays_zip(tail("y").alias("y"), tail("v").alias("v"))
    no_year = F.raise_error(F.concat(F.lit("value without a year: "), F.col("v")))
    number = F.col("v").cast("double")
    return (
        pairs.select(*sheet, F.posexplode(zipped).alias("at", "pair"))
        .select(*sheet, (F.col("at") + first_column).alias("column"), "pair.*")
        .where(F.col("y").isNotNull() | F.col("v").isNotNull())
        .select(
            *sheet,
            "column",
            F.when(F.col("y").isNull(), no_year)
            .otherwise(F.col("y").cast("double").cast("int"))
            .alias(year),
            F.when(~F.isnan(number), number).alias(value),
        )
    )
