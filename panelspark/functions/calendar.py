"""Calendar expressions on DATE columns (month grain) and INT years."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, functions as F


def month_start(day: Column) -> Column:
    """First day of the month of a date."""
    return F.trunc(day, "MM")


def month_number(month: Column) -> Column:
    """Months on one running scale, so that a calendar step is a difference of integers."""
    return F.year(month) * 12 + F.month(month)


def months_apart(earlier: Column, later: Column) -> Column:
    """Whole months from ``earlier`` to ``later``."""
    return F.timestamp_diff("MONTH", earlier, later).cast("int")


def years_earlier(month: Column, years: int = 1) -> Column:
    """The same month ``years`` before."""
    return F.add_months(month, -12 * years)


def within_years(month: Column, first: int, last: int) -> Column:
    """``first <= year(month) <= last`` as a range on the column itself.

    A comparison on ``year(month)`` hides the column from the Parquet reader; the range lets
    it skip row groups.
    """
    return (month >= F.lit(date(first, 1, 1))) & (month < F.lit(date(last + 1, 1, 1)))


def parse_month(text: Column, lenient: bool = False) -> Column:
    """``yyyy-MM`` to the first day of that month; malformed text raises, or is NULL if lenient.

    Lenient mode looks at the shape first: a failed parse costs an exception per row.
    """
    if not lenient:
        return F.to_date(text, "yyyy-MM")
    return F.when(text.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(text, "yyyy-MM"))


# Spellings of a date: the shape of the text and how to read it.  Slashes put the month first, as
# the sheets' own reader does; ``DAY_FIRST`` is for exports that put the day first.
ISO = (r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$", None)
COMMON = (
    ISO,
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
)
MONTH_FIRST = (*COMMON, (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"))
DAY_FIRST = (
    *COMMON,
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
)
#: Day numbers of spreadsheets count from here; five digits are the years 1927 to 2173.
_SERIAL, _SERIAL_ORIGIN = r"^[1-9]\d{4}(\.0*)?$", date(1899, 12, 30)


def lenient_date(
    text: Column, formats: Sequence[tuple[str, str | None]] = MONTH_FIRST, *, serial: bool = True
) -> Column:
    """A date from text in one of the ``formats`` (shape, pattern), or a spreadsheet's day number.

    A pattern of None is a cast, for ISO text with or without a time of day.  Anything else is NULL; the
    shape is looked at first, since a failed parse costs an exception per row.
    """
    clean = F.trim(text)
    found = [
        F.when(
            clean.rlike(shape),
            clean.try_cast("date") if pattern is None else F.try_to_date(clean, pattern),
        )
        for shape, pattern in formats
    ]
    if serial:
        days = clean.try_cast("double").cast("int")
        found.append(F.when(clean.rlike(_SERIAL), F.date_add(F.lit(_SERIAL_ORIGIN), days)))
    return F.coalesce(*found)
