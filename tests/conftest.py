from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from panelspark import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "3",
            "spark.default.parallelism": "3",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def months(first: date, n: int) -> list[date]:
    start = first.year * 12 + first.month - 1
    return [date((start + i) // 12, (start + i) % 12 + 1, 1) for i in range(n)]


@pytest.fixture(scope="session")
def panel_clean(spark):
    """30 months of two members, value 100 + 0.5 i (member B: 200 + i)."""
    rows = []
    for i, month in enumerate(months(date(2022, 1, 1), 30)):
        rows.append((month, "BG", 100 + 0.5 * i))
        rows.append((month, "DE", 200.0 + i))
    return spark.createDataFrame(rows, "month DATE, geo STRING, value DOUBLE")


@pytest.fixture(scope="session")
def panel_gap(panel_clean):
    """The same without BG 2022-06."""
    return panel_clean.where("NOT (geo = 'BG' AND month = DATE'2022-06-01')")


def by(df, *columns) -> dict:
    """Rows as a dict from the given columns to the row."""
    return {tuple(row[c] for c in columns): row for row in df.collect()}
