import csv
import random
from datetime import date

import pytest
from conftest import by
from pyspark.errors import PySparkException

from panelspark.sources import grid

WEEKLY = """Prices,,EU,BG
in force on,,,
Date,,EUR,EUR
2024-01-01 00:00:00,,100.5,90
2024-01-08,,n.a.,92
not a date,,1,2
39454,,1,2
2024-03-04,,"1,234",NaN
"""
SHARE = """Budget,,,
,,,
Year,2008,2009.0,2010
Total,100,100,100
Food,34.9,35.1,
"""


@pytest.fixture()
def sheets(spark, tmp_path):
    (tmp_path / "weekly.csv").write_text(WEEKLY)
    (tmp_path / "share.csv").write_text(SHARE)
    return grid.read_grid(spark, str(tmp_path))


def test_rows_carry_their_number(sheets):
    rows = by(sheets, "sheet", "row_idx")
    assert rows["weekly", 3].cells == ["2024-01-01 00:00:00", None, "100.5", "90"]
    assert rows["weekly", 7].cells == ["2024-03-04", None, "1,234", "NaN"]
    assert rows["share", 4].cells[0] == "Food"
    shape = by(grid.grid_shape(sheets), "sheet")
    assert (shape["weekly",].rows, shape["weekly",].columns) == (8, 4)
    assert grid.grid_rows(sheets, 0, 1).count() == 4


def test_columns_by_position(sheets):
    weekly = sheets.where("sheet = 'weekly'")
    wide = by(grid.columns_to_wide(weekly, {"EU": 2, "BG": 3}, first_row=3), "date")
    assert set(wide) == {(date(2024, 1, 1),), (date(2024, 1, 8),), (date(2024, 3, 4),), (date(2008, 1, 7),)}
    assert wide[date(2024, 1, 8),].EU is None and wide[date(2024, 1, 8),].BG == 92.0
    assert wide[date(2024, 3, 4),].EU is None and wide[date(2024, 3, 4),].BG is None
    long = grid.columns_to_long(weekly, {"EU": 2, "BG": 3}, "price", first_row=3)
    assert long.columns == ["date", "geo", "price"] and long.count() == 8


def test_two_rows_to_long(sheets):
    out = by(grid.rows_to_long(sheets.where("sheet = 'share'"), 2, 4, "pct"), "year")
    assert {k[0]: (r.column, r.pct) for k, r in out.items()} == {
        2008: (1, 34.9),
        2009: (2, 35.1),
        2010: (3, None),
    }


def test_two_rows_are_strict(sheets):
    share = sheets.where("sheet = 'share'")
    with pytest.raises(PySparkException):
        grid.rows_to_long(share, 0, 4, "pct").collect()
    with pytest.raises(PySparkException):
        grid.rows_to_long(share, 2, 4, "pct", first_column=0).collect()


def test_header_check(sheets):
    weekly = sheets.where("sheet = 'weekly'")
    assert grid.header_mismatches(weekly, {(0, 2): "EU", (0, 3): "BG"}).count() == 0
    (row,) = grid.header_mismatches(weekly, {(0, 2): "DE", (2, 0): "Date"}).collect()
    assert (row.row, row.column, row.expected, row.found) == (0, 2, "DE", "EU")


def test_rows_without_a_date_are_counted(sheets):
    weekly = sheets.where("sheet = 'weekly'")
    assert [r.rejected for r in grid.rejected_dates(weekly, first_row=3).collect()] == [1]


def test_quoted_cells_and_long_rows(spark, tmp_path):
    text = 'h,"two\nlines",x\r\n\r\n"a ""b"", c",,"",d,e,f,g\n,last'
    (tmp_path / "s.csv").write_bytes(text.encode())
    rows = by(grid.read_grid(spark, str(tmp_path)), "row_idx")
    assert {k[0]: r.cells for k, r in rows.items()} == {
        0: ["h", "two\nlines", "x"],
        2: ['a "b", c', None, None, "d", "e", "f", "g"],
        3: [None, "last"],
    }
    (shape,) = grid.grid_shape(grid.read_grid(spark, str(tmp_path))).collect()
    assert (shape.rows, shape.columns) == (4, 7)


def test_sheets_of_one_name_stay_apart(spark, tmp_path):
    for folder, first in (("a", 2020), ("b", 2022)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "s.csv").write_text(f"Year,{first},{first + 1}\nFood,{first}.5,1\n")
    sheets = grid.read_grid(spark, str(tmp_path / "*"))
    out = by(grid.rows_to_long(sheets, 0, 1, "v"), "year")
    assert sorted(k[0] for k in out) == [2020, 2021, 2022, 2023] and out[2022,].v == 2022.5


def test_a_later_sheet_wins_for_its_weeks(spark, tmp_path):
    import os

    for name, body, at in (
        ("v9", "2024-01-01,10\n2024-01-08,20\n", 100),
        ("v10", "2024-01-01,10\n2024-01-08,20\n2024-01-15,60\n2024-01-15,60\n", 200),
        ("v2", "2024-02-05,1\n2024-01-08,99\n", 50),
    ):
        path = tmp_path / f"{name}.csv"
        path.write_text(body)
        os.utime(path, (1_700_000_000 + at,) * 2)
    long = grid.columns_to_long(grid.read_grid(spark, str(tmp_path)), {"BG": 1}, "p", first_row=0)
    assert {k[0].isoformat(): r.p for k, r in by(long, "date").items()} == {
        "2024-01-01": 10.0, "2024-01-08": 20.0, "2024-01-15": 60.0, "2024-02-05": 1.0,
    }


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-01-05 10:00", date(2024, 1, 5)), ("05/01/2024", date(2024, 5, 1)),
        ("2024/1/5", date(2024, 1, 5)), ("20240105", date(2024, 1, 5)), (" 5 Jan 2024", date(2024, 1, 5)),
        ("45296", date(2024, 1, 5)), ("45296.0", date(2024, 1, 5)), ("20241305", None),
        ("31/12/2024", None), ("x", None), ("", None), (None, None), ("123", None),
    ],
)
def test_spellings_of_a_date(spark, text, day):
    from pyspark.sql import functions as F

    from panelspark.functions.calendar import DAY_FIRST, lenient_date

    row = spark.createDataFrame([(text,)], "t STRING").select(
        lenient_date(F.col("t")).alias("a"), lenient_date(F.col("t"), DAY_FIRST).alias("b")
    ).first()
    assert row.a == day
    if text and "/" in text and text[2] == "/":
        assert row.b == date(int(text[6:]), int(text[3:5]), int(text[:2]))


@pytest.mark.parametrize(
    ("text", "number"),
    [("12", 12.0), (" -1.5e3 ", -1500.0), (".5", 0.5), ("5.", 5.0), ("12d", None), ("12f", None),
     ("1D", None), ("0x1p3", None), ("NaN", None), ("n.a.", None), ("1,234", None), ("", None)],
)
def test_spellings_of_a_number(spark, text, number):
    from pyspark.sql import functions as F

    from panelspark.functions.numeric import lenient_double

    assert spark.createDataFrame([(text,)], "t STRING").select(lenient_double(F.col("t"))).first()[0] == number


@pytest.mark.parametrize("seed", range(12))
def test_cells_are_those_of_the_csv_reader(spark, tmp_path, seed):
    """Stray, doubled and unclosed quotes, line breaks in cells, rows of any width."""
    draw = random.Random(seed)
    pieces = ["a", '"', '""', ",", ",", "\n", "\r\n", ' 5" pipe', '"x,y"', '"q""q"', "\u00e9", '"b"c']
    for number in range(20):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(1, 30)))
        (tmp_path / f"s{number}.csv").write_bytes(draw.choice([b"", b"\xef\xbb\xbf"]) + text.encode())
    found = {}
    for row in grid.read_grid(spark, str(tmp_path)).collect():
        found.setdefault(row.sheet, {})[row.row_idx] = row.cells
    for number in range(20):
        with open(tmp_path / f"s{number}.csv", encoding="utf-8-sig", newline="") as file:
            rows = {i: [c or None for c in row] for i, row in enumerate(csv.reader(file)) if row}
        assert found.get(f"s{number}", {}) == rows


def test_a_quote_inside_a_cell_does_not_swallow_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text('h,a 5" pipe,x\n1,2,3\n4,"5, or ""6""",7\n' + "w," * 20_000 + "\n")
    rows = by(grid.read_grid(spark, str(tmp_path)), "row_idx")
    assert rows[0,].cells == ["h", 'a 5" pipe', "x"] and rows[2,].cells == ["4", '5, or "6"', "7"]
    assert len(rows) == 4 and len(rows[3,].cells) == 20_001
