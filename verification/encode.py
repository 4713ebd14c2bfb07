"""Encodes panels as the documents and sheets the sources read, to decode them again.

What is put into one document or sheet is bounded by the calendar: one value per member of a
region and month, or per year.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, functions as F

from panelspark.plans import loads
from panelspark.streaming.landing import checkpoint_dir

# A month or week is placed by its distance from this fixed Monday.
ORIGIN = "1990-01-01"


def region_documents(panel: DataFrame, places: DataFrame) -> DataFrame:
    """One cube document per region over its nations and months, empty cells left out."""
    placed = panel.join(places.select("n_name", "r_name"), F.col("geo") == F.col("n_name"))
    grouped = placed.groupBy("r_name").agg(
        F.array_sort(F.collect_set("geo")).alias("geos"),
        F.min("month").alias("first"),
        F.max("month").alias("last"),
        F.collect_list(
            F.struct("geo", "month", F.col("value").cast("double").alias("value"))
        ).alias("rows"),
    )
    months = F.sequence("first", "last", F.expr("interval 1 month"))
    grouped = grouped.withColumn("months", F.transform(months, lambda m: F.date_format(m, "yyyy-MM")))
    n_months = F.size("months")

    def positions(codes):
        return F.map_from_arrays(F.col(codes), F.sequence(F.lit(0), F.size(codes) - 1))

    def dimension(label, index, labels):
        category = F.struct(index.alias("index"), labels.alias("label"))
        return F.struct(F.lit(label).alias("label"), category.alias("category"))

    def constant(label, code, text):
        one = lambda v: F.create_map(F.lit(code), v)
        return dimension(label, one(F.lit(0)), one(F.lit(text)))

    offset = lambda r: (
        (F.array_position("geos", r["geo"]) - 1) * n_months
        + F.array_position("months", F.date_format(r["month"], "yyyy-MM"))
        - 1
    )
    cells = F.transform("rows", lambda r: F.struct(offset(r).cast("string"), r["value"]))
    titles = F.transform("geos", lambda g: F.initcap(F.replace(g, F.lit("_"), F.lit(" "))))
    document = F.struct(
        F.concat(F.lit("Order value in "), F.col("r_name")).alias("label"),
        F.array(F.lit("freq"), F.lit("geo"), F.lit("unit"), F.lit("time")).alias("id"),
        F.array(F.lit(1), F.size("geos"), F.lit(1), n_months).alias("size"),
        F.create_map(
            F.lit("freq"), constant("Frequency", "M", "Monthly"),
            F.lit("geo"), dimension(
                "Geography", positions("geos"), F.map_from_arrays(F.col("geos"), titles)
            ),
            F.lit("unit"), constant("Unit", "I25", "Index"),
            F.lit("time"), dimension(
                "Time", positions("months"), F.map_from_arrays(F.col("months"), F.col("months"))
            ),
        ).alias("dimension"),
        F.map_from_entries(cells).alias("value"),
    )
    return grouped.select(F.col("r_name").alias("document"), F.to_json(document).alias("body"))


def weekly_sheet(weekly: DataFrame, members: list[str], value: str, gap: int) -> DataFrame:
    """A sheet per the layout of a weekly bulletin: three header rows, a date column, one
    column per member ``gap`` columns apart, ``n.a.`` where there is no price."""
    spark = weekly.sparkSession
    by_week = weekly.groupBy("date").agg(
        *[F.max(F.when(F.col("geo") == m, F.col(value))).alias(m) for m in members]
    )
    blank = [F.lit(None).cast("string")] * (gap - 1)
    price = lambda m: F.coalesce(F.col(f"`{m}`").cast("string"), F.lit("n.a."))
    cells = [F.date_format("date", "yyyy-MM-dd HH:mm:ss")]
    for m in members:
        cells += [*blank, price(m)]
    weeks = (F.datediff("date", F.lit(ORIGIN)) / 7).cast("bigint")
    body = by_week.select(
        F.lit("weekly").alias("sheet"), (weeks + 3).alias("row_idx"), F.array(*cells).alias("cells")
    )
    titles = [F.lit("Date")]
    for m in members:
        titles += [*blank, F.lit(m)]
    header = spark.range(3).select(
        F.lit("weekly").alias("sheet"), F.col("id").alias("row_idx"), F.array(*titles).alias("cells")
    )
    return header.unionByName(body)


def sheet_file(sheet: DataFrame) -> str:
    """A sheet as one text file in a folder of its own below the shared one, until the session ends.

    The file starts with a byte-order mark; every second cell is quoted, and empty cells of some rows
    hold text with a quote inside.
    """
    spark = sheet.sparkSession

    def cell(text: Column, at: Column) -> Column:
        stray = F.when(F.col("row_idx") % 2 == 0, F.lit('5" pipe')).otherwise("")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.isNull(), stray).when(at % 2 == 0, quoted).otherwise(text)

    line = F.array_join(F.transform("cells", cell), ",")
    # One value per week: the calendar bounds the file.
    lines = F.array_sort(F.collect_list(F.struct("row_idx", line.alias("line"))))
    rows = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.max("row_idx")),
        lambda i: F.coalesce(F.try_element_at(F.map_from_entries(lines), i), F.lit("")),
    )
    text = sheet.agg(F.concat(F.lit("\ufeff"), F.array_join(rows, "\n")).alias("value"))
    folder = checkpoint_dir(spark, f"sheet-{uuid4().hex}", tempfile.mkdtemp())
    text.coalesce(1).write.text(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def year_sheets(annual: DataFrame, value: str) -> DataFrame:
    """A sheet per geography with a row of years and a row of values."""
    years = F.array_sort(F.collect_list(F.struct("year", F.col(value).alias("v"))))
    sheets = annual.groupBy("geo").agg(years.alias("pairs"))
    text = lambda name: F.transform("pairs", lambda p: p[name].cast("string"))
    row = lambda number, title, values: F.struct(
        F.lit(number).cast("bigint").alias("row_idx"),
        F.concat(F.array(F.lit(title)), values).alias("cells"),
    )
    rows = F.array(
        row(0, "Structure of expenditure", F.array().cast("array<string>")),
        row(2, "Year", text("year")),
        row(45, "Total", F.transform("pairs", lambda p: F.lit("100.0"))),
        row(46, "Food", text("v")),
    )
    return sheets.select(F.col("geo").alias("sheet"), F.inline(rows))


def marked_documents(panel: DataFrame, places: DataFrame) -> DataFrame:
    """The cubes of the regions with ``:`` for every third offset; regions whose name has an even
    length give their values as a list with nulls."""
    documents = region_documents(panel, places)
    body = "struct<value: map<string, string>, size: array<int>>"
    parsed = documents.withColumn("parsed", F.from_json("body", body))
    value = F.transform_values(
        "parsed.value",
        lambda offset, v: F.when(offset.cast("bigint") % 3 == 0, F.lit('":"')).otherwise(v),
    )
    volume = F.aggregate("parsed.size", F.lit(1).cast("bigint"), lambda a, n: a * n)
    offsets = F.transform(F.sequence(F.lit(0).cast("bigint"), volume - 1), lambda o: o.cast("string"))
    cells = F.transform(offsets, lambda o: F.coalesce(F.try_element_at(value, o), F.lit("null")))
    pairs = F.transform(
        F.map_entries(value), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])
    )
    listed = F.concat(F.lit("["), F.array_join(cells, ","), F.lit("]"))
    keyed = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    text = F.when(F.length("document") % 2 == 0, listed).otherwise(keyed)
    # The value stands last in the document.
    head = F.regexp_extract("body", r'(?s)^(.*"value":)\{[^{}]*\}\}$', 1)
    return parsed.select("document", F.concat(head, text, F.lit("}")).alias("body"))


def _axis(label: str, codes) -> Column:
    at = F.map_from_arrays(codes, F.sequence(F.lit(0), F.size(codes) - 1))
    category = F.struct(at.alias("index"), F.map_from_arrays(codes, codes).alias("label"))
    return F.struct(F.lit(label).alias("label"), category.alias("category"))


def _cubes(rows: DataFrame, constants: dict[str, str], time: Column, value: str) -> DataFrame:
    """One cube per geography over its periods; ``arrived`` is a fixed time."""
    grouped = rows.groupBy("geo").agg(
        F.array_sort(F.collect_list(F.struct(time.alias("t"), F.col(value).cast("double").alias("v")))).alias("cells")
    )
    names = [*constants, "geo", "time"]
    axes = [_axis(k, F.array(F.lit(v))) for k, v in constants.items()]
    axes += [_axis("geo", F.array("geo")), _axis("time", F.col("cells")["t"])]
    entries = [x for name, axis in zip(names, axes, strict=True) for x in (F.lit(name), axis)]
    sizes = [*[F.lit(1)] * (len(constants) + 1), F.size("cells")]
    document = F.struct(
        F.lit("cube").alias("label"),
        F.array(*[F.lit(n) for n in names]).alias("id"),
        F.array(*sizes).alias("size"),
        F.create_map(*entries).alias("dimension"),
        F.col("cells")["v"].alias("value"),
    )
    return grouped.select(
        F.col("geo").alias("document"),
        F.lit("2024-01-01").cast("timestamp").alias("arrived"),
        F.to_json(document).alias("body"),
    )


def index_documents(prices: DataFrame, value: str) -> DataFrame:
    """Cubes of the monthly index."""
    return _cubes(prices, dict(loads.FOOD_CODES), F.date_format("month", "yyyy-MM"), value)


def income_documents(income: DataFrame, value: str) -> DataFrame:
    """Cubes of the annual income, and revised ones that arrive later, of even years plus 1."""
    time = F.col("year").cast("string")
    first = _cubes(income, loads.INCOME_DIMS, time, value)
    changed = income.where(F.col("year") % 2 == 0).withColumn(value, F.col(value) + 1)
    later = _cubes(changed, loads.INCOME_DIMS, time, value)
    return first.unionByName(later.withColumn("arrived", F.lit("2024-02-01").cast("timestamp")))


def revised_sheets(sheets: DataFrame) -> DataFrame:
    """The sheets, first named ``v9``, and a later version named ``v10`` without its last column."""
    at = lambda day: F.lit(day).cast("timestamp")
    first = sheets.withColumns(
        {"file": F.lit("v9"), "sheet": F.lit("v9"), "arrived": at("2024-01-01")}
    )
    raised = F.transform(
        F.slice("cells", F.lit(1), F.size("cells") - 1),
        lambda c, i: F.when((F.col("row_idx") == 46) & (i > 0), F.lit("50.25")).otherwise(c),
    )
    later = sheets.where(F.size("cells") > 1).withColumns(
        {"cells": raised, "file": F.lit("v10"), "sheet": F.lit("v10"), "arrived": at("2024-02-01")}
    )
    return first.unionByName(later)


def revised_weeks(sheet: DataFrame) -> DataFrame:
    """A weekly sheet and a later version that holds every other week, with prices of 1000."""
    at = lambda day: F.lit(day).cast("timestamp")
    first = sheet.withColumns({"file": F.lit("a"), "arrived": at("2024-01-01")})
    prices = F.transform(
        "cells", lambda c, i: F.when((i > 0) & c.isNotNull() & (c != "n.a."), F.lit("1000")).otherwise(c)
    )
    later = sheet.where((F.col("row_idx") < 3) | (F.col("row_idx") % 2 == 0)).withColumns(
        {"cells": F.when(F.col("row_idx") < 3, F.col("cells")).otherwise(prices),
         "file": F.lit("b"), "arrived": at("2024-02-01")}
    )
    return first.unionByName(later)
