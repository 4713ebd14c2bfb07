"""The registered queries: every statement, and every operator the statements do not show."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from panelspark.functions.calendar import lenient_date, parse_month
from panelspark.functions.numeric import lenient_double
from panelspark.operators import align, compare, growth, quality, regime, reshape, upsert
from panelspark import schema
from panelspark.plans import loads, statements
from panelspark.schema import FOOD_INDEX, FOOD_SHARE, key_breaches, normalise_codes, rule_report
from panelspark.sources import cube, grid
from verification import encode, star

Query = Callable[[SparkSession, str], DataFrame]
OPERATORS: dict[str, Query] = {}
YOY = {"n": 12, "previous": "previous_value", "out": "yoy_pct", "digits": 2}


def operator(function: Query) -> Query:
    OPERATORS[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare by value in any client."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("double") for name in decimals})


def nation_yoy(spark: SparkSession, d: str, mode: str = "positional") -> DataFrame:
    prices = star.nation_prices(spark, d)
    return growth.pct_change(prices, ["geo"], "month", "value", mode=mode, **YOY)


# -- reshaping --------------------------------------------------------------------------


@operator
def pivot_panel(spark, d):
    """Income by region and year, one column per year."""
    wide = reshape.pivot_panel(
        star.income(spark, d), ["geo"], "year", list(range(1995, 2002)), "income_pps"
    )
    return wide.select("geo", *[F.col(str(y)).alias(f"y{y}") for y in range(1995, 2002)])


@operator
def unpivot_panel(spark, d):
    """Wide weekly prices, one column per region, back to long; empty cells stay."""
    weekly = star.weekly_price(spark, d)
    wide = reshape.pivot_panel(
        weekly, ["date"], "geo", star.REGIONS, "diesel_price_per_1000l"
    )
    return reshape.unpivot_panel(wide, ["date"], star.REGIONS, "geo", "price")


@operator
def resample_monthly(spark, d):
    """Monthly means of the weekly prices by nation."""
    weekly = star.weekly_price(spark, d, "n_name").withColumnRenamed(
        "diesel_price_per_1000l", "price"
    )
    return reshape.resample_month(weekly, ["geo"], "date", "price")


@operator
def resample_monthly_spine(spark, d):
    """Monthly prices by nation with the empty months of the whole span."""
    prices = star.nation_prices(spark, d)
    return reshape.fill_months(
        prices, ["geo"], "month", "value", star.order_months(spark, d)
    )


@operator
def fill_months_by_series(spark, d):
    """Monthly prices by nation with the empty months inside each nation's own span."""
    return reshape.fill_months(star.nation_prices(spark, d), ["geo"], "month", "value")


@operator
def custom_order(spark, d):
    """Income of the listed regions in the listed order; a name without rows is kept."""
    listed = ("EUROPE", "ASIA", "ATLANTIS", "AFRICA", "AMERICA", "MIDDLE EAST")
    return reshape.in_order(star.income(spark, d), "geo", listed, "year")


@operator
def distinct_geos(spark, d):
    return star.food(spark, d).select("geo").distinct().orderBy("geo")


# -- growth modes -----------------------------------------------------------------------


@operator
def positional_yoy(spark, d):
    """Twelve rows back by nation, whether or not months are missing."""
    return nation_yoy(spark, d)


@operator
def calendar_yoy(spark, d):
    """Twelve months back by nation; NULL where that month is missing."""
    return nation_yoy(spark, d, "calendar")


@operator
def calendar_lags(spark, d):
    """The values 1, 2 and 3 months back by nation."""
    prices = star.nation_prices(spark, d)
    lags = {f"lag{n}": n for n in (1, 2, 3)}
    return growth.add_lags(prices, ["geo"], "month", "value", lags, mode="calendar")


@operator
def last_n_periods(spark, d):
    """The latest 24 months of each nation."""
    return growth.last_periods(star.nation_prices(spark, d), ["geo"], "month", 24)


@operator
def nation_extremes(spark, d):
    rates = nation_yoy(spark, d).where(F.col("previous_value").isNotNull())
    return compare.extremes(rates, ["geo"], "month", "yoy_pct")


@operator
def gap_within_segment(spark, d):
    """Gap to a benchmark region inside each customer segment: a lookup with more key columns."""
    key = ["geo", "segment"]
    prices = star.segment_prices(spark, d)
    rates = growth.pct_change(prices, key, "month", "value", **YOY)
    rates = rates.where(F.col("previous_value").isNotNull()).select("month", *key, "yoy_pct")
    return compare.gap_vs_benchmark(
        rates, "geo", "month", "yoy_pct", "EUROPE", within=["segment"], digits=2
    )


@operator
def lag_correlation_pairwise(spark, d):
    """Correlation over complete pairs, with months in which the lag is not there yet."""
    return _with_missing_lags(spark, d, "pairwise")


@operator
def lag_correlation_moments(spark, d):
    """The same rows with each moment over its own non-null rows."""
    return _with_missing_lags(spark, d, "moments")


def _with_missing_lags(spark, d, method):
    tables = star.StarTables(spark, d)
    scope = star.scope(since_statistics="1995-01-01")
    pairs = statements.run("lagged_timeseries", tables, scope)
    signals = {"diesel_yoy_pct": "correlation_lag0", "diesel_yoy_lag3": "correlation_lag3"}
    return regime.lag_correlation(pairs, ["geo"], signals, "food_hicp_yoy_pct", method=method)


@operator
def direction_regime_missing(spark, d):
    """Directions over all months, those without a rate labelled as such."""
    tables = star.StarTables(spark, d)
    scope = star.scope(since_statistics="1995-01-01")
    pairs = statements.run("lagged_timeseries", tables, scope)
    label = regime.direction(F.col("diesel_yoy_lag3"), "up", "down", "flat", "unknown")
    return regime.regime_summary(
        pairs, ["geo"], label, "food_hicp_yoy_pct", name="direction", out="avg_food_yoy_pct"
    )


@operator
def direction_regime_all_months(spark, d):
    """Directions over all months, those without a rate counted as flat."""
    scope = star.scope(since_statistics="1995-01-01")
    return statements.run("direction_regime_lag3", star.StarTables(spark, d), scope)


@operator
def annual_complete_years(spark, d):
    """Annual means of the years that have all twelve months."""
    key = ["geo", "coicop18", "unit"]
    return align.annual_mean(
        star.food(spark, d), key, "month", "hicp_index", min_periods=12, digits=4
    )


# -- upsert and table rules -------------------------------------------------------------


@operator
def upsert_last_write_wins(spark, d):
    """Account balances by customer, replaced by the value of the customer's last order."""
    target = star.table(spark, d, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount")
    )
    batch = star.table(spark, d, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("amount"), "o_orderkey"
    )
    return upsert.upsert(target, batch, ["custkey"], ["amount"], "o_orderkey")


@operator
def merge_by_arrival(spark, d):
    """Account balances of one day, and orders of days before and after it: the last arrival stays."""
    target = star.table(spark, d, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_acctbal").alias("amount"),
        F.lit("1997-06-01").cast("timestamp").alias("arrived"),
    )
    batch = star.table(spark, d, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("arrived"),
        "o_orderkey",
    )
    merged = upsert.merge_by_arrival(target, batch, ["custkey"], ["amount"], "o_orderkey")
    return merged.withColumn("arrived", F.col("arrived").cast("date"))


@operator
def rows_with_reasons(spark, d):
    """Every row of a batch for the share table with the rules it breaks; none means accepted."""
    number = F.col("c_custkey")
    rows = star.table(spark, d, "customer").select(
        F.when(number % 11 != 0, F.col("c_nationkey")).alias("year"),
        F.when(number % 13 == 0, F.repeat("c_mktsegment", 2)).otherwise(F.col("c_mktsegment")).alias("geo"),
        F.when(number % 17 != 0, F.col("c_acctbal")).alias("food_expenditure_share_pct"),
        "c_custkey",
    )
    tagged = schema.tag_rows(rows, FOOD_SHARE, "c_custkey")
    return tagged.select("c_custkey", F.array_join("broken", ",").alias("broken"))


@operator
def key_breaches_by_category(spark, d):
    """Rows that would break the key of the share table if customer segments were its years."""
    rows = star.table(spark, d, "customer").select(
        F.col("c_nationkey").alias("year"),
        F.col("c_mktsegment").alias("geo"),
        F.col("c_acctbal").alias("food_expenditure_share_pct"),
    )
    return key_breaches(rows, FOOD_SHARE)


@operator
def rule_breaches(spark, d):
    """How many rows of an unchecked batch break each rule of the index table."""
    rows = star.table(spark, d, "orders").select(
        parse_month(F.substring("o_orderpriority", 3, 7), lenient=True).alias("month"),
        F.col("o_orderpriority").alias("geo"),
        F.concat("o_orderpriority", F.col("o_orderpriority")).alias("coicop18"),
        F.col("o_orderstatus").alias("unit"),
        F.col("o_orderstatus").alias("freq"),
        lenient_double(F.substring("o_orderpriority", 1, 1)).alias("hicp_index"),
    )
    return rule_report(normalise_codes(rows, FOOD_INDEX), FOOD_INDEX)


@operator
def lenient_parse(spark, d):
    """Text of mixed quality to dates and numbers; what does not parse is counted as missing.

    The spelling goes by the order key: ISO, slashes both ways, compact, with the month's name, a
    spreadsheet's day number, and text that is no date; numbers with a type letter are none.
    """
    orders = star.table(spark, d, "orders")
    day, turn = F.col("o_orderdate"), F.col("o_orderkey") % 7
    spelled = ["yyyy/MM/dd", "MM/dd/yyyy", "yyyyMMdd", "d MMM yyyy"]
    text = F.when(turn == 0, day.cast("string"))
    for i, pattern in enumerate(spelled, 1):
        text = text.when(turn == i, F.date_format(day, pattern))
    serial = F.datediff(day.cast("date"), F.lit("1899-12-30").cast("date")).cast("string")
    text = text.when(turn == 5, serial).otherwise(F.col("o_orderpriority"))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    number = (
        F.when(F.col("o_orderstatus") == "O", "n.a.")
        .when(turn == 3, F.concat(price, F.lit("d")))
        .otherwise(price)
    )
    parsed = orders.select(
        "o_orderpriority", lenient_date(text).alias("day"), lenient_double(number).alias("amount")
    )
    return parsed.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("observations"),
        F.count("day").alias("dates"),
        F.max("day").alias("last_day"),
        F.count("amount").alias("numbers"),
        F.max("amount").alias("max_amount"),
    )


# -- quality reports --------------------------------------------------------------------


@operator
def drop_missing(spark, d):
    """Rows that have a rate."""
    return nation_yoy(spark, d, "calendar").na.drop(subset=["yoy_pct"])


@operator
def missing_by_column(spark, d):
    return quality.missing_by_column(nation_yoy(spark, d, "calendar"))


@operator
def observed_counts(spark, d):
    return quality.observed_counts(nation_yoy(spark, d, "calendar"), ["geo"], "yoy_pct")


@operator
def duplicate_keys(spark, d):
    lineitem = star.table(spark, d, "lineitem")
    return quality.duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"])


@operator
def duplicate_count(spark, d):
    lineitem = star.table(spark, d, "lineitem")
    return quality.duplicate_count(lineitem, ["l_orderkey", "l_linenumber"])


@operator
def month_gaps(spark, d):
    return quality.month_gaps(star.nation_prices(spark, d), ["geo"])


@operator
def nation_calendar_integrity(spark, d):
    return quality.calendar_integrity(star.nation_prices(spark, d), ["geo"])


@operator
def nation_month_coverage(spark, d):
    return quality.month_coverage(star.nation_prices(spark, d), ["geo"])


@operator
def valid_range(spark, d):
    return quality.valid_range(nation_yoy(spark, d), ["geo"], "month", "yoy_pct")


@operator
def value_range(spark, d):
    return quality.value_range(star.share(spark, d), "food_expenditure_share_pct", ["geo"])


@operator
def missing_periods(spark, d):
    return quality.missing_periods(nation_yoy(spark, d, "calendar"), ["geo"], "month", "yoy_pct")


def _two_versions(spark, d):
    every = star.nation_prices(spark, d)
    finished = star.monthly_price(spark, d, "n_name", F.col("o_orderstatus") == "F")
    return every, finished.withColumnRenamed("hicp_index", "value")


@operator
def reconcile_sources(spark, d):
    """Monthly values by nation over all orders and over the finished ones."""
    return quality.reconcile(*_two_versions(spark, d), ["geo", "month"], "value")


@operator
def merge_sources(spark, d):
    return quality.merge_sources(*_two_versions(spark, d), ["geo", "month"], "value")


@operator
def frames_equal(spark, d):
    """Months with orders by nation against months with shipments."""
    ordered = star.nation_prices(spark, d).select("geo", "month")
    shipped = star.geo_lineitems(spark, d).select(
        F.col("n_name").alias("geo"), F.trunc("day", "MM").alias("month")
    )
    return quality.frames_equal(ordered, shipped.distinct())


@operator
def row_count(spark, d):
    return quality.span(star.table(spark, d, "orders"), [], "o_orderdate")


# -- cubes and sheets -------------------------------------------------------------------

CUBE_DIMS = ["freq", "unit", "geo", "time"]


def documents(spark, d):
    return encode.region_documents(star.nation_prices(spark, d), star.places(spark, d))


def _decoded(spark, d, **options):
    cells = cube.decode_cube(documents(spark, d), CUBE_DIMS, keep=["document"], **options)
    return cells.select("document", "geo", parse_month(F.col("time")).alias("month"), "value")


@operator
def cube_decode(spark, d):
    """One document per region, decoded to its cells."""
    return _decoded(spark, d)


@operator
def cube_decode_with_missing(spark, d):
    """The same with a NULL for every empty cell."""
    return _decoded(spark, d, on_missing="keep")


@operator
def cube_labels(spark, d):
    """Cells of some codes only, with the labels beside the codes."""
    wanted = [f"NATION_{i}" for i in range(0, 25, 3)]
    cells = cube.decode_cube(
        documents(spark, d), CUBE_DIMS, labels={"geo": "country"}, where={"geo": wanted}
    )
    return cells.select("freq", "unit", "geo", "country", "time", "value")


@operator
def cube_metadata(spark, d):
    return cube.cube_metadata(documents(spark, d), keep=["document"])


@operator
def cube_last_periods(spark, d):
    """The latest 24 months of each series of a document."""
    return growth.last_periods(_decoded(spark, d), ["document", "geo"], "month", 24)


@operator
def cube_last_positions(spark, d):
    """The latest 24 months of each document, left out of the cells before rows are built."""
    return _decoded(spark, d, last={"time": 24})


@operator
def cube_strict(spark, d):
    """Cubes of the income and of its revision, where an empty cell would be an error."""
    cubes = encode.income_documents(star.income(spark, d), "income_pps")
    cells = cube.decode_cube(
        cubes, [*loads.INCOME_DIMS, "geo", "time"], on_missing="error", keep=["arrived"]
    )
    return cells.select("geo", "time", F.date_format("arrived", "yyyy-MM").alias("arrived"), "value")


def _weekly_sheet(spark, d):
    weekly = star.weekly_price(spark, d)
    return encode.weekly_sheet(weekly, list(star.REGIONS), "diesel_price_per_1000l", gap=3)


SHEET_COLUMNS = {region: 3 * (i + 1) for i, region in enumerate(star.REGIONS)}


@operator
def grid_columns(spark, d):
    """A weekly sheet, sliced by position into rows of date, member and price."""
    return grid.columns_to_long(_weekly_sheet(spark, d), SHEET_COLUMNS, "price", first_row=3)


@operator
def grid_file(spark, d):
    """The weekly sheet as a file with quoted cells, stray quotes and a byte-order mark, read again."""
    folder = encode.sheet_file(_weekly_sheet(spark, d))
    return grid.columns_to_long(grid.read_grid(spark, folder), SHEET_COLUMNS, "price", first_row=3)


@operator
def grid_columns_monthly(spark, d):
    """The same, resampled to months with the empty ones."""
    weekly = grid.columns_to_long(_weekly_sheet(spark, d), SHEET_COLUMNS, "price", first_row=3)
    weekly = weekly.withColumn("price", F.col("price").cast("decimal(10,4)"))
    span = star.week_months(spark, d)
    monthly = reshape.resample_month(weekly, ["geo"], "date", "price", spine=span)
    return monthly.withColumn("price", F.round("price", 4))


@operator
def grid_transpose(spark, d):
    """Sheets with a row of years and a row of values, to long."""
    sheets = encode.year_sheets(star.share(spark, d), "food_expenditure_share_pct")
    return grid.rows_to_long(sheets, 2, 46, "share_pct").select(
        F.col("sheet").alias("geo"), "column", "year", "share_pct"
    )


@operator
def grid_shape(spark, d):
    sheets = encode.year_sheets(star.share(spark, d), "food_expenditure_share_pct")
    return grid.grid_shape(sheets)


@operator
def grid_header_mismatches(spark, d):
    """Cells of the header that are not where the configuration expects them."""
    expected = {(0, 0): "Date", (0, 3): "AFRICA", (0, 6): "ASIA", (1, 9): "EUROPE"}
    return grid.header_mismatches(_weekly_sheet(spark, d), expected)


# -- rows of the loads -------------------------------------------------------------------


def _with_seq(rows: DataFrame) -> DataFrame:
    """The rows as the store takes them: the last of each key, without the order."""
    key = [c for c in ("month", "year", "geo", "coicop18", "unit", "freq") if c in rows.columns]
    measures = [c for c in rows.columns if c not in (*key, "seq")]
    return upsert.last_write_wins(rows, key, measures, "seq")


@operator
def cube_decode_dirty(spark, d):
    """Documents with a mark instead of a number in every third cell, as objects and as lists."""
    marked = encode.marked_documents(star.nation_prices(spark, d), star.places(spark, d))
    cells = cube.decode_cube(marked, CUBE_DIMS, keep=["document"])
    return cells.select("document", "geo", parse_month(F.col("time")).alias("month"), "value")


@operator
def cube_marks(spark, d):
    """How many cells of each document hold a mark."""
    marked = encode.marked_documents(star.nation_prices(spark, d), star.places(spark, d))
    return cube.cell_marks(marked, keep=["document"])


@operator
def food_index_rows(spark, d):
    """Cubes of the index decoded to rows of its table."""
    prices = star.monthly_price(spark, d, "r_name")
    cubes = encode.index_documents(prices, "hicp_index")
    return _with_seq(loads.food_index_rows(cubes, geos=star.MEMBERS, months=("1996-01", "2000-06")))


@operator
def income_rows(spark, d):
    """Cubes of the income, an earlier and a revised one, decoded to rows of its table."""
    income = star.income(spark, d)
    cubes = encode.income_documents(income, "income_pps")
    return _with_seq(loads.income_rows(cubes, geos=star.MEMBERS, years=("1996", "2000")))


@operator
def food_share_rows(spark, d):
    """A household sheet, and a later one of one year less, to rows of the share table."""
    one = star.share(spark, d).where(F.col("geo") == "ASIA")
    sheets = encode.revised_sheets(encode.year_sheets(one, FOOD_SHARE.measure))
    return _with_seq(loads.food_share_rows(sheets, geo="ASIA"))


@operator
def diesel_revisions(spark, d):
    """A weekly sheet and a later version of it: the later one wins for the weeks it holds."""
    sheets = encode.revised_weeks(_weekly_sheet(spark, d))
    rows = loads.diesel_rows(sheets, SHEET_COLUMNS, since=date(1996, 1, 1), spine=None)
    return rows.withColumn("diesel_price_per_1000l", F.round("diesel_price_per_1000l", 4))


@operator
def narrow(spark, d):
    """Unchecked rows cast to the declared types of the share table, codes normalised."""
    rows = star.table(spark, d, "customer").select(
        F.col("c_nationkey").alias("year"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("geo"),
        (F.col("c_acctbal") / 1000).alias("food_expenditure_share_pct"),
        "c_custkey",
    )
    return schema.narrow(normalise_codes(rows, FOOD_SHARE), FOOD_SHARE, "c_custkey")


@operator
def upsert_with_duplicate_target(spark, d):
    """Line items by part, where a part occurs often, replaced by the part's largest order."""
    lines = star.table(spark, d, "lineitem")
    target = lines.select(
        F.col("l_suppkey").alias("key"), F.col("l_extendedprice").alias("amount")
    )
    batch = lines.where(F.col("l_suppkey") % 3 == 0).select(
        F.col("l_suppkey").alias("key"),
        F.col("l_quantity").alias("amount"),
        F.struct("l_orderkey", "l_linenumber").alias("seq"),
    )
    return upsert.upsert(target, batch, ["key"], ["amount"], "seq")


def statement_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(statements.run(name, star.StarTables(spark, sf_dir), star.SCOPE))


def operator_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(OPERATORS[name](spark, sf_dir))


def all_queries() -> dict[str, Query]:
    found = {name: partial(statement_query, name) for name in statements.STATEMENTS}
    found.update({name: partial(operator_query, name) for name in OPERATORS})
    return found
