"""The four loads end to end, and the analyses on what they stored."""

import json
from datetime import date

import pytest
from conftest import by, months
from pyspark.sql import functions as F

from panelspark.plans import loads
from panelspark.plans.statements import STATEMENTS, run
from panelspark.schema import DIESEL, FOOD_INDEX, FOOD_SHARE, INCOME, Tables
from panelspark.sources.grid import read_grid
from panelspark.sources.store import LoadRejected, read_table

GEOS = ["BG", "DE", "EU27_2020", "RO"]


def dimension(codes):
    return {"label": "d", "category": {"index": {c: i for i, c in enumerate(codes)}, "label": {c: c for c in codes}}}


def document(constants, geos, times, value):
    dims = {k: dimension([v]) for k, v in constants.items()}
    dims |= {"geo": dimension(geos), "time": dimension(times)}
    return json.dumps({
        "label": "x", "id": list(dims), "size": [1] * len(constants) + [len(geos), len(times)],
        "dimension": dims, "value": value,
    })


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Root of tables filled from landed files."""
    base = tmp_path_factory.mktemp("landing")
    root = str(base / "tables")
    for name in ("food", "income", "share", "diesel"):
        (base / name).mkdir()

    times = [f"{m:%Y-%m}" for m in months(date(2022, 1, 1), 50)]
    value = {
        str(g * len(times) + t): 100 + 10 * g + t + (t * (g + 2)) % 7
        for g in range(4)
        for t in range(len(times))
        if (g, t) != (0, 49)
    }
    codes = loads.FOOD_CODES
    (base / "food" / "a.json").write_text(document(codes, GEOS, times, value))
    years = ["2023", "2024", "2025"]
    for g, geo in enumerate(GEOS):
        body = document(loads.INCOME_DIMS, [geo], years, {"0": 1000 + g, "1": 1100 + g, "2": 1300 + g})
        (base / "income" / f"{geo}.json").write_text(body)

    share = [[""] * 4 for _ in range(47)]
    share[2] = ["Year", "2008", "2009", "2010"]
    share[46] = ["Food", "34.9", "35.1", "35.8"]
    (base / "share" / "par.csv").write_text("\n".join(",".join(r) for r in share))

    diesel = [["h"] * 190 for _ in range(3)]
    for w in range(290):
        row = [""] * 190
        day = date.fromordinal(date(2021, 1, 4).toordinal() + 7 * w)
        row[0] = day.isoformat()
        for i, (geo, c) in enumerate(loads.DIESEL_COLUMNS.items()):
            row[c] = str(1000 + 50 * i + (w * (7 + i)) % 90)
        diesel.append(row)
    diesel[10][32] = "n.a."
    diesel.append(["2007-12-31"] + ["5"] * 189)
    (base / "diesel" / "Prices.csv").write_text("\n".join(",".join(r) for r in diesel))

    counts = {
        "food": loads.load_food_index(spark, str(base / "food"), root),
        "income": loads.load_income(spark, str(base / "income"), root),
        "share": loads.load_food_share(spark, read_grid(spark, str(base / "share")), root),
        "diesel": loads.load_diesel(spark, read_grid(spark, str(base / "diesel")), root),
    }
    return base, root, counts


@pytest.fixture(scope="module")
def tables(spark, stored):
    _, root, _ = stored
    return Tables(
        food=read_table(spark, root, FOOD_INDEX),
        income=read_table(spark, root, INCOME),
        share=read_table(spark, root, FOOD_SHARE),
        diesel=read_table(spark, root, DIESEL),
    )


def test_loads_report_and_store_their_rows(tables, stored):
    _, _, counts = stored
    assert counts == {"food": 199, "income": 12, "share": 3, "diesel": tables.diesel.count()}
    assert tables.food.count() == 199 and tables.income.count() == 12
    assert tables.share.where("geo = 'BG'").count() == 3
    assert tables.diesel.where("month < DATE'2008-01-01'").count() == 0
    assert tables.food.schema["hicp_index"].dataType.simpleString() == "decimal(10,4)"


def test_monthly_price_ignores_text(tables):
    row = by(tables.diesel, "month", "geo")[date(2021, 2, 1), "BG"]
    weeks = [w for w in range(290) if date.fromordinal(date(2021, 1, 4).toordinal() + 7 * w).strftime("%Y%m") == "202102"]
    prices = [1050 + (w * 8) % 90 for w in weeks if w != 7]
    assert float(row.diesel_price_per_1000l) == pytest.approx(sum(prices) / len(prices), abs=1e-4)


def test_loading_again_changes_nothing_and_a_revision_replaces(spark, stored, tables):
    base, root, _ = stored
    before = {tuple(r) for r in tables.income.collect()}
    assert loads.load_income(spark, str(base / "income"), root) == 12
    assert {tuple(r) for r in read_table(spark, root, INCOME).collect()} == before
    revised = base / "revised"
    revised.mkdir(exist_ok=True)
    (revised / "BG.json").write_text(document(loads.INCOME_DIMS, ["BG"], ["2025"], {"0": 1234.56}))
    other = str(base / "other")
    loads.load_income(spark, str(base / "income"), other)
    assert loads.load_income(spark, str(revised), other) == 1
    out = by(read_table(spark, other, INCOME), "year", "geo")
    assert len(out) == 12 and str(out[2025, "BG"].income_pps) == "1234.56"


def test_empty_cells_are_dropped_or_reject_the_load(spark, stored, tmp_path):
    base, _, _ = stored
    with pytest.raises(LoadRejected, match="hicp_index_is_null': 1"):
        loads.load_food_index(spark, str(base / "food"), str(tmp_path), on_missing="keep")


def test_spine_reports_months_without_observation(spark, stored):
    base, _, _ = stored
    grid = read_grid(spark, str(base / "diesel"))
    grid = grid.where("cells[0] NOT LIKE '2022-05%'")
    monthly = loads.diesel_rows(grid)
    assert monthly.where("diesel_price_per_1000l IS NULL").select("month").distinct().collect() == [
        (date(2022, 5, 1),)
    ]


def test_every_statement_is_valid_on_the_stored_tables(tables):
    for name in STATEMENTS:
        assert run(name, tables).columns


@pytest.mark.parametrize(
    "name", ["yoy_extremes", "growth_compare_same_year", "diesel_lags_vs_food", "direction_compare_lag3"]
)
def test_statements_find_rows_in_their_default_scope(tables, name):
    assert run(name, tables).count() > 0


def test_statements_use_the_documented_scope(tables):
    gap = run("yoy_gap_vs_benchmark", tables)
    assert {r.geo for r in gap.collect()} == {"BG", "DE", "RO"}
    pairs = run("lagged_timeseries", tables).collect()
    assert {r.geo for r in pairs} == {"BG", "DE", "RO"}
    assert min(r.month for r in pairs) == date(2023, 1, 1)
    assert [r.geo for r in run("series_endpoints", tables).collect()] == ["BG"]
    (row,) = run("calendar_integrity", tables).collect()
    assert (row.observations, row.expected_months, row.missing_months) == (49, 49, 0)
    assert run("food_preview", tables).count() == 5
    assert run("diesel_latest", tables).where(F.col("month") < "2026-01-01").count() == 0


def test_results_come_ordered(tables):
    for name, order in {"mom_change": ["geo", "month"], "diesel_vs_food_yoy": ["month", "geo"]}.items():
        rows = [tuple(r[c] for c in order) for r in run(name, tables).collect()]
        assert rows == sorted(rows)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_other_series_of_the_index_do_not_mix_in(tables, name):
    """A second category and a second unit change nothing but the reports over the whole table."""
    whole_table = {"series_profile", "series_profile_by_geo", "series_span", "series_span_by_geo", "food_preview", "food_tail"}
    if name in whole_table:
        return
    more = tables.food
    for column, code in (("coicop18", "CP02"), ("unit", "I15"), ("freq", "A")):
        other = tables.food.withColumns(
            {column: F.lit(code), "hicp_index": (F.col("hicp_index") * 3).cast("decimal(10,4)")}
        )
        more = more.unionByName(other)
    mixed = Tables(food=more, income=tables.income, share=tables.share, diesel=tables.diesel)
    assert sorted(map(repr, run(name, mixed).collect())) == sorted(map(repr, run(name, tables).collect()))
