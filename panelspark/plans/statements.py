"""The analyses over the four tables.

Each statement takes the tables and a scope and returns a DataFrame in the order a reader
expects.  They are compositions of the operators; what a statement owns is which values are
rounded when, and whether a lag comes before or after a join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from panelspark.functions.calendar import years_earlier
from panelspark.functions.numeric import ratio_growth_pct, rounded
from panelspark.operators import align, compare, quality, regime
from panelspark.operators.growth import (
    abs_change,
    add_lags,
    earlier,
    pct_change,
    period_gaps,
)
from panelspark.operators.reshape import in_order, pivot_panel
from panelspark.schema import DIESEL, FOOD_INDEX, INCOME, Scope, Tables

Statement = Callable[[Tables, Scope], DataFrame]
STATEMENTS: dict[str, Statement] = {}

FOOD_KEY, FOOD = FOOD_INDEX.series, FOOD_INDEX.measure
DIESEL_KEY, PRICE = DIESEL.series, DIESEL.measure
INCOME_KEY, PPS = INCOME.series, INCOME.measure
YEAR = 12


def statement(function: Statement) -> Statement:
    STATEMENTS[function.__name__] = function
    return function


def run(name: str, tables: Tables, scope: Scope = Scope()) -> DataFrame:
    """The statement of that name."""
    return STATEMENTS[name](tables, scope)


def _since(column: str, day: str):
    return F.col(column) >= F.lit(day).cast("date")


def _index(t: Tables, s: Scope) -> DataFrame:
    """The rows of the index the scope is about: one category, unit and frequency, so that a
    geography is one series."""
    return t.food.where(
        (F.col("coicop18") == s.item) & (F.col("unit") == s.unit) & (F.col("freq") == s.freq)
    )


def _one_series(t: Tables, s: Scope) -> DataFrame:
    food = t.food.where((F.col("unit") == s.unit) & (F.col("freq") == s.freq))
    if s.series_geo is not None:
        food = food.where(F.col("geo") == s.series_geo)
    if s.series_item is not None:
        food = food.where(F.col("coicop18") == s.series_item)
    return food


def _food_yoy(food: DataFrame, digits: int | None = None, out: str = "yoy_change_pct") -> DataFrame:
    return pct_change(
        food, FOOD_KEY, "month", FOOD, YEAR, previous="previous_year_index", out=out, digits=digits
    )


def _complete_food_yoy(food: DataFrame, digits: int | None) -> DataFrame:
    """Year-over-year rates of the rows that have a row a year before."""
    return _food_yoy(food, digits).where(F.col("previous_year_index").isNotNull())


# -- index level: changes, gaps, extremes -----------------------------------------------


@statement
def mom_change(t: Tables, s: Scope) -> DataFrame:
    """Month-over-month percent change of the index."""
    changed = pct_change(
        _index(t, s), FOOD_KEY, "month", FOOD, previous="previous_index", out="mom_change_pct", digits=2
    )
    return changed.select("month", "geo", FOOD, "previous_index", "mom_change_pct").orderBy(
        "geo", "month"
    )


@statement
def yoy_change(t: Tables, s: Scope) -> DataFrame:
    """Year-over-year percent change of the index."""
    columns = ["month", "geo", FOOD, "previous_year_index", "yoy_change_pct"]
    return _food_yoy(_index(t, s), 2).select(*columns).orderBy("geo", "month")


@statement
def yoy_gap_vs_benchmark(t: Tables, s: Scope) -> DataFrame:
    """Year-over-year rate minus the benchmark's, both rounded before the difference."""
    rates = _complete_food_yoy(_index(t, s), 2).select("month", *FOOD_KEY, "yoy_change_pct")
    gaps = compare.gap_vs_benchmark(
        rates,
        "geo",
        "month",
        "yoy_change_pct",
        s.benchmark,
        within=[c for c in FOOD_KEY if c != "geo"],
        benchmark_value="eu27_yoy_change_pct",
        out="gap_vs_eu27_pp",
        digits=2,
    )
    columns = ["month", "geo", "yoy_change_pct", "eu27_yoy_change_pct", "gap_vs_eu27_pp"]
    return gaps.select(*columns).orderBy("geo", "month")


@statement
def yoy_extremes(t: Tables, s: Scope) -> DataFrame:
    """Month of the highest and of the lowest rounded year-over-year rate."""
    rates = _complete_food_yoy(_index(t, s), 2)
    found = compare.extremes(rates, FOOD_KEY, "month", "yoy_change_pct")
    return found.select("month", "geo", "yoy_change_pct", "change_type").orderBy(
        "geo", "change_type"
    )


@statement
def yoy_summary(t: Tables, s: Scope) -> DataFrame:
    """Mean, range and volatility of the year-over-year rate."""
    names = {
        "avg": "avg_yoy_pct",
        "min": "min_yoy_pct",
        "max": "max_yoy_pct",
        "stddev_pop": "yoy_volatility",
    }
    rates = _complete_food_yoy(_index(t, s), None)
    return (
        compare.summary(rates, FOOD_KEY, "yoy_change_pct", names)
        .select("geo", *names.values())
        .orderBy("geo")
    )


# -- income and annual prices -----------------------------------------------------------


@statement
def income_listing(t: Tables, s: Scope) -> DataFrame:
    return t.income.select("year", "geo", PPS).orderBy("geo", "year")


@statement
def income_change(t: Tables, s: Scope) -> DataFrame:
    """Absolute and percent change of income on the survey year before."""
    changed = abs_change(t.income, INCOME_KEY, "year", PPS, previous="_before", out="change_pps")
    growth = ratio_growth_pct(F.col(PPS), F.col("_before"))
    return (
        changed.withColumn("income_change_pct", rounded(growth, 2))
        .select("year", "geo", PPS, "change_pps", "income_change_pct")
        .orderBy("geo", "year")
    )


@statement
def month_coverage(t: Tables, s: Scope) -> DataFrame:
    """Months available per geography and year."""
    covered = quality.month_coverage(_index(t, s), FOOD_KEY)
    return covered.select("year", "geo", "months_available").orderBy("geo", "year")


def _annual_food(
    t: Tables, s: Scope, years: tuple[int, int] | None, digits: int | None
) -> DataFrame:
    return align.annual_mean(
        _index(t, s), FOOD_KEY, "month", FOOD, years=years, out="avg_hicp_food_index", digits=digits
    )


@statement
def annual_average(t: Tables, s: Scope) -> DataFrame:
    """Annual mean of the index."""
    means = _annual_food(t, s, s.same_years, 4)
    return means.select("year", "geo", "avg_hicp_food_index").orderBy("geo", "year")


@statement
def annual_join_income(t: Tables, s: Scope) -> DataFrame:
    """Annual mean of the index beside the income surveyed in the same year."""
    joined = align.join_income(_annual_food(t, s, s.same_years, 4), t.income)
    return joined.select(
        F.col("survey_year").alias("year"), "geo", "avg_hicp_food_index", PPS
    ).orderBy("geo", "year")


def _joined_growth(
    t: Tables, s: Scope, years: tuple[int, int], shift: int, income_growth: str
) -> DataFrame:
    joined = align.join_income(_annual_food(t, s, years, None), t.income, reference_shift=shift)
    return align.growth_after_join(
        joined,
        FOOD_KEY,
        "survey_year",
        {"avg_hicp_food_index": "food_hicp_change_pct", PPS: income_growth},
    )


@statement
def growth_compare_same_year(t: Tables, s: Scope) -> DataFrame:
    """Price and income growth, aligned on the survey year."""
    return (
        _joined_growth(t, s, s.same_years, 0, "income_change_pct")
        .select(
            F.col("survey_year").alias("year"), "geo", "food_hicp_change_pct", "income_change_pct"
        )
        .orderBy("geo", "year")
    )


@statement
def annual_join_income_ref_year(t: Tables, s: Scope) -> DataFrame:
    """Annual mean of the index beside the income that refers to that year."""
    joined = align.join_income(_annual_food(t, s, s.reference_years, 4), t.income, reference_shift=1)
    return joined.select(
        F.col("survey_year").alias("income_survey_year"),
        F.col("reference_year").alias("income_reference_year"),
        "geo",
        "avg_hicp_food_index",
        PPS,
    ).orderBy("geo", "income_survey_year")


def _reference_growth(t: Tables, s: Scope, income_growth: str) -> DataFrame:
    return _joined_growth(t, s, s.reference_years, 1, income_growth).select(
        F.col("survey_year").alias("income_survey_year"),
        F.col("reference_year").alias("income_reference_year"),
        "geo",
        "food_hicp_change_pct",
        income_growth,
    )


@statement
def growth_compare_ref_year(t: Tables, s: Scope) -> DataFrame:
    """Price and income growth, aligned on the reference year."""
    return _reference_growth(t, s, "income_change_pct").orderBy("geo", "income_survey_year")


def _gap_after_rounding(df: DataFrame, income_growth: str, out: str) -> DataFrame:
    return df.withColumn(out, F.round(F.col(income_growth) - F.col("food_hicp_change_pct"), 2))


@statement
def affordability_gap(t: Tables, s: Scope) -> DataFrame:
    """Rounded income growth minus rounded price growth, in percentage points."""
    growth = _reference_growth(t, s, "income_change_pct")
    return _gap_after_rounding(growth, "income_change_pct", "affordability_gap_pp").orderBy(
        "geo", "income_survey_year"
    )


@statement
def affordability_gap_nonnull(t: Tables, s: Scope) -> DataFrame:
    """The same, only where it could be calculated."""
    growth = _reference_growth(t, s, "income_pps_change_pct").drop("income_survey_year")
    name = "affordability_change_proxy_pp"
    return (
        _gap_after_rounding(growth, "income_pps_change_pct", name)
        .where(F.col(name).isNotNull())
        .orderBy("income_reference_year", "geo")
    )


@statement
def food_adjusted_income_growth(t: Tables, s: Scope) -> DataFrame:
    """Income growth net of food-price growth as a ratio, everything rounded last."""
    food = _index(t, s).where(F.col("geo").isin(*s.income_geos))
    prices = align.annual_mean(food, FOOD_KEY, "month", FOOD)
    return align.adjusted_growth(t.income, prices, price_key=FOOD_KEY).orderBy(
        "reference_year", "geo"
    )


# -- diesel -----------------------------------------------------------------------------


@statement
def diesel_latest(t: Tables, s: Scope) -> DataFrame:
    """Prices since the display date."""
    recent = t.diesel.where(_since("month", s.since_display))
    return recent.select("month", "geo", PRICE).orderBy("month", "geo")


def _diesel_change(t: Tables, s: Scope, n: int, previous: str, out: str) -> DataFrame:
    """Changes over all rows, then the display date: the lag must see the earlier months."""
    changed = pct_change(
        t.diesel, DIESEL_KEY, "month", PRICE, n, previous=previous, out=out, digits=2
    )
    return changed.where(_since("month", s.since_display))


@statement
def diesel_mom(t: Tables, s: Scope) -> DataFrame:
    """Month-over-month change of the price since the display date."""
    return (
        _diesel_change(t, s, 1, "previous_month_price", "mom_change_pct")
        .select("month", "geo", PRICE, "previous_month_price", "mom_change_pct")
        .orderBy("month", "geo")
    )


@statement
def diesel_yoy(t: Tables, s: Scope) -> DataFrame:
    """Year-over-year change of the price since the display date."""
    return (
        _diesel_change(t, s, YEAR, "previous_year_price", "yoy_change_pct")
        .select("month", "geo", PRICE, "previous_year_price", "yoy_change_pct")
        .orderBy("month", "geo")
    )


@statement
def diesel_yoy_labelled(t: Tables, s: Scope) -> DataFrame:
    """The same with the calendar month it is compared with."""
    changed = _diesel_change(t, s, YEAR, "previous_year_price", "yoy_change_pct")
    return (
        changed.withColumn("previous_year_month", years_earlier(F.col("month")))
        .select(
            "month", "geo", PRICE, "previous_year_month", "previous_year_price", "yoy_change_pct"
        )
        .orderBy("month", "geo")
    )


# -- diesel beside food -----------------------------------------------------------------


def _diesel_beside_food(
    t: Tables, s: Scope, since: str, lags: tuple[int, ...] = (), digits: int | None = None
) -> DataFrame:
    """Year-over-year rates of both on (month, geo); lags are taken before the join and the date."""
    members = F.col("geo").isin(*s.diesel_geos)
    diesel = pct_change(
        t.diesel.where(members), DIESEL_KEY, "month", PRICE, YEAR,
        out="diesel_yoy_pct", digits=digits,
    )
    names = {f"diesel_yoy_lag{n}": n for n in lags}
    diesel = add_lags(diesel, DIESEL_KEY, "month", "diesel_yoy_pct", names)
    food = _food_yoy(_index(t, s).where(members), digits, "food_hicp_yoy_pct")
    return (
        diesel.select("month", "geo", "diesel_yoy_pct", *names)
        .join(food.select("month", "geo", "food_hicp_yoy_pct"), ["month", "geo"])
        .where(_since("month", since))
    )


@statement
def diesel_vs_food_yoy(t: Tables, s: Scope) -> DataFrame:
    """Both rounded year-over-year rates since the display date."""
    return _diesel_beside_food(t, s, s.since_display, digits=2).orderBy("month", "geo")


@statement
def diesel_lags_vs_food(t: Tables, s: Scope) -> DataFrame:
    """The rounded diesel rate 0 to 3 rows back beside the food rate."""
    return _diesel_beside_food(t, s, s.since_display, (1, 2, 3), 2).orderBy("month", "geo")


@statement
def lag_correlation(t: Tables, s: Scope) -> DataFrame:
    """Correlation of the food rate with the diesel rate 0 to 3 rows back."""
    signals = {"diesel_yoy_pct": "correlation_lag0"}
    signals.update({f"diesel_yoy_lag{n}": f"correlation_lag{n}" for n in (1, 2, 3)})
    pairs = _diesel_beside_food(t, s, s.since_statistics, (1, 2, 3))
    return regime.lag_correlation(pairs, ["geo"], signals, "food_hicp_yoy_pct").orderBy("geo")


@statement
def lag_observation_counts(t: Tables, s: Scope) -> DataFrame:
    """Observations behind each of those correlations."""
    columns = {"diesel_yoy_pct": "lag0_observations"}
    columns.update({f"diesel_yoy_lag{n}": f"lag{n}_observations" for n in (1, 2, 3)})
    columns["food_hicp_yoy_pct"] = "food_yoy_observations"
    pairs = _diesel_beside_food(t, s, s.since_statistics, (1, 2, 3))
    return regime.observation_counts(pairs, ["geo"], columns).orderBy("geo")


@statement
def direction_regime(t: Tables, s: Scope) -> DataFrame:
    """Mean food rate while diesel is up, down or flat on the year before."""
    label = regime.direction(F.col("diesel_yoy_pct"), "diesel_up", "diesel_down", "diesel_flat")
    return regime.regime_summary(
        _diesel_beside_food(t, s, s.since_statistics),
        ["geo"],
        label,
        "food_hicp_yoy_pct",
        name="diesel_direction",
        out="avg_food_hicp_yoy_pct",
    ).orderBy("geo", "diesel_direction")


@statement
def direction_regime_lag3(t: Tables, s: Scope) -> DataFrame:
    """The same with the direction of diesel three rows earlier."""
    labels = [f"diesel_{way}_3m_earlier" for way in ("up", "down", "flat")]
    return regime.regime_summary(
        _diesel_beside_food(t, s, s.since_statistics, (3,)),
        ["geo"],
        regime.direction(F.col("diesel_yoy_lag3"), *labels),
        "food_hicp_yoy_pct",
        name="diesel_direction_lag3",
        out="avg_food_hicp_yoy_pct",
    ).orderBy("geo", "diesel_direction_lag3")


@statement
def direction_compare_lag3(t: Tables, s: Scope) -> DataFrame:
    """Up against down, three rows earlier, on one row per geography."""
    pairs = _diesel_beside_food(t, s, s.since_statistics, (3,))
    return regime.regime_compare(pairs, ["geo"], "diesel_yoy_lag3", "food_hicp_yoy_pct").orderBy(
        "geo"
    )


@statement
def lagged_timeseries(t: Tables, s: Scope) -> DataFrame:
    """The unrounded rates month by month."""
    return _diesel_beside_food(t, s, s.since_statistics, (3,)).orderBy("geo", "month")


# -- single series and table checks -----------------------------------------------------


@statement
def series_endpoints(t: Tables, s: Scope) -> DataFrame:
    """First and last index of the series."""
    return (
        compare.endpoints(
            _one_series(t, s), FOOD_KEY, "month", FOOD, "first_index", "last_index"
        )
        .select("geo", "coicop18", "first_index", "last_index")
        .orderBy("geo", "coicop18")
    )


@statement
def endpoint_change(t: Tables, s: Scope) -> DataFrame:
    """Absolute and percent change from the first to the last index."""
    columns = ["first_index", "last_index", "absolute_change", "percent_change"]
    return (
        compare.endpoint_change(
            _one_series(t, s), FOOD_KEY, "month", FOOD, "first_index", "last_index"
        )
        .select("geo", "coicop18", *columns)
        .orderBy("geo", "coicop18")
    )


@statement
def abs_monthly_change(t: Tables, s: Scope) -> DataFrame:
    """Absolute and percent monthly change of the series."""
    changed = pct_change(
        _one_series(t, s), FOOD_KEY, "month", FOOD,
        previous="previous_index", out="monthly_percent_change", digits=2,
    )
    absolute = F.col(FOOD) - F.col("previous_index")
    return (
        changed.withColumn("absolute_monthly_change", absolute)
        .select(
            "month",
            "geo",
            FOOD,
            "previous_index",
            "absolute_monthly_change",
            "monthly_percent_change",
        )
        .orderBy("geo", "month")
    )


@statement
def month_gap_check(t: Tables, s: Scope) -> DataFrame:
    """Months between each row of the series and the row before."""
    gaps = period_gaps(_one_series(t, s), FOOD_KEY)
    return gaps.select("month", "geo", "previous_month", "month_gap").orderBy("geo", "month")


@statement
def calendar_integrity(t: Tables, s: Scope) -> DataFrame:
    """Observed, distinct, expected and missing months of the series."""
    columns = ["observations", "distinct_months", "expected_months", "missing_months"]
    checked = quality.calendar_integrity(_one_series(t, s), FOOD_KEY)
    return checked.select("geo", *columns).orderBy("geo")


@statement
def series_profile(t: Tables, s: Scope) -> DataFrame:
    """Count, span, range and mean per geography and category."""
    profiled = quality.profile(t.food, ["geo", "coicop18"], "month", FOOD, "index")
    return profiled.orderBy("geo", "coicop18")


@statement
def series_profile_by_geo(t: Tables, s: Scope) -> DataFrame:
    """The same per geography."""
    return quality.profile(t.food, ["geo"], "month", FOOD, "index").orderBy("geo")


@statement
def series_span(t: Tables, s: Scope) -> DataFrame:
    """Rows, first and last month of the index table."""
    return quality.span(t.food, [], "month")


@statement
def series_span_by_geo(t: Tables, s: Scope) -> DataFrame:
    """Observations, first and last month per geography."""
    return quality.span(t.food, ["geo"], "month").orderBy("geo")


@statement
def diesel_span(t: Tables, s: Scope) -> DataFrame:
    """Rows, first and last month of the price table."""
    return quality.span(t.diesel, [], "month")


@statement
def share_span(t: Tables, s: Scope) -> DataFrame:
    """Rows, first and last year of the share table."""
    return quality.span(t.share, [], "year")


@statement
def share_duplicate_keys(t: Tables, s: Scope) -> DataFrame:
    """Keys of the share table that occur more than once."""
    return quality.duplicate_keys(t.share, ["year", "geo"])


@statement
def share_series(t: Tables, s: Scope) -> DataFrame:
    """Food share of one geography by year."""
    one = t.share.where(F.col("geo") == s.share_geo)
    return one.select("year", "food_expenditure_share_pct").orderBy("year")


@statement
def multi_geo_lag_listing(t: Tables, s: Scope) -> DataFrame:
    """Every index value beside the one before."""
    food = _index(t, s)
    previous = earlier(food, FOOD_KEY, "month", FOOD)
    return (
        food.withColumn("previous_index", previous)
        .select("month", "geo", FOOD, "previous_index")
        .orderBy("geo", "month")
    )


@statement
def yoy_single_series(t: Tables, s: Scope) -> DataFrame:
    """Year-over-year change of the series."""
    changed = _food_yoy(_one_series(t, s), 2, "yearly_percent_change")
    return changed.select(
        "month", "geo", FOOD, "previous_year_index", "yearly_percent_change"
    ).orderBy("geo", "month")


@statement
def food_preview(t: Tables, s: Scope) -> DataFrame:
    """The first five rows of the index table by month (ties by the rest of the key)."""
    return t.food.select(*FOOD_INDEX.key, FOOD).orderBy(*FOOD_INDEX.key).limit(5)


@statement
def food_tail(t: Tables, s: Scope) -> DataFrame:
    """The last five rows of the index table by month, newest first."""
    newest_first = [F.col(c).desc() for c in FOOD_INDEX.key]
    return t.food.select(*FOOD_INDEX.key, FOOD).orderBy(*newest_first).limit(5)


@statement
def adjusted_growth_by_year(t: Tables, s: Scope) -> DataFrame:
    """Adjusted income growth, one column per year of the scope's ``growth_years``, geographies in
    the stated order.  A reference year that is not listed raises."""
    growth = food_adjusted_income_growth(t, s)
    name = "food_adjusted_income_growth_pct"
    wide = pivot_panel(growth, ["geo"], "reference_year", list(s.growth_years), name)
    return in_order(wide, "geo", s.geo_order)
