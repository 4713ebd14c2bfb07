"""The registered queries as SQL over the driver's tables."""

from __future__ import annotations

ORDERS = """orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
ITEMS = """lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
ORDER_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"
SERIES = "WINDOW w AS (PARTITION BY geo ORDER BY month)"
SINCE = "DATE '1996-07-01'"
SAME = "WHERE year BETWEEN 1996 AND 1999"
MEMBERS = "('AFRICA', 'ASIA', 'EUROPE')"


def total(x: str) -> str:
    return f"CAST(sum(CAST(round({x} * 100) AS BIGINT)) AS DOUBLE)"


def mean(x: str) -> str:
    return f"{total(x)} / (count({x}) * 100)"


# DuckDB rounds small negative numbers to -0.0; "round(...) + 0" makes them 0.0.


def dec(x: str, precision: int = 10, scale: int = 4) -> str:
    """To DECIMAL by the shortest decimal form of the double, so that a half is rounded up
    (a direct cast rounds the binary value)."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL({precision},{scale}))"


def growth(now: str, base: str) -> str:
    return (
        f"(CAST({now} AS DOUBLE) - CAST({base} AS DOUBLE)) / nullif(CAST({base} AS DOUBLE), 0) * 100"
    )


def ratio(now: str, base: str) -> str:
    return f"(CAST({now} AS DOUBLE) / nullif(CAST({base} AS DOUBLE), 0) - 1) * 100"


def num(x: str, name: str | None = None) -> str:
    return f"CAST({x} AS DOUBLE) AS {name or x}"


def monthly(geo: str, condition: str = "true") -> str:
    return f"""SELECT {ORDER_MONTH} AS month, {geo} AS geo,
  {dec(mean("o_totalprice"))} AS v FROM {ORDERS} WHERE {condition} GROUP BY ALL"""


def weekly(geo: str) -> str:
    return f"""SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS day, {geo} AS geo,
  {dec(total("l_extendedprice") + " / (CAST(sum(l_quantity) AS BIGINT) * 100)")} AS v
  FROM {ITEMS} GROUP BY ALL"""


MEAN_OF_WEEKS = """SELECT CAST(date_trunc('month', day) AS DATE) AS month, geo,
  CAST(sum(v) AS DOUBLE) / count(v) AS v FROM week_prices GROUP BY ALL"""

HOUSEHOLD = "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN o_totalprice END"
HOUSEHOLD_SHARE = f"coalesce({total(HOUSEHOLD)}, 0) / {total('o_totalprice')} * 100"

CTES = {
    "food": monthly("r_name"),
    # The whole index table: two categories, one of them in two units.
    "index_table": f"""SELECT month, geo, coicop18, unit, 'M' AS freq,
  CAST(f.v + more AS DECIMAL(10,4)) AS v FROM food f,
  (VALUES ('CP01', 'I25', 0), ('CP02', 'I25', 1000), ('CP01', 'I15', 5000)) k(coicop18, unit, more)""",
    "nations": monthly("n_name"),
    "finished": monthly("n_name", "o_orderstatus = 'F'"),
    "week_prices": weekly("r_name"),
    "diesel": f"""SELECT month, geo, CASE WHEN geo = 'AFRICA' THEN
  CAST(floor({dec("v")} / 50) * 50 AS DECIMAL(10,4)) ELSE {dec("v")} END AS v
  FROM ({MEAN_OF_WEEKS})""",
    "income": f"""SELECT CAST(year(o_orderdate) AS INT) AS year, r_name AS geo,
  {dec(mean("c_acctbal"), 12, 2)} AS v FROM {ORDERS} GROUP BY ALL""",
    "share": f"""SELECT CAST(year(o_orderdate) AS INT) AS year, r_name AS geo,
  {dec(HOUSEHOLD_SHARE, 5, 2)} AS v FROM {ORDERS} GROUP BY ALL""",
    "rates": f"""SELECT month, geo, v, lag(v, 12) OVER w AS base,
  {growth("v", "lag(v, 12) OVER w")} AS pct FROM food {SERIES}""",
    "nation_rates": f"""SELECT month, geo, v, lag(v, 12) OVER w AS base,
  (round({growth("v", "lag(v, 12) OVER w")}, 2) + 0) AS pct FROM nations {SERIES}""",
    "nation_calendar": f"""SELECT a.month, a.geo, a.v, b.v AS base,
  (round({growth("a.v", "b.v")}, 2) + 0) AS pct FROM nations a LEFT JOIN nations b
  ON b.geo = a.geo AND b.month = CAST(a.month - INTERVAL 1 YEAR AS DATE)""",
    "diesel_rates": f"""SELECT month, geo, v, lag(v) OVER w AS last_v, lag(v, 12) OVER w AS base,
  {growth("v", "lag(v, 12) OVER w")} AS pct FROM diesel {SERIES}""",
    "lagged": f"""SELECT month, geo, pct AS d0, lag(pct) OVER w AS d1, lag(pct, 2) OVER w AS d2,
  lag(pct, 3) OVER w AS d3 FROM diesel_rates {SERIES}""",
    "pairs_all": f"""SELECT l.*, r.pct AS f FROM lagged l JOIN rates r USING (month, geo)
  WHERE geo IN {MEMBERS}""",
    "pairs": f"SELECT * FROM pairs_all WHERE month >= {SINCE}",
    "annual": """SELECT CAST(year(month) AS INT) AS year, geo, CAST(sum(v) AS DOUBLE) / count(v) AS v,
  count(*) AS n FROM food GROUP BY ALL""",
    "by_reference": """SELECT i.year AS survey, i.year - 1 AS ref, i.geo, a.v AS price, i.v AS pps
  FROM income i JOIN annual a ON a.geo = i.geo AND a.year = i.year - 1
  WHERE a.year BETWEEN 1995 AND 1998""",
    "reference_growth": f"""SELECT survey, ref, geo,
  (round({ratio("price", "lag(price) OVER y")}, 2) + 0) AS food_pct,
  (round({ratio("pps", "lag(pps) OVER y")}, 2) + 0) AS income_pct
  FROM by_reference WINDOW y AS (PARTITION BY geo ORDER BY survey)""",
    "adjusted": f"""SELECT i.ref AS reference_year, i.geo, i.pct AS ip, p.pct AS fp FROM
  (SELECT year - 1 AS ref, geo, {growth("v", "lag(v) OVER y")} AS pct FROM income
   WINDOW y AS (PARTITION BY geo ORDER BY year)) i JOIN
  (SELECT year, geo, {growth("v", "lag(v) OVER y")} AS pct FROM annual
   WINDOW y AS (PARTITION BY geo ORDER BY year)) p ON p.year = i.ref AND p.geo = i.geo
  WHERE i.pct IS NOT NULL AND i.geo IN {MEMBERS}""",
    "share_twice": """SELECT * FROM share UNION ALL
  SELECT * FROM share WHERE geo = 'ASIA' AND year = 1996""",
    "region_span": """SELECT r_name AS document, min(month) AS lo, max(month) AS hi FROM nations
  JOIN nation ON geo = n_name JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "cells": """SELECT r_name AS document, geo, month, CAST(v AS DOUBLE) AS value FROM nations
  JOIN nation ON geo = n_name JOIN region ON n_regionkey = r_regionkey""",
}
USES = {
    "index_table": ["food"],
    "share_twice": ["share"],
    "diesel": ["week_prices"],
    "rates": ["food"],
    "nation_rates": ["nations"],
    "nation_calendar": ["nations"],
    "diesel_rates": ["diesel"],
    "lagged": ["diesel_rates"],
    "pairs_all": ["lagged", "rates"],
    "pairs": ["pairs_all"],
    "annual": ["food"],
    "by_reference": ["income", "annual"],
    "reference_growth": ["by_reference"],
    "adjusted": ["income", "annual"],
    "region_span": ["nations"],
    "cells": ["nations"],
}


def query(body: str, *ctes: str) -> str:
    """The body after the CTEs it names and those they use, each once."""
    needed: list[str] = []

    def add(name: str) -> None:
        for inner in USES.get(name, []):
            add(inner)
        if name not in needed:
            needed.append(name)

    for name in ctes:
        add(name)
    clauses = ",\n".join(f"{name} AS MATERIALIZED (\n  {CTES[name]})" for name in needed)
    return f"WITH {clauses}\n{body}" if clauses else body


def correlation(x: str, y: str = "f") -> str:
    return (
        f"(round((avg({x} * {y}) - avg({x}) * avg({y}))"
        f" / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 3) + 0)"
    )


def pairwise(x: str) -> str:
    return correlation(f"CASE WHEN f IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN f END")


def regimes(signal: str, up: str, down: str, flat: str, name: str, out: str, source: str) -> str:
    return f"""SELECT geo, CASE WHEN {signal} > 0 THEN '{up}' WHEN {signal} < 0 THEN '{down}'
  ELSE '{flat}' END AS {name}, count(*) AS observations, (round(avg(f), 2) + 0) AS {out}
FROM {source} GROUP BY ALL"""


def extremes(source: str, out: str) -> str:
    return f"""SELECT month, geo, pct AS {out},
  CASE WHEN top = 1 THEN 'Highest' ELSE 'Lowest' END AS change_type FROM (
  SELECT month, geo, pct,
    row_number() OVER (PARTITION BY geo ORDER BY pct DESC NULLS LAST, month) AS top,
    row_number() OVER (PARTITION BY geo ORDER BY pct ASC NULLS FIRST, month) AS bottom
  FROM (SELECT month, geo, (round(pct, 2) + 0) AS pct FROM {source} WHERE base IS NOT NULL))
WHERE top = 1 OR bottom = 1"""


def spans(source: str, period: str, by: str = "") -> str:
    return f"""SELECT {by + ", " if by else ""}count(*) AS observations, min({period}) AS first_{period},
  max({period}) AS last_{period} FROM {source} {"GROUP BY " + by if by else ""}"""


def profile(by: str) -> str:
    return f"""SELECT {by}, count(*) AS observations, min(month) AS first_month,
  max(month) AS last_month, {num("min(v)", "min_index")}, {num("max(v)", "max_index")},
  CAST(sum(v) AS DOUBLE) / count(v) AS avg_index FROM index_table GROUP BY {by}"""


def integrity(source: str) -> str:
    expected = "date_diff('month', min(month), max(month)) + 1"
    return f"""SELECT geo, count(*) AS observations, count(DISTINCT month) AS distinct_months,
  CAST({expected} AS INT) AS expected_months, {expected} - count(DISTINCT month) AS missing_months
FROM {source} GROUP BY geo"""


INDEX = num("v", "hicp_index")
PRICE = num("v", "diesel_price_per_1000l")
COVERAGE = """SELECT CAST(year(month) AS INT) AS year, geo, count(*) AS months_available
FROM {0} GROUP BY ALL"""

STATEMENTS = {
    "mom_change": query(
        f"""SELECT month, geo, {INDEX}, {num("lag(v) OVER w", "previous_index")},
  (round({growth("v", "lag(v) OVER w")}, 2) + 0) AS mom_change_pct FROM food {SERIES}""",
        "food",
    ),
    "yoy_change": query(
        f"""SELECT month, geo, {INDEX}, {num("base", "previous_year_index")},
  (round(pct, 2) + 0) AS yoy_change_pct FROM rates""",
        "rates",
    ),
    "yoy_gap_vs_benchmark": query(
        """SELECT m.month, m.geo, (round(m.pct, 2) + 0) AS yoy_change_pct,
  (round(b.pct, 2) + 0) AS eu27_yoy_change_pct,
  (round((round(m.pct, 2) + 0) - (round(b.pct, 2) + 0), 2) + 0) AS gap_vs_eu27_pp
FROM rates m JOIN rates b ON b.month = m.month AND b.geo = 'EUROPE'
WHERE m.geo <> 'EUROPE' AND m.base IS NOT NULL AND b.base IS NOT NULL""",
        "rates",
    ),
    "yoy_extremes": query(extremes("rates", "yoy_change_pct"), "rates"),
    "yoy_summary": query(
        """SELECT geo, (round(avg(pct), 2) + 0) AS avg_yoy_pct, (round(min(pct), 2) + 0) AS min_yoy_pct,
  (round(max(pct), 2) + 0) AS max_yoy_pct, (round(stddev_pop(pct), 2) + 0) AS yoy_volatility
FROM rates WHERE base IS NOT NULL GROUP BY geo""",
        "rates",
    ),
    "income_listing": query(f"SELECT year, geo, {num('v', 'income_pps')} FROM income", "income"),
    "income_change": query(
        f"""SELECT year, geo, {num("v", "income_pps")},
  {num("v - lag(v) OVER y", "change_pps")},
  (round({ratio("v", "lag(v) OVER y")}, 2) + 0) AS income_change_pct
FROM income WINDOW y AS (PARTITION BY geo ORDER BY year)""",
        "income",
    ),
    "month_coverage": query(COVERAGE.format("food"), "food"),
    "annual_average": query(
        f"SELECT year, geo, {num(dec('v'), 'avg_hicp_food_index')} FROM annual {SAME}", "annual"
    ),
    "annual_join_income": query(
        f"""SELECT year, geo, {num(dec("a.v"), "avg_hicp_food_index")}, {num("i.v", "income_pps")}
FROM annual a JOIN income i USING (year, geo) {SAME}""",
        "annual",
        "income",
    ),
    "growth_compare_same_year": query(
        f"""SELECT year, geo, (round({ratio("a.v", "lag(a.v) OVER y")}, 2) + 0) AS food_hicp_change_pct,
  (round({ratio("i.v", "lag(i.v) OVER y")}, 2) + 0) AS income_change_pct
FROM annual a JOIN income i USING (year, geo) {SAME} WINDOW y AS (PARTITION BY geo ORDER BY year)""",
        "annual",
        "income",
    ),
    "annual_join_income_ref_year": query(
        f"""SELECT survey AS income_survey_year, ref AS income_reference_year, geo,
  {num(dec("price"), "avg_hicp_food_index")}, {num("pps", "income_pps")} FROM by_reference""",
        "by_reference",
    ),
    "growth_compare_ref_year": query(
        """SELECT survey AS income_survey_year, ref AS income_reference_year, geo,
  food_pct AS food_hicp_change_pct, income_pct AS income_change_pct FROM reference_growth""",
        "reference_growth",
    ),
    "affordability_gap": query(
        """SELECT survey AS income_survey_year, ref AS income_reference_year, geo,
  food_pct AS food_hicp_change_pct, income_pct AS income_change_pct,
  (round(income_pct - food_pct, 2) + 0) AS affordability_gap_pp FROM reference_growth""",
        "reference_growth",
    ),
    "affordability_gap_nonnull": query(
        """SELECT ref AS income_reference_year, geo, food_pct AS food_hicp_change_pct,
  income_pct AS income_pps_change_pct, (round(income_pct - food_pct, 2) + 0) AS affordability_change_proxy_pp
FROM reference_growth WHERE income_pct - food_pct IS NOT NULL""",
        "reference_growth",
    ),
    "food_adjusted_income_growth": query(
        """SELECT reference_year, geo, (round(ip, 2) + 0) AS income_growth_pct,
  (round(fp, 2) + 0) AS food_hicp_growth_pct, (round(ip - fp, 2) + 0) AS simple_difference_pp,
  (round(((1 + ip / 100) / nullif(1 + fp / 100, 0) - 1) * 100, 2) + 0) AS food_adjusted_income_growth_pct
FROM adjusted""",
        "adjusted",
    ),
    "diesel_latest": query(f"SELECT month, geo, {PRICE} FROM diesel WHERE month >= {SINCE}", "diesel"),
    "diesel_mom": query(
        f"""SELECT month, geo, {PRICE}, {num("last_v", "previous_month_price")},
  (round({growth("v", "last_v")}, 2) + 0) AS mom_change_pct FROM diesel_rates WHERE month >= {SINCE}""",
        "diesel_rates",
    ),
    "diesel_yoy": query(
        f"""SELECT month, geo, {PRICE}, {num("base", "previous_year_price")},
  (round(pct, 2) + 0) AS yoy_change_pct FROM diesel_rates WHERE month >= {SINCE}""",
        "diesel_rates",
    ),
    "diesel_yoy_labelled": query(
        f"""SELECT month, geo, {PRICE}, CAST(month - INTERVAL 1 YEAR AS DATE) AS previous_year_month,
  {num("base", "previous_year_price")}, (round(pct, 2) + 0) AS yoy_change_pct
FROM diesel_rates WHERE month >= {SINCE}""",
        "diesel_rates",
    ),
    "diesel_vs_food_yoy": query(
        """SELECT month, geo, (round(d0, 2) + 0) AS diesel_yoy_pct, (round(f, 2) + 0) AS food_hicp_yoy_pct
FROM pairs""",
        "pairs",
    ),
    "diesel_lags_vs_food": query(
        """SELECT month, geo, (round(d0, 2) + 0) AS diesel_yoy_pct, (round(d1, 2) + 0) AS diesel_yoy_lag1,
  (round(d2, 2) + 0) AS diesel_yoy_lag2, (round(d3, 2) + 0) AS diesel_yoy_lag3,
  (round(f, 2) + 0) AS food_hicp_yoy_pct FROM pairs""",
        "pairs",
    ),
    "lag_correlation": query(
        "SELECT geo, "
        + ", ".join(f"{correlation(f'd{n}')} AS correlation_lag{n}" for n in range(4))
        + " FROM pairs GROUP BY geo",
        "pairs",
    ),
    "lag_observation_counts": query(
        "SELECT geo, count(*) AS total_rows, "
        + ", ".join(f"count(d{n}) AS lag{n}_observations" for n in range(4))
        + ", count(f) AS food_yoy_observations FROM pairs GROUP BY geo",
        "pairs",
    ),
    "direction_regime": query(
        regimes(
            "d0", "diesel_up", "diesel_down", "diesel_flat",
            "diesel_direction", "avg_food_hicp_yoy_pct", "pairs",
        ),
        "pairs",
    ),
    "direction_regime_lag3": query(
        regimes(
            "d3", "diesel_up_3m_earlier", "diesel_down_3m_earlier", "diesel_flat_3m_earlier",
            "diesel_direction_lag3", "avg_food_hicp_yoy_pct", "pairs",
        ),
        "pairs",
    ),
    "direction_compare_lag3": query(
        """SELECT geo, count(*) FILTER (d3 > 0) AS diesel_up_observations,
  count(*) FILTER (d3 < 0) AS diesel_down_observations,
  (round(avg(f) FILTER (d3 > 0), 2) + 0) AS avg_food_when_diesel_up,
  (round(avg(f) FILTER (d3 < 0), 2) + 0) AS avg_food_when_diesel_down,
  (round(avg(f) FILTER (d3 > 0) - avg(f) FILTER (d3 < 0), 2) + 0) AS difference_pp
FROM pairs GROUP BY geo""",
        "pairs",
    ),
    "lagged_timeseries": query(
        """SELECT month, geo, d0 AS diesel_yoy_pct, d3 AS diesel_yoy_lag3, f AS food_hicp_yoy_pct
FROM pairs""",
        "pairs",
    ),
    "series_endpoints": query(
        f"""SELECT geo, 'CP01' AS coicop18, {num("arg_min(v, month)", "first_index")},
  {num("arg_max(v, month)", "last_index")} FROM food WHERE geo = 'ASIA' GROUP BY geo""",
        "food",
    ),
    "endpoint_change": query(
        f"""SELECT geo, 'CP01' AS coicop18, {num("a", "first_index")}, {num("b", "last_index")},
  {num("b - a", "absolute_change")}, (round({growth("b", "a")}, 2) + 0) AS percent_change
FROM (SELECT geo, arg_min(v, month) AS a, arg_max(v, month) AS b FROM food WHERE geo = 'ASIA' GROUP BY geo)""",
        "food",
    ),
    "abs_monthly_change": query(
        f"""SELECT month, geo, {INDEX}, {num("lag(v) OVER w", "previous_index")},
  {num("v - lag(v) OVER w", "absolute_monthly_change")},
  (round({growth("v", "lag(v) OVER w")}, 2) + 0) AS monthly_percent_change FROM food WHERE geo = 'ASIA' {SERIES}""",
        "food",
    ),
    "month_gap_check": query(
        f"""SELECT month, geo, lag(month) OVER w AS previous_month,
  CAST(date_diff('month', lag(month) OVER w, month) AS INT) AS month_gap FROM food WHERE geo = 'ASIA' {SERIES}""",
        "food",
    ),
    "calendar_integrity": query(integrity("food WHERE geo = 'ASIA'"), "food"),
    "series_profile": query(profile("geo, coicop18"), "index_table"),
    "series_profile_by_geo": query(profile("geo"), "index_table"),
    "series_span": query(spans("index_table", "month"), "index_table"),
    "series_span_by_geo": query(spans("index_table", "month", "geo"), "index_table"),
    "diesel_span": query(spans("diesel", "month"), "diesel"),
    "share_span": query(spans("share_twice", "year"), "share_twice"),
    "share_duplicate_keys": query(
        "SELECT year, geo, count(*) AS row_count FROM share_twice GROUP BY ALL HAVING count(*) > 1",
        "share_twice",
    ),
    "share_series": query(
        f"SELECT year, {num('v', 'food_expenditure_share_pct')} FROM share WHERE geo = 'EUROPE'",
        "share",
    ),
    "multi_geo_lag_listing": query(
        f"SELECT month, geo, {INDEX}, {num('lag(v) OVER w', 'previous_index')} FROM food {SERIES}",
        "food",
    ),
    "yoy_single_series": query(
        f"""SELECT month, geo, {INDEX}, {num("base", "previous_year_index")},
  (round(pct, 2) + 0) AS yearly_percent_change FROM rates WHERE geo = 'ASIA'""",
        "rates",
    ),
    "food_preview": query(
        f"""SELECT month, geo, coicop18, unit, freq, {INDEX}
FROM index_table ORDER BY month, geo, coicop18, unit, freq LIMIT 5""",
        "index_table",
    ),
    "food_tail": query(
        f"""SELECT month, geo, coicop18, unit, freq, {INDEX}
FROM index_table ORDER BY month DESC, geo DESC, coicop18 DESC, unit DESC, freq DESC LIMIT 5""",
        "index_table",
    ),
    "adjusted_growth_by_year": query(
        "SELECT geo, "
        + ", ".join(
            f"""max((round(((1 + ip / 100) / nullif(1 + fp / 100, 0) - 1) * 100, 2) + 0))
  FILTER (reference_year = {y}) AS "{y}\""""
            for y in range(1995, 2002)
        )
        + " FROM adjusted GROUP BY geo",
        "adjusted",
    ),
}

YEARS = range(1995, 2002)
NATION_MONTHS = """SELECT geo, month, {num} FROM (SELECT g.geo, CAST(unnest(generate_series(
    g.lo, g.hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM ({span}) g)
LEFT JOIN nations USING (geo, month)"""
YOY_COLUMNS = f"month, geo, {num('v', 'value')}, {num('base', 'previous_value')}, pct AS yoy_pct"
LISTED = ["EUROPE", "ASIA", "ATLANTIS", "AFRICA", "AMERICA", "MIDDLE EAST"]

# Cells with their offset in the cube of their region.
OFFSETS = """SELECT c.*, (dense_rank() OVER (PARTITION BY c.document ORDER BY c.geo) - 1)
    * (date_diff('month', lo, hi) + 1) + date_diff('month', lo, month) AS place
  FROM cells c JOIN region_span s ON s.document = c.document"""

OPERATORS = {
    "pivot_panel": query(
        "SELECT geo, "
        + ", ".join(num(f"max(v) FILTER (year = {y})", f"y{y}") for y in YEARS)
        + " FROM income GROUP BY geo",
        "income",
    ),
    "unpivot_panel": query(
        f"""SELECT d.day AS date, r_name AS geo, {num("v", "price")}
FROM (SELECT DISTINCT day FROM week_prices) d CROSS JOIN region
LEFT JOIN week_prices p ON p.day = d.day AND p.geo = r_name""",
        "week_prices",
    ),
    "resample_monthly": f"""WITH week_prices AS ({weekly("n_name")})
{MEAN_OF_WEEKS.replace("AS v FROM", "AS price FROM")}""",
    "resample_monthly_spine": query(
        NATION_MONTHS.format(
            num=num("v", "value"),
            span=f"""SELECT DISTINCT geo, (SELECT min({ORDER_MONTH}) FROM orders) AS lo,
    (SELECT max({ORDER_MONTH}) FROM orders) AS hi FROM nations""",
        ),
        "nations",
    ),
    "fill_months_by_series": query(
        NATION_MONTHS.format(
            num=num("v", "value"),
            span="SELECT geo, min(month) AS lo, max(month) AS hi FROM nations GROUP BY geo",
        ),
        "nations",
    ),
    "custom_order": query(
        f"""SELECT year, l.geo, {num("v", "income_pps")}
FROM (SELECT unnest({LISTED}) AS geo) l LEFT JOIN income i ON i.geo = l.geo""",
        "income",
    ),
    "distinct_geos": query("SELECT DISTINCT geo FROM food", "food"),
    "positional_yoy": query(f"SELECT {YOY_COLUMNS} FROM nation_rates", "nation_rates"),
    "calendar_yoy": query(f"SELECT {YOY_COLUMNS} FROM nation_calendar", "nation_calendar"),
    "calendar_lags": query(
        f"SELECT n.month, n.geo, {num('n.v', 'value')}, "
        + ", ".join(num(f"p{k}.v", f"lag{k}") for k in (1, 2, 3))
        + " FROM nations n"
        + "".join(
            f"""
LEFT JOIN nations p{k} ON p{k}.geo = n.geo AND p{k}.month = CAST(n.month - INTERVAL {k} MONTH AS DATE)"""
            for k in (1, 2, 3)
        ),
        "nations",
    ),
    "last_n_periods": query(
        f"""SELECT month, geo, {num("v", "value")} FROM nations
QUALIFY dense_rank() OVER (PARTITION BY geo ORDER BY month DESC) <= 24""",
        "nations",
    ),
    "nation_extremes": query(extremes("nation_rates", "yoy_pct"), "nation_rates"),
    "gap_within_segment": f"""WITH p AS (SELECT {ORDER_MONTH} AS month, r_name AS geo,
  c_mktsegment AS segment, {dec(mean("o_totalprice"))} AS v
  FROM {ORDERS} GROUP BY ALL),
r AS (SELECT month, geo, segment, (round({growth("v", "lag(v, 12) OVER w")}, 2) + 0) AS pct,
  lag(v, 12) OVER w AS base FROM p WINDOW w AS (PARTITION BY geo, segment ORDER BY month))
SELECT month, segment, m.geo, m.pct AS yoy_pct, b.pct AS benchmark_value,
  (round(m.pct - b.pct, 2) + 0) AS gap_pp
FROM (SELECT * FROM r WHERE base IS NOT NULL AND geo <> 'EUROPE') m
JOIN (SELECT * FROM r WHERE base IS NOT NULL AND geo = 'EUROPE') b USING (month, segment)""",
    "lag_correlation_pairwise": query(
        f"""SELECT geo, {pairwise("d0")} AS correlation_lag0, {pairwise("d3")} AS correlation_lag3
FROM pairs_all GROUP BY geo""",
        "pairs_all",
    ),
    "lag_correlation_moments": query(
        f"""SELECT geo, {correlation("d0")} AS correlation_lag0, {correlation("d3")} AS correlation_lag3
FROM pairs_all GROUP BY geo""",
        "pairs_all",
    ),
    "direction_regime_missing": query(
        regimes("d3", "up", "down", "flat", "direction", "avg_food_yoy_pct", "pairs_all").replace(
            "ELSE", "WHEN d3 IS NULL THEN 'unknown' ELSE"
        ),
        "pairs_all",
    ),
    "direction_regime_all_months": query(
        regimes(
            "d3", "diesel_up_3m_earlier", "diesel_down_3m_earlier", "diesel_flat_3m_earlier",
            "diesel_direction_lag3", "avg_food_hicp_yoy_pct", "pairs_all",
        ),
        "pairs_all",
    ),
    "annual_complete_years": query(
        f"""SELECT year, geo, coicop18, unit, {num(dec("CAST(sum(v) AS DOUBLE) / count(v)"), "annual_mean")}
FROM (SELECT *, CAST(year(month) AS INT) AS year FROM index_table)
GROUP BY year, geo, coicop18, unit HAVING count(*) >= 12""",
        "index_table",
    ),
    "upsert_last_write_wins": """SELECT c_custkey AS custkey,
  coalesce(last_price, c_acctbal) AS amount FROM customer LEFT JOIN
  (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS last_price FROM orders GROUP BY o_custkey)
  ON o_custkey = c_custkey""",
    "key_breaches_by_category": """SELECT c_nationkey AS year, c_mktsegment AS geo,
  count(*) AS row_count FROM customer GROUP BY ALL HAVING count(*) > 1""",
    "rule_breaches": """SELECT count(*) AS month_is_null, count(*) - count(o_orderpriority) AS geo_is_null,
  count(*) - count(o_orderpriority) AS coicop18_is_null, count(*) - count(o_orderstatus) AS unit_is_null,
  count(*) - count(o_orderstatus) AS freq_is_null,
  count(*) FILTER (try_cast(left(o_orderpriority, 1) AS DOUBLE) IS NULL) AS hicp_index_is_null,
  count(*) FILTER (length(trim(o_orderpriority)) > 16) AS geo_longer_than_16,
  count(*) FILTER (length(trim(o_orderpriority || o_orderpriority)) > 16) AS coicop18_longer_than_16,
  count(*) FILTER (length(o_orderstatus) > 10) AS unit_longer_than_10,
  count(*) FILTER (length(o_orderstatus) > 1) AS freq_longer_than_1 FROM orders""",
    "lenient_parse": """SELECT o_orderpriority, count(*) AS observations,
  count(*) FILTER (o_orderkey % 7 <> 6) AS dates,
  max(CAST(o_orderdate AS DATE)) FILTER (o_orderkey % 7 <> 6) AS last_day,
  count(*) FILTER (o_orderstatus <> 'O' AND o_orderkey % 7 <> 3) AS numbers,
  max((round(o_totalprice, 2) + 0)) FILTER (o_orderstatus <> 'O' AND o_orderkey % 7 <> 3) AS max_amount
FROM orders GROUP BY o_orderpriority""",
    "drop_missing": query(
        f"SELECT {YOY_COLUMNS} FROM nation_calendar WHERE pct IS NOT NULL", "nation_calendar"
    ),
    "missing_by_column": query(
        """SELECT count(*) - count(month) AS month, count(*) - count(geo) AS geo, count(*) - count(v) AS value,
  count(*) - count(base) AS previous_value, count(*) - count(pct) AS yoy_pct FROM nation_calendar""",
        "nation_calendar",
    ),
    "observed_counts": query(
        """SELECT geo, count(*) AS observations, count(pct) AS non_null_values,
  count(*) - count(pct) AS missing_values FROM nation_calendar GROUP BY geo""",
        "nation_calendar",
    ),
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_count": """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber
  FROM lineitem)) AS duplicate_rows FROM lineitem""",
    "month_gaps": query(
        f"""SELECT geo, month, previous_month, month_gap FROM (
  SELECT geo, month, lag(month) OVER w AS previous_month,
    CAST(date_diff('month', lag(month) OVER w, month) AS INT) AS month_gap FROM nations {SERIES})
WHERE month_gap <> 1""",
        "nations",
    ),
    "nation_calendar_integrity": query(integrity("nations"), "nations"),
    "nation_month_coverage": query(COVERAGE.format("nations"), "nations"),
    "valid_range": query(
        """SELECT geo, count(pct) AS observations, min(month) FILTER (pct IS NOT NULL) AS first_month,
  max(month) FILTER (pct IS NOT NULL) AS last_month FROM nation_rates GROUP BY geo""",
        "nation_rates",
    ),
    "value_range": query(
        f"SELECT geo, {num('min(v)', 'min_value')}, {num('max(v)', 'max_value')} FROM share GROUP BY geo",
        "share",
    ),
    "missing_periods": query(
        "SELECT geo, month FROM nation_calendar WHERE pct IS NULL", "nation_calendar"
    ),
    "reconcile_sources": query(
        f"""SELECT geo, month, {num("a.v", "value_left")}, {num("b.v", "value_right")},
  (round(CAST(a.v AS DOUBLE) - CAST(b.v AS DOUBLE), 4) + 0) AS difference,
  CASE WHEN b.v IS NULL THEN 'only_left' WHEN a.v IS NULL THEN 'only_right'
    WHEN a.v = b.v THEN 'match' ELSE 'differ' END AS status
FROM nations a FULL JOIN finished b USING (geo, month)""",
        "nations",
        "finished",
    ),
    "merge_sources": query(
        f"""SELECT geo, month, {num("a.v", "value_api")}, {num("b.v", "value_db")},
  (round(CAST(a.v AS DOUBLE) - CAST(b.v AS DOUBLE), 4) + 0) AS difference
FROM nations a JOIN finished b USING (geo, month)""",
        "nations",
        "finished",
    ),
    "frames_equal": f"""WITH o AS (SELECT DISTINCT n_name AS geo, {ORDER_MONTH} AS month FROM {ORDERS}),
s AS (SELECT DISTINCT n_name AS geo, CAST(date_trunc('month', l_shipdate) AS DATE) AS month
  FROM {ITEMS}),
c AS (SELECT (SELECT count(*) FROM (SELECT * FROM o EXCEPT SELECT * FROM s)) AS only_left,
  (SELECT count(*) FROM (SELECT * FROM s EXCEPT SELECT * FROM o)) AS only_right)
SELECT only_left, only_right, only_left = 0 AND only_right = 0 AS equal FROM c""",
    "row_count": spans("orders", "o_orderdate"),
    "cube_decode": query("SELECT document, geo, month, value FROM cells", "cells"),
    "cube_decode_with_missing": query(
        """SELECT document, n.geo, s.month, value FROM
  (SELECT document, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
   FROM region_span) s
JOIN (SELECT DISTINCT document, geo FROM cells) n USING (document)
LEFT JOIN cells c USING (document, geo, month)""",
        "region_span",
        "cells",
    ),
    "cube_labels": query(
        """SELECT 'M' AS freq, 'I25' AS unit, geo, 'Nation ' || split_part(geo, '_', 2) AS country,
  strftime(month, '%Y-%m') AS time, value FROM cells
WHERE CAST(split_part(geo, '_', 2) AS INT) % 3 = 0""",
        "cells",
    ),
    "cube_metadata": query(
        """SELECT document, 'Order value in ' || document AS dataset_label, dim, dim_label,
  CAST(dim_position AS INT) AS dim_position, CAST(dim_size AS INT) AS dim_size, code, label,
  CAST(position AS INT) AS position FROM (
  SELECT document, 'freq' AS dim, 'Frequency' AS dim_label, 0 AS dim_position, 1 AS dim_size,
    'M' AS code, 'Monthly' AS label, 0 AS position FROM region_span
  UNION ALL SELECT document, 'unit', 'Unit', 2, 1, 'I25', 'Index', 0 FROM region_span
  UNION ALL SELECT document, 'geo', 'Geography', 1, count(*) OVER (PARTITION BY document), geo,
    'Nation ' || split_part(geo, '_', 2), row_number() OVER (PARTITION BY document ORDER BY geo) - 1
    FROM (SELECT DISTINCT document, geo FROM cells)
  UNION ALL SELECT document, 'time', 'Time', 3, count(*) OVER (PARTITION BY document),
    strftime(month, '%Y-%m'), strftime(month, '%Y-%m'),
    row_number() OVER (PARTITION BY document ORDER BY month) - 1
    FROM (SELECT document, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS month FROM region_span))""",
        "region_span",
        "cells",
    ),
    "cube_last_periods": query(
        """SELECT document, geo, month, value FROM cells
QUALIFY dense_rank() OVER (PARTITION BY document, geo ORDER BY month DESC) <= 24""",
        "cells",
    ),
    "cube_last_positions": query(
        """SELECT document, geo, month, value FROM cells JOIN region_span USING (document)
WHERE date_diff('month', month, hi) < 24""",
        "region_span",
        "cells",
    ),
    "cube_strict": query(
        """SELECT geo, CAST(year AS VARCHAR) AS time, '2024-01' AS arrived, CAST(v AS DOUBLE) AS value FROM income
UNION ALL SELECT geo, CAST(year AS VARCHAR), '2024-02', CAST(v + 1 AS DOUBLE) FROM income WHERE year % 2 = 0""",
        "income",
    ),
    "grid_columns": query(
        f"""SELECT d.day AS date, r_name AS geo, {num("v", "price")}
FROM (SELECT DISTINCT day FROM week_prices) d CROSS JOIN region
LEFT JOIN week_prices p ON p.day = d.day AND p.geo = r_name""",
        "week_prices",
    ),
    "grid_file": query(
        f"""SELECT d.day AS date, r_name AS geo, {num("v", "price")}
FROM (SELECT DISTINCT day FROM week_prices) d CROSS JOIN region
LEFT JOIN week_prices p ON p.day = d.day AND p.geo = r_name""",
        "week_prices",
    ),
    "grid_columns_monthly": query(
        f"""SELECT geo, month, {num(dec("v"), "price")} FROM (SELECT r_name AS geo,
  CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM region,
  (SELECT date_trunc('month', date_trunc('week', min(l_shipdate))) AS lo,
    date_trunc('month', date_trunc('week', max(l_shipdate))) AS hi FROM lineitem))
LEFT JOIN ({MEAN_OF_WEEKS}) USING (geo, month)""",
        "week_prices",
    ),
    "grid_transpose": query(
        f"""SELECT geo, CAST(row_number() OVER (PARTITION BY geo ORDER BY year) AS INT) AS column,
  year, {num("v", "share_pct")} FROM share""",
        "share",
    ),
    "grid_shape": query(
        """SELECT geo AS sheet, CAST(47 AS BIGINT) AS rows, CAST(count(*) + 1 AS INT) AS columns
FROM share GROUP BY geo""",
        "share",
    ),
    "grid_header_mismatches": """SELECT 'weekly' AS sheet, CAST(0 AS BIGINT) AS row,
  CAST(6 AS INT) AS column, 'ASIA' AS expected, 'AMERICA' AS found
UNION ALL SELECT 'weekly', 1, 9, 'EUROPE', 'ASIA'""",
    "cube_decode_dirty": query(
        f"SELECT document, geo, month, value FROM ({OFFSETS}) WHERE place % 3 <> 0", "region_span", "cells"
    ),
    "cube_marks": query(
        f"""SELECT document, ':' AS mark, count(*) AS cells FROM ({OFFSETS})
WHERE place % 3 = 0 GROUP BY document""",
        "region_span",
        "cells",
    ),
    "food_index_rows": query(
        f"""SELECT month, geo, 'CP01' AS coicop18, 'I25' AS unit, 'M' AS freq, {INDEX} FROM food
WHERE geo IN {MEMBERS} AND month BETWEEN DATE '1996-01-01' AND DATE '2000-06-01'""",
        "food",
    ),
    "income_rows": query(
        f"""SELECT year, geo, CAST(v + (CASE WHEN year % 2 = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS income_pps
FROM income WHERE geo IN {MEMBERS} AND year BETWEEN 1996 AND 2000""",
        "income",
    ),
    "food_share_rows": query(
        """SELECT year, geo, CASE WHEN year = max(year) OVER () THEN CAST(v AS DOUBLE) ELSE 50.25 END
  AS food_expenditure_share_pct FROM share WHERE geo = 'ASIA'""",
        "share",
    ),
    "diesel_revisions": query(
        f"""SELECT CAST(date_trunc('month', day) AS DATE) AS month, geo,
  {num(dec("CAST(sum(w) AS DOUBLE) / count(w)"), "diesel_price_per_1000l")} FROM (
  SELECT day, geo, CASE WHEN (date_diff('day', DATE '1990-01-01', day) // 7 + 3) % 2 = 0
    THEN 1000.0000 ELSE v END AS w FROM week_prices WHERE day >= DATE '1996-01-01')
GROUP BY ALL""",
        "week_prices",
    ),
    "merge_by_arrival": """SELECT custkey, m.amount, m.arrived FROM (
  SELECT custkey, arg_max({amount: amount, arrived: arrived}, (arrived, side, o_orderkey)) AS m FROM (
    SELECT c_custkey AS custkey, c_acctbal AS amount, DATE '1997-06-01' AS arrived, 0 AS side, 0 AS o_orderkey
    FROM customer
    UNION ALL SELECT o_custkey, o_totalprice, CAST(o_orderdate AS DATE), 1, o_orderkey FROM orders)
  GROUP BY custkey)""",
    "rows_with_reasons": """WITH r AS (
  SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS year,
    CASE WHEN c_custkey % 13 = 0 THEN c_mktsegment || c_mktsegment ELSE c_mktsegment END AS geo,
    c_custkey % 17 = 0 AS no_share FROM customer
), t AS (
  SELECT *, concat_ws(',', CASE WHEN year IS NULL THEN 'year_is_null' END,
    CASE WHEN no_share THEN 'food_expenditure_share_pct_is_null' END,
    CASE WHEN length(geo) > 16 THEN 'geo_longer_than_16' END) AS rules FROM r
)
SELECT c_custkey, CASE WHEN rules = '' AND c_custkey < max(c_custkey)
    FILTER (rules = '') OVER (PARTITION BY year, geo) THEN 'superseded' ELSE rules END AS broken FROM t""",
    "narrow": f"""SELECT c_nationkey AS year, c_mktsegment AS geo, c_custkey,
  {num(dec("c_acctbal / 1000", 5, 2), "food_expenditure_share_pct")} FROM customer""",
    "upsert_with_duplicate_target": """SELECT l_suppkey AS key, l_extendedprice AS amount FROM lineitem
WHERE l_suppkey % 3 <> 0
UNION ALL SELECT l_suppkey, arg_max(l_quantity, (l_orderkey, l_linenumber)) FROM lineitem
WHERE l_suppkey % 3 = 0 GROUP BY l_suppkey""",
}


def all_oracles() -> dict[str, str]:
    return {**STATEMENTS, **OPERATORS}
