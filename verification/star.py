"""Panels derived from the star-schema tables, standing in for the four stored tables."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelspark.functions.calendar import month_start
from panelspark.functions.numeric import fixed_mean, fixed_sum
from panelspark.operators.reshape import resample_month
from panelspark.schema import Scope

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

# Every predicate leaves something out: regions, years and series that are in the data.
MEMBERS = ("AFRICA", "ASIA", "EUROPE")
SCOPE = Scope(
    benchmark="EUROPE",
    diesel_geos=MEMBERS,
    income_geos=MEMBERS,
    geo_order=("EUROPE", "ASIA", "AFRICA"),
    series_geo="ASIA",
    series_item="CP01",
    share_geo="EUROPE",
    since_display="1996-07-01",
    since_statistics="1996-07-01",
    same_years=(1996, 1999),
    reference_years=(1995, 1998),
    growth_years=tuple(range(1995, 2002)),
)


#: Category, unit, and how far the series lies above the first.
FOOD_SERIES = (("CP01", "I25", 0), ("CP02", "I25", 1000), ("CP01", "I15", 5000))


def scope(**changes) -> Scope:
    return replace(SCOPE, **changes)


# Declared, so that opening a table runs no job to infer its schema.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def month_span(days: DataFrame, month: Column) -> tuple[Column, Column]:
    """First and last month of a table: a pass over its date column alone."""
    return days.select(F.min(month)).scalar(), days.select(F.max(month)).scalar()


def order_months(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    day = F.col("o_orderdate").cast("date")
    return month_span(table(spark, sf_dir, "orders"), month_start(day))


def week_months(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    day = F.col("l_shipdate").cast("date")
    return month_span(table(spark, sf_dir, "lineitem"), month_start(monday(day)))


def monday(day: Column) -> Column:
    return F.date_sub(day, F.weekday(day))


def geo_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation and region of their customer.

    Joined one table at a time, so that each is judged by its own size: customers are
    shuffled or broadcast as their size says, nations and regions are always small.  On a
    shuffled join, the partition of a customer with very many orders is split by AQE.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("day", F.col("o_orderdate").cast("date"))
    )


def geo_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the nation and region of their supplier, joined likewise."""
    lineitem, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("day", F.col("l_shipdate").cast("date"))
    )


def monthly_price(spark: SparkSession, sf_dir: str, geo: str = "r_name", *keep: Column) -> DataFrame:
    """Mean order value per month and geography; ``keep`` restricts the orders."""
    orders = geo_orders(spark, sf_dir)
    for condition in keep:
        orders = orders.where(condition)
    value = fixed_mean(F.col("o_totalprice")).cast("decimal(10,4)")
    return orders.groupBy(month_start(F.col("day")).alias("month"), F.col(geo).alias("geo")).agg(
        value.alias("hicp_index")
    )


def food(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two categories, and one of them in two units."""

    def series(item: str, unit: str, more: int) -> Column:
        value = (F.col("hicp_index") + more).cast("decimal(10,4)")
        names = {"coicop18": item, "unit": unit, "freq": "M"}
        return F.struct(*[F.lit(v).alias(k) for k, v in names.items()], value.alias("hicp_index"))

    kinds = F.array(*[series(*kind) for kind in FOOD_SERIES])
    return monthly_price(spark, sf_dir).select("month", "geo", F.inline(kinds))


def nation_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month, geo and value by nation: has gaps on small data."""
    return monthly_price(spark, sf_dir, "n_name").withColumnRenamed("hicp_index", "value")


def segment_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month, region, customer segment and value."""
    value = fixed_mean(F.col("o_totalprice")).cast("decimal(10,4)")
    return (
        geo_orders(spark, sf_dir)
        .groupBy(
            month_start(F.col("day")).alias("month"),
            F.col("r_name").alias("geo"),
            F.col("c_mktsegment").alias("segment"),
        )
        .agg(value.alias("value"))
    )


def weekly_price(spark: SparkSession, sf_dir: str, geo: str = "r_name") -> DataFrame:
    """Price per unit shipped, per week (its Monday) and geography."""
    price = fixed_sum(F.col("l_extendedprice")).cast("double") / (
        fixed_sum(F.col("l_quantity"), 0) * 100
    )
    return (
        geo_lineitems(spark, sf_dir)
        .groupBy(monday(F.col("day")).alias("date"), F.col(geo).alias("geo"))
        .agg(price.cast("decimal(10,4)").alias("diesel_price_per_1000l"))
    )


def diesel(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = "diesel_price_per_1000l"
    monthly = resample_month(weekly_price(spark, sf_dir), ["geo"], "date", price)
    # One region in steps of 50, so that a year often brings no change.
    stepped = F.when(F.col("geo") == "AFRICA", F.floor(F.col(price) / 50) * 50)
    value = F.coalesce(stepped.cast("double"), F.col(price))
    return monthly.select("month", "geo", value.cast("decimal(10,4)").alias(price))


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean account balance over the orders of a year."""
    value = fixed_mean(F.col("c_acctbal")).cast("decimal(12,2)")
    return (
        geo_orders(spark, sf_dir)
        .groupBy(F.year("day").alias("year"), F.col("r_name").alias("geo"))
        .agg(value.alias("income_pps"))
    )


def share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of one customer segment in the order value of a year, in percent."""
    household = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.col("o_totalprice"))
    part = F.coalesce(fixed_sum(household), F.lit(0)).cast("double")
    percent = part / fixed_sum(F.col("o_totalprice")) * 100
    return (
        geo_orders(spark, sf_dir)
        .groupBy(F.year("day").alias("year"), F.col("r_name").alias("geo"))
        .agg(percent.cast("decimal(5,2)").alias("food_expenditure_share_pct"))
    )


class StarTables:
    """Stands in for :class:`panelspark.Tables`; a table is planned when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._source = (spark, sf_dir)

    @cached_property
    def food(self) -> DataFrame:
        return food(*self._source)

    @cached_property
    def income(self) -> DataFrame:
        return income(*self._source)

    @cached_property
    def share(self) -> DataFrame:
        """With one key that occurs twice, as an unchecked source may bring it."""
        rows = share(*self._source)
        return rows.unionByName(rows.where((F.col("geo") == "ASIA") & (F.col("year") == 1996)))

    @cached_property
    def diesel(self) -> DataFrame:
        return diesel(*self._source)
