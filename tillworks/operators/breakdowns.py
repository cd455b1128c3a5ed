"""Grouped reports and leaderboards of the fact table.

Sums are decimals until the last projection. A report that shows distinct orders next to sums
groups by (key, invoice) first, which Spark plans by itself; where two different things are
counted, ``_per_visit`` makes that first grouping explicit so no line is copied per counter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.functions import numeric as N
from tillworks.functions.dates import period_start
from tillworks.operators.filters import ReportFilter, cancellations, registered, sales

# Trend granularities; any other word means monthly.
GRANULARITIES = {"Daily": "day", "Weekly": "week", "Monthly": "month", "Quarterly": "quarter"}


def _orders() -> Column:
    return F.count_distinct("invoice_no").alias("total_orders")


def _units() -> Column:
    return F.sum("quantity").cast("bigint").alias("total_units")


def _revenue() -> Column:
    return F.sum("total_amount").alias("total_revenue")


def _money(frame: DataFrame, *names: str) -> DataFrame:
    """Hand money out as DOUBLE."""
    return frame.withColumns({name: N.amount_out(F.col(name)) for name in names})


def _order_value() -> Column:
    return N.money_ratio(F.col("total_revenue"), F.col("total_orders")).alias("average_order_value")


def _month() -> Column:
    return period_start("month", F.col("invoice_timestamp")).alias("period")


def _top(frame: DataFrame, measure: str, limit: int | None, *ties: str) -> DataFrame:
    """Largest first, ties in key order; with a limit, each task keeps only its own top rows."""
    ordered = frame.orderBy(F.desc(measure), *ties)
    return ordered if limit is None else ordered.limit(limit)


# --- by time -----------------------------------------------------------------------------


def by_month(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    grouped = sales(fact, chosen).groupBy(_month(), "invoice_year", "invoice_month").agg(_orders(), _units(), _revenue())
    return _money(grouped.withColumn("average_order_value", _order_value()), "total_revenue").orderBy("period")


def trend(fact: DataFrame, granularity: str = "Monthly", chosen: ReportFilter | None = None) -> DataFrame:
    """Sales per day, week, month or quarter; the filter's transaction type is not used."""
    unit = GRANULARITIES.get(granularity, "month")
    period = period_start(unit, F.col("invoice_timestamp")).alias("period")
    grouped = _only_sales(fact, chosen).groupBy(period).agg(_orders(), _units(), _revenue())
    return _money(grouped.withColumn("average_order_value", _order_value()), "total_revenue").orderBy("period")


def cancellation_trend(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    grouped = cancellations(fact, chosen).groupBy(_month()).agg(
        F.count_distinct("invoice_no").alias("cancelled_orders"),
        F.abs(F.sum("quantity")).cast("bigint").alias("cancelled_units"),
        F.abs(F.sum("total_amount")).alias("lost_revenue"),
    )
    return _money(grouped, "lost_revenue").orderBy("period")


def _only_sales(fact: DataFrame, chosen: ReportFilter | None) -> DataFrame:
    chosen = chosen or ReportFilter()
    return sales(fact, ReportFilter(chosen.start_date, chosen.end_date, chosen.country, chosen.customer_type))


# --- by country --------------------------------------------------------------------------


def by_country(fact: DataFrame, chosen: ReportFilter | None = None, limit: int | None = None) -> DataFrame:
    grouped = sales(fact, chosen).groupBy("country").agg(_orders(), _revenue())
    return _money(_top(grouped, "total_revenue", limit, "country"), "total_revenue")


def countries_of(visits: DataFrame, limit: int | None = None) -> DataFrame:
    """``by_country`` from the rows of ``sold_visits``."""
    grouped = visits.groupBy("country").agg(_orders(), F.sum("total_revenue").alias("total_revenue"))
    return _money(_top(grouped, "total_revenue", limit, "country"), "total_revenue")


def country_choices(fact: DataFrame) -> DataFrame:
    """The countries on file in order, after an entry that stands for all of them."""
    found = fact.select("country").distinct().select("country", F.lit(1).alias("place"))
    every = fact.sparkSession.range(1).select(F.lit(S.ALL_COUNTRIES).alias("country"), F.lit(0).alias("place"))
    return every.unionByName(found).orderBy("place", "country")


# --- by product --------------------------------------------------------------------------


def _per_product(lines: DataFrame, *measures: Column) -> DataFrame:
    return lines.groupBy("stock_code", "description").agg(*measures)


def top_products(
    fact: DataFrame, chosen: ReportFilter | None = None, limit: int | None = 10, metric: str = "total_revenue"
) -> DataFrame:
    """Best products by revenue, or by units for any other metric name."""
    order = "total_revenue" if metric == "total_revenue" else "total_units_sold"
    grouped = _per_product(sales(fact, chosen), _units().alias("total_units_sold"), _revenue(), _orders())
    return _money(_top(grouped, order, limit, "stock_code", "description"), "total_revenue")


def top_products_by_quantity(fact: DataFrame, country: str | None = None, limit: int | None = 10) -> DataFrame:
    lines = sales(fact, ReportFilter(country=country))
    grouped = _per_product(lines, _units().alias("total_units_sold"), _revenue())
    return _money(_top(grouped, "total_units_sold", limit, "stock_code", "description"), "total_revenue")


def returned_products(fact: DataFrame, chosen: ReportFilter | None = None, limit: int | None = 10) -> DataFrame:
    """Products with the highest value sent back."""
    chosen = chosen or ReportFilter()
    scope = ReportFilter(chosen.start_date, chosen.end_date, chosen.country, chosen.customer_type)
    grouped = _per_product(
        cancellations(fact, scope),
        F.abs(F.sum("quantity")).cast("bigint").alias("total_returned_units"),
        F.abs(F.sum("total_amount")).alias("total_returned_value"),
    )
    return _money(_top(grouped, "total_returned_value", limit, "stock_code", "description"), "total_returned_value")


# --- by customer -------------------------------------------------------------------------


def _per_visit(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines added up per (keys, customer, invoice)."""
    return lines.groupBy(*keys, "customer_id", "invoice_no").agg(_revenue(), _units())


def sold_visits(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Sales per (country, customer type, customer, invoice): what reports by country and by customer
    type have in common, so that Spark reads and groups the lines once for both."""
    return _per_visit(sales(fact, chosen), "country", "customer_type")


def _by_type(fact: DataFrame, chosen: ReportFilter | None) -> DataFrame:
    return _types_of(_per_visit(sales(fact, chosen), "customer_type"))


def _types_of(visits: DataFrame) -> DataFrame:
    return visits.groupBy("customer_type").agg(
        F.count_distinct("customer_id").alias("customer_count"),
        F.count_distinct("invoice_no").alias("total_orders"),
        F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("total_revenue"),
    )


def _with_revenue_each(by_type: DataFrame) -> DataFrame:
    per_customer = N.money_ratio(F.col("total_revenue"), F.col("customer_count"))
    return _money(by_type.withColumn("revenue_per_customer", per_customer), "total_revenue")


def segments(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return _with_revenue_each(_by_type(fact, chosen))


def segments_of(visits: DataFrame) -> DataFrame:
    """``segments`` from the rows of ``sold_visits``."""
    return _with_revenue_each(_types_of(visits))


def customer_summary(fact: DataFrame, country: str | None = None) -> DataFrame:
    return _money(_by_type(fact, ReportFilter(country=country)), "total_revenue")


def segment_shares(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Revenue share of each customer type; the window spans one row per type."""
    total = F.sum("total_revenue").over(Window.partitionBy())
    return _money(
        sales(fact, chosen)
        .groupBy("customer_type")
        .agg(F.coalesce(F.sum("total_amount"), F.lit(0)).alias("total_revenue"))
        .withColumn("revenue_share_pct", N.money_percent(F.col("total_revenue"), total)),
        "total_revenue",
    )


def top_customers(fact: DataFrame, country: str | None = None, limit: int = 10) -> DataFrame:
    """Best registered customers per country with their dense rank.

    A dense rank depends on larger values only, so ranking the top rows alone gives the same
    ranks as ranking everyone; the window never sees more than ``limit`` rows.
    """
    grouped = (
        registered(sales(fact, ReportFilter(country=country)))
        .groupBy("customer_id", "customer_type", "country")
        .agg(_orders(), _revenue())
    )
    best = _top(grouped, "total_revenue", limit, "customer_id", "country")
    rank = F.dense_rank().over(Window.orderBy(F.desc("total_revenue"))).cast("bigint")
    return _money(best.withColumn("rank", rank), "total_revenue").select(
        "rank", "customer_id", "customer_type", "country", "total_orders", "total_revenue"
    )


# --- used by the catalogue ---------------------------------------------------------------


def grouped_sales(fact: DataFrame, *keys: str | Column) -> DataFrame:
    """Distinct orders and revenue of sales per key."""
    return _money(sales(fact).groupBy(*keys).agg(_orders(), _revenue()), "total_revenue")
