"""The numbered sales questions and the two sales views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.functions import numeric as N
from tillworks.functions.dates import period_start
from tillworks.operators import breakdowns as B
from tillworks.operators import kpis as K
from tillworks.operators.filters import cancellations, registered, sales


def _sum_amount() -> Column:
    return F.sum("total_amount")


def _day() -> Column:
    return period_start("day", F.col("invoice_timestamp")).alias("sales_date")


def q05(fact: DataFrame) -> DataFrame:
    """Average price of a sold line; null when nothing was sold."""
    return sales(fact).agg(N.money_ratio(F.sum("unit_price"), F.count("unit_price")).alias("average_unit_price"))


def q07(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_type").agg(F.count_distinct("customer_id").alias("customer_count"))


def q09(fact: DataFrame) -> DataFrame:
    return _products(fact, "total_revenue", None, "total_units_sold", "total_revenue")


def q10(fact: DataFrame) -> DataFrame:
    return _products(fact, "total_revenue", 10, "total_revenue")


def q11(fact: DataFrame) -> DataFrame:
    return _products(fact, "total_units_sold", 10, "total_units_sold")


def _products(fact: DataFrame, order: str, limit: int | None, *shown: str) -> DataFrame:
    measures = {
        "total_units_sold": F.sum("quantity").cast("bigint"),
        "total_revenue": _sum_amount(),
    }
    grouped = sales(fact).groupBy("stock_code", "description").agg(*[measures[name].alias(name) for name in shown])
    ordered = grouped.orderBy(F.desc(order), "stock_code", "description")
    if limit is not None:
        ordered = ordered.limit(limit)
    return ordered.withColumn("total_revenue", N.amount_out(F.col("total_revenue"))) if "total_revenue" in shown else ordered


def q16(fact: DataFrame) -> DataFrame:
    return B.grouped_sales(fact, "day_of_week").orderBy(F.desc("total_revenue"), "day_of_week")


def q18(fact: DataFrame) -> DataFrame:
    """Invoices are reduced to one row each before counting, so one distinct pass is enough."""
    invoices = fact.groupBy("invoice_no").agg(F.bool_or("is_cancellation").alias("cancelled"))
    counts = invoices.agg(
        F.count("invoice_no").alias("total_invoices"),
        F.count_if(F.col("cancelled") & F.col("invoice_no").isNotNull()).alias("cancelled_invoices"),
    )
    rate = N.percent(F.col("cancelled_invoices"), F.col("total_invoices"))
    return counts.withColumn("cancellation_rate_pct", rate)


def q19(fact: DataFrame) -> DataFrame:
    """Null when nothing was cancelled."""
    return cancellations(fact).agg(N.amount_out(F.abs(_sum_amount())).alias("total_cancellation_loss"))


def q20(fact: DataFrame) -> DataFrame:
    grouped = sales(fact).groupBy("customer_type").agg(
        F.count_distinct("invoice_no").alias("total_orders"),
        _sum_amount().alias("total_revenue"),
        F.count("total_amount").alias("lines"),
    )
    return grouped.select(
        "customer_type",
        "total_orders",
        N.amount_out(F.col("total_revenue")).alias("total_revenue"),
        N.money_ratio(F.col("total_revenue"), F.col("lines")).alias("avg_line_item_value"),
    )


def q21(fact: DataFrame) -> DataFrame:
    """Month-over-month growth. The unpartitioned window runs over one row per month."""
    monthly = sales(fact).groupBy("invoice_year", "invoice_month").agg(_sum_amount().alias("current"))
    in_order = Window.orderBy("invoice_year", "invoice_month")
    current, previous = F.col("current"), F.col("previous")
    base = F.nullif(N.cents(previous), N.whole(0))
    # Growth is asked for on any base but zero, so the sign of the base moves to the numerator.
    growth = N.half_up((N.cents(current) - base) * N.whole(100) * F.when(base < 0, N.whole(-1)).otherwise(N.whole(1)), F.abs(base), 2)
    return (
        monthly.withColumn("previous", F.lag("current").over(in_order))
        .select(
            "invoice_year",
            "invoice_month",
            N.amount_out(current).alias("current_month_revenue"),
            F.coalesce(N.amount_out(previous), F.lit(0.0)).alias("previous_month_revenue"),
            growth.alias("mom_growth_pct"),
        )
        .orderBy("invoice_year", "invoice_month")
    )


def q22(fact: DataFrame, places: int = 3) -> DataFrame:
    """Best products of each country, ties kept.

    The bound on the rank is applied per task before the shuffle, so a country with a large
    share of all products sends only its leaders.
    """
    totals = sales(fact).groupBy("country", "stock_code", "description").agg(_sum_amount().alias("total_revenue"))
    in_country = Window.partitionBy("country").orderBy(F.desc("total_revenue"))
    return (
        totals.withColumn("revenue_rank", F.dense_rank().over(in_country))
        .where(F.col("revenue_rank") <= places)
        .select(
            "country",
            F.col("revenue_rank").cast("bigint").alias("revenue_rank"),
            "stock_code",
            "description",
            N.amount_out(F.col("total_revenue")).alias("total_revenue"),
        )
        .orderBy("country", "revenue_rank", "stock_code", "description")
    )


def q23(fact: DataFrame, limit: int = 20) -> DataFrame:
    """Customer leaderboard with each one's share of all registered revenue.

    Customers and their grand total come from one grouping-sets aggregate over the same scan.
    The total sorts first, so the top ``limit + 1`` rows hold everything the windows need.
    """
    visits = (
        registered(sales(fact))
        .groupBy("customer_id", "customer_type", "invoice_no")
        .agg(_sum_amount().alias("amount"))
    )
    key = [F.col("customer_id"), F.col("customer_type")]
    totals = visits.groupingSets([key, []], *key).agg(
        F.grouping_id().alias("level"),
        F.count("invoice_no").alias("total_orders"),
        F.sum("amount").alias("spent"),
    )
    leaders = totals.orderBy(F.desc("level"), F.desc("spent"), "customer_id", "customer_type").limit(limit + 1)
    is_total = F.col("level") > 0
    everyone = F.max(F.when(is_total, F.col("spent"))).over(Window.partitionBy())
    rank = F.dense_rank().over(Window.orderBy(F.desc("spent"))).cast("bigint")
    return (
        leaders.withColumn("everyone", everyone)
        .where(~is_total)
        .select(
            rank.alias("customer_rank"),
            "customer_id",
            "customer_type",
            "total_orders",
            N.amount_out(F.col("spent")).alias("total_spent"),
            N.half_up(N.cents(F.col("spent")) * N.whole(100), N.cents(F.col("everyone")), 2).alias("pct_of_total_revenue"),
        )
        .orderBy("customer_rank", "customer_id")
    )


def q24(fact: DataFrame) -> DataFrame:
    """Running revenue. The unpartitioned window runs over one row per day."""
    daily = sales(fact).groupBy(_day()).agg(_sum_amount().alias("daily_revenue"))
    running = F.sum("daily_revenue").over(Window.orderBy("sales_date"))
    return (
        daily.select(
            "sales_date",
            N.amount_out(F.col("daily_revenue")).alias("daily_revenue"),
            N.amount_out(running).alias("cumulative_running_revenue"),
        )
        .orderBy("sales_date")
    )


def q25(fact: DataFrame) -> DataFrame:
    """Registered customers who came back."""
    return (
        registered(sales(fact))
        .groupBy("customer_id")
        .agg(
            F.count_distinct("invoice_no").alias("total_orders"),
            F.min("invoice_timestamp").alias("first_purchase_date"),
            F.max("invoice_timestamp").alias("last_purchase_date"),
            _sum_amount().alias("lifetime_value"),
        )
        .where(F.col("total_orders") > 1)
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .withColumn("lifetime_value", N.amount_out(F.col("lifetime_value")))
    )


def monthly_sales_view(fact: DataFrame) -> DataFrame:
    guest = F.col("customer_id") == S.GUEST_ID
    visits = sales(fact).groupBy("invoice_year", "invoice_month", "customer_id", "invoice_no").agg(
        _sum_amount().alias("amount"), F.sum("quantity").alias("units")
    )
    return (
        visits.groupBy("invoice_year", "invoice_month")
        .agg(
            F.count_distinct("invoice_no").alias("total_orders"),
            N.amount_out(F.sum("amount")).alias("total_revenue"),
            F.sum("units").cast("bigint").alias("total_units_sold"),
            F.count_distinct(F.when(~guest, F.col("customer_id"))).alias("active_registered_customers"),
        )
        .orderBy(F.desc("invoice_year"), F.desc("invoice_month"))
    )


def top_products_view(fact: DataFrame) -> DataFrame:
    products = B.top_products(fact, limit=None)
    return products.withColumnRenamed("total_units_sold", "total_quantity_sold")


CATALOG = {
    "q01": K.total_revenue,
    "q02": K.total_orders,
    "q03": K.total_units,
    "q04": K.order_value_or_null,
    "q05": q05,
    "q06": K.total_customers,
    "q07": q07,
    "q08": B.by_country,
    "q09": q09,
    "q10": q10,
    "q11": q11,
    "q12": lambda fact: B.grouped_sales(fact, "invoice_year", "invoice_month").orderBy("invoice_year", "invoice_month"),
    "q13": lambda fact: B.grouped_sales(fact, "invoice_year", "invoice_quarter").orderBy("invoice_year", "invoice_quarter"),
    "q14": lambda fact: B.grouped_sales(fact, "invoice_year").orderBy("invoice_year"),
    "q15": lambda fact: B.grouped_sales(fact, _day()).orderBy("sales_date"),
    "q16": q16,
    "q17": lambda fact: B.grouped_sales(fact, "invoice_hour").orderBy("invoice_hour"),
    "q18": q18,
    "q19": q19,
    "q20": q20,
    "q21": q21,
    "q22": q22,
    "q23": q23,
    "q24": q24,
    "q25": q25,
    "v_monthly_sales": monthly_sales_view,
    "v_top_products": top_products_view,
}
