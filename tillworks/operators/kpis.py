"""Headline figures of the fact table.

Each scalar KPI is a one-row frame. The two KPI sets compute all their figures from a single
scan (see ``tally``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.functions import numeric as N
from tillworks.functions import text as X
from tillworks.functions.dates import period_start
from tillworks.operators.filters import (
    CANCELLATIONS,
    NO_FILTER,
    SALES,
    ReportFilter,
    apply_filter,
    registered,
    sales,
    transactions,
)
from tillworks.operators.tally import Kind, tally

NOTHING = "N/A"

# Key, name, category, unit and description of the KPI set, in report order.
KPI_SET = [
    ("total_revenue", "Total Net Revenue", "CORE", "£",
     "Total net monetary revenue generated across all completed sales."),
    ("total_orders", "Total Completed Orders", "CORE", "orders",
     "Count of distinct completed sales invoices."),
    ("total_customers", "Total Distinct Customers", "CORE", "customers",
     "Count of distinct buyers (including guest checkout marker)."),
    ("total_products", "Catalog Product Count", "CORE", "items",
     "Total unique items/stock codes sold."),
    ("average_order_value", "Average Order Value (AOV)", "CORE", "£",
     "Average monetary spend per completed invoice order."),
    ("average_items_per_order", "Average Items per Order", "CORE", "items",
     "Average physical item volume purchased per completed invoice."),
    ("cancellation_count", "Cancelled Order Count", "CANCELLATION", "invoices",
     "Total number of returned or cancelled order invoices."),
    ("cancellation_rate", "Cancellation Rate", "CANCELLATION", "%",
     "Percentage of generated invoices representing returns or cancellations."),
    ("cancellation_revenue_impact", "Cancellation Revenue Loss", "CANCELLATION", "£",
     "Total monetary revenue lost due to returns and order cancellations."),
    ("revenue_growth_pct", "Month-over-Month Revenue Growth", "SALES", "%",
     "Percentage revenue change compared to previous month."),
    ("monthly_order_growth_pct", "Month-over-Month Order Growth", "SALES", "%",
     "Percentage order volume change compared to previous month."),
    ("registered_customers", "Registered Customer Accounts", "CUSTOMER", "accounts",
     "Number of distinct registered buyer accounts."),
    ("guest_customers", "Guest Checkouts", "CUSTOMER", "orders",
     "Number of unauthenticated guest checkout orders."),
    ("registered_customer_revenue", "Registered Account Revenue", "CUSTOMER", "£",
     "Monetary sales revenue generated by registered accounts."),
    ("revenue_per_customer", "Average Revenue per Customer", "CUSTOMER", "£",
     "Average sales revenue generated per customer."),
]


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def _zero_float(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _revenue() -> Column:
    return _zero(F.sum("total_amount"))


# --- scalar KPIs -------------------------------------------------------------------------


def total_revenue(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return sales(fact, chosen).agg(N.amount_out(_revenue()).alias("total_revenue"))


def total_orders(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return sales(fact, chosen).agg(F.count_distinct("invoice_no").alias("total_orders"))


def total_units(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return sales(fact, chosen).agg(_zero(F.sum("quantity")).cast("bigint").alias("total_units_sold"))


def total_customers(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Every transaction counts; all guests together are one customer."""
    return apply_filter(fact, chosen).agg(F.count_distinct("customer_id").alias("total_customers"))


def total_products(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return apply_filter(fact, chosen).agg(F.count_distinct("stock_code").alias("total_products"))


def order_value_or_null(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Revenue per order; null when there is no order."""
    return sales(fact, chosen).agg(
        N.money_ratio(_revenue(), F.count_distinct("invoice_no")).alias("average_order_value")
    )


def average_order_value(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return order_value_or_null(fact, chosen).fillna(0.0)


def average_unit_price(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Mean price of a sold line; 0 when nothing was sold."""
    return sales(fact, chosen).agg(
        _zero_float(N.money_ratio(F.sum("unit_price"), F.count("unit_price"))).alias("average_unit_price")
    )


def _invoices(lines: DataFrame) -> DataFrame:
    """One row per invoice, with whether any of its lines is a cancellation."""
    return lines.groupBy("invoice_no").agg(F.bool_or("is_cancellation").alias("cancelled"))


def _cancelled_invoices() -> Column:
    return F.count_if(F.col("cancelled") & F.col("invoice_no").isNotNull())


def cancellation_count(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return _invoices(apply_filter(fact, chosen)).agg(_cancelled_invoices().alias("cancellation_count"))


def cancellation_rate(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return _invoices(apply_filter(fact, chosen)).agg(
        _zero_float(N.percent(_cancelled_invoices(), F.count("invoice_no"))).alias("cancellation_rate_pct")
    )


def cancellation_impact(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Revenue lost to cancellations, whichever transactions the filter asks for."""
    chosen = chosen or NO_FILTER
    lines = apply_filter(fact, ReportFilter(chosen.start_date, chosen.end_date, chosen.country, chosen.customer_type))
    return lines.where(transactions(CANCELLATIONS)).agg(
        N.amount_out(F.abs(_revenue())).alias("cancellation_revenue_impact")
    )


def repeat_customer_rate(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Share of registered buyers with more than one completed order."""
    chosen = chosen or NO_FILTER
    lines = sales(fact, ReportFilter(chosen.start_date, chosen.end_date, chosen.country, S.REGISTERED))
    buyers = registered(lines).groupBy("customer_id").agg(F.count_distinct("invoice_no").alias("orders"))
    return buyers.agg(
        _zero_float(N.percent(F.count_if(F.col("orders") > 1), F.count(F.lit(1)))).alias("repeat_customer_rate_pct")
    )


def _top_name(lines: DataFrame, name: str, out: str) -> DataFrame:
    totals = lines.groupBy(name).agg(F.sum("total_amount").alias("revenue"))
    best = F.min_by(F.col(name), F.struct((-F.col("revenue")).alias("r"), F.col(name).alias("n")))
    return totals.agg(F.coalesce(best, F.lit(NOTHING)).alias(out))


def top_product(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Description with the highest revenue; the customer type is not filtered."""
    chosen = chosen or NO_FILTER
    return _top_name(sales(fact, ReportFilter(chosen.start_date, chosen.end_date, chosen.country)), "description", "top_product")


def top_country(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Country with the highest revenue; only dates are filtered."""
    chosen = chosen or NO_FILTER
    return _top_name(sales(fact, ReportFilter(chosen.start_date, chosen.end_date)), "country", "top_country")


def items_per_order(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return sales(fact, chosen).agg(
        _zero_float(N.half_up(N.whole(_zero(F.sum("quantity"))), F.count_distinct("invoice_no"), 1)).alias(
            "average_items_per_order"
        )
    )


def revenue_per_customer(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Sales revenue over all distinct customers, cancelling ones included."""
    return kpi_row(fact, chosen).select("revenue_per_customer")


def revenue_growth(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """Last month against the month before it, among the months inside the filter."""
    return _growth(fact, chosen).select("revenue_growth_pct")


def order_growth(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return _growth(fact, chosen).select("monthly_order_growth_pct")


def registered_customers(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return _of_type(fact, chosen, S.REGISTERED).agg(F.count_distinct("customer_id").alias("registered_customers"))


def guest_customers(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return _of_type(fact, chosen, S.GUEST).agg(F.count_distinct("customer_id").alias("guest_customers"))


def registered_revenue(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return _of_type(fact, chosen, S.REGISTERED).agg(
        N.amount_out(_revenue()).alias("registered_customer_revenue")
    )


def _of_type(fact: DataFrame, chosen: ReportFilter | None, kind: str) -> DataFrame:
    return sales(fact, chosen).where(F.col("customer_type") == kind)


# --- month-over-month growth -------------------------------------------------------------


def _last_two(month: Column, revenue: Column, orders: Column, among: Column) -> Column:
    """Newest months first. The list holds one entry per calendar month, not per line."""
    entry = F.struct(month.alias("month"), revenue.alias("revenue"), orders.alias("orders"))
    return F.sort_array(F.collect_list(F.when(among, entry)), asc=False)


def _growth_columns(months: Column) -> dict[str, Column]:
    last, before = F.get(months, 0), F.get(months, 1)
    return {
        "revenue_growth_pct": _zero_float(
            N.growth_percent(N.cents(last["revenue"]), N.cents(before["revenue"]))
        ),
        "monthly_order_growth_pct": _zero_float(N.growth_percent(last["orders"], before["orders"])),
    }


def _growth(fact: DataFrame, chosen: ReportFilter | None) -> DataFrame:
    monthly = (
        sales(fact, chosen)
        .groupBy(period_start("month", F.col("invoice_timestamp")).alias("month"))
        .agg(F.sum("total_amount").alias("revenue"), F.count_distinct("invoice_no").alias("orders"))
    )
    months = _last_two(F.col("month"), F.col("revenue"), F.col("orders"), F.lit(True))
    return monthly.agg(months.alias("months")).select(
        *[value.alias(name) for name, value in _growth_columns(F.col("months")).items()]
    )


# --- KPI sets ----------------------------------------------------------------------------


def _of(kind: str, name: str) -> Column:
    """A figure of a tally kind that has a single group."""
    return _zero(F.max(F.when(F.col("kind") == kind, F.col(name))))


def kpi_row(fact: DataFrame, chosen: ReportFilter | None = None, with_top_product: bool = False) -> DataFrame:
    """All figures of the KPI set as one wide row, from one scan of the fact table."""
    chosen = chosen or NO_FILTER
    scope = fact.where(chosen.dates(fact.columns) & chosen.in_country() & chosen.of_customer_type())
    asked = chosen.of_transaction_type()
    sold = chosen.of_transaction_type(SALES)
    lost = transactions(CANCELLATIONS)
    is_registered = F.col("customer_type") == S.REGISTERED
    is_guest = F.col("customer_type") == S.GUEST

    kinds = [
        Kind("invoice", F.lit(True), member=F.col("invoice_no")),
        Kind("customer", asked, member=F.col("customer_id")),
        Kind("product", asked, member=F.col("stock_code")),
        Kind("month", sold, member=F.col("invoice_no"), group=period_start("month", F.col("invoice_timestamp"))),
    ]
    if with_top_product:
        kinds.append(Kind("item", sold, group=F.col("stock_code"), subgroup=F.col("description")))
    figures = tally(
        scope,
        kinds,
        sums={
            "sold_amount": (F.when(sold, F.col("total_amount")), ["invoice", "month", "item"]),
            "sold_units": (F.when(sold, F.col("quantity")), ["invoice"]),
            "lost_amount": (F.when(lost, F.col("total_amount")), ["invoice"]),
            "registered_amount": (F.when(sold & is_registered, F.col("total_amount")), ["invoice"]),
        },
        marks={
            "asked": asked,
            "sold": sold,
            "lost": asked & lost,
            "registered": sold & is_registered,
            "guest": sold & is_guest,
        },
    )
    best = []
    if with_top_product:
        item = F.struct(F.col("subgroup").alias("description"), F.col("sold_amount").alias("revenue"))
        order = F.struct((-F.col("sold_amount")).alias("a"), F.col("group").alias("b"), F.col("subgroup").alias("c"))
        is_item = F.col("kind") == "item"
        best = [F.min_by(F.when(is_item, item), F.when(is_item, order)).alias("best")]
    base = figures.agg(
        _of("invoice", "sold_amount").alias("revenue"),
        _of("invoice", "sold_units").alias("units"),
        _of("invoice", "sold").alias("orders"),
        _of("invoice", "asked").alias("invoices"),
        _of("invoice", "lost").alias("cancelled"),
        F.abs(_of("invoice", "lost_amount")).alias("impact"),
        _of("invoice", "registered_amount").alias("registered_revenue"),
        _of("customer", "members").alias("customers"),
        _of("customer", "registered").alias("registered"),
        _of("customer", "guest").alias("guests"),
        _of("product", "members").alias("products"),
        _last_two(F.col("group"), F.col("sold_amount"), F.col("members"), F.col("kind") == "month").alias("months"),
        *best,
    )
    c = F.col
    columns = {
        "total_revenue": N.amount_out(c("revenue")),
        "total_orders": c("orders"),
        "total_customers": c("customers"),
        "total_products": c("products"),
        "average_order_value": _zero_float(N.money_ratio(c("revenue"), c("orders"))),
        "average_items_per_order": _zero_float(N.half_up(N.whole(c("units")), c("orders"), 1)),
        "cancellation_count": c("cancelled"),
        "cancellation_rate": _zero_float(N.percent(c("cancelled"), c("invoices"))),
        "cancellation_revenue_impact": N.amount_out(c("impact")),
        **_growth_columns(c("months")),
        "registered_customers": c("registered"),
        "guest_customers": c("guests"),
        "registered_customer_revenue": N.amount_out(c("registered_revenue")),
        "revenue_per_customer": _zero_float(N.money_ratio(c("revenue"), c("customers"))),
    }
    if with_top_product:
        columns["top_product"] = c("best.description")
        columns["top_product_share"] = F.when(
            c("revenue") > 0, N.money_percent(c("best.revenue"), c("revenue"), 1)
        )
        columns["guest_share"] = N.percent(c("guests"), c("customers"), 1)
    return base.select(*[value.alias(name) for name, value in columns.items()])


def _formatted(kpi: Column, unit: Column, value: Column) -> Column:
    """Display text of a KPI, by its unit."""
    return (
        F.when(kpi == "average_items_per_order", F.format_string("%.1f", value))
        .when(unit == "£", X.money_text(value))
        .when(unit == "%", X.percent_text(value))
        .otherwise(X.number_text(value))
    )


def kpi_records(row: DataFrame) -> DataFrame:
    """The wide KPI row as one record per KPI."""
    labels = ", ".join(
        f"struct({place} AS position, '{key}' AS kpi, '{name}' AS name, '{category}' AS category, "
        f"'{description}' AS description, '{unit}' AS unit)"
        for place, (key, name, category, unit, description) in enumerate(KPI_SET, start=1)
    )
    values = F.array(*[F.col(key).cast("double") for key, *_ in KPI_SET])
    records = row.select(values.alias("values"), F.expr(f"inline(array({labels}))"))
    value = F.element_at("values", F.col("position"))
    return records.withColumn("value", value).select(
        "position", "kpi", "name", "value",
        _formatted(F.col("kpi"), F.col("unit"), F.col("value")).alias("formatted_value"),
        "category", "description", "unit",
    )


def kpi_set_full(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return kpi_records(kpi_row(fact, chosen))


def kpi_set_basic(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    """The executive set in one row and one scan, with its two alias names.

    Transaction type is not a filter of this set, and some figures ignore further filters: the
    repeat rate looks at registered buyers, the top product at every customer type, and the top
    country at dates only.
    """
    chosen = chosen or NO_FILTER
    lines = fact.where(chosen.dates(fact.columns))
    in_country, inside = chosen.in_country(), chosen.in_country() & chosen.of_customer_type()
    sale = transactions(SALES)
    buyer = in_country & sale & (F.col("customer_type") == S.REGISTERED) & (F.col("customer_id") != S.GUEST_ID)
    figures = tally(
        lines,
        [
            Kind("invoice", inside, member=F.col("invoice_no")),
            Kind("customer", inside, member=F.col("customer_id")),
            Kind("buyer", buyer, member=F.col("invoice_no"), group=F.col("customer_id")),
            Kind("product", in_country & sale, group=F.col("description")),
            Kind("country", sale, group=F.col("country")),
        ],
        sums={
            "amount": (F.when(sale, F.col("total_amount")), ["invoice", "product", "country"]),
            "units": (F.when(sale, F.col("quantity")), ["invoice"]),
            "prices": (F.when(sale, F.col("unit_price")), ["invoice"]),
            "priced": (F.when(sale & F.col("unit_price").isNotNull(), 1).otherwise(0), ["invoice"]),
        },
        marks={"sold": sale, "lost": transactions(CANCELLATIONS)},
    )

    def best(kind: str) -> Column:
        of_kind = F.col("kind") == kind
        order = F.struct((-F.col("amount")).alias("a"), F.col("group").alias("g"))
        return F.coalesce(F.min_by(F.when(of_kind, F.col("group")), F.when(of_kind, order)), F.lit(NOTHING))

    base = figures.agg(
        _of("invoice", "amount").alias("revenue"),
        _of("invoice", "units").alias("units"),
        _of("invoice", "sold").alias("orders"),
        _of("invoice", "members").alias("invoices"),
        _of("invoice", "lost").alias("cancelled"),
        _of("invoice", "prices").alias("prices"),
        _of("invoice", "priced").alias("priced"),
        _of("customer", "members").alias("customers"),
        F.count_if(F.col("kind") == "buyer").alias("buyers"),
        F.count_if((F.col("kind") == "buyer") & (F.col("members") > 1)).alias("repeat_buyers"),
        best("product").alias("top_product"),
        best("country").alias("top_country"),
    )
    c = F.col
    cancel_rate = _zero_float(N.percent(c("cancelled"), c("invoices")))
    repeat_rate = _zero_float(N.percent(c("repeat_buyers"), c("buyers")))
    return base.select(
        N.amount_out(c("revenue")).alias("total_revenue"),
        c("orders").alias("total_orders"),
        c("units").cast("bigint").alias("total_units_sold"),
        c("customers").alias("total_customers"),
        _zero_float(N.money_ratio(c("revenue"), c("orders"))).alias("average_order_value"),
        cancel_rate.alias("cancellation_rate_pct"),
        _zero_float(N.money_ratio(c("prices"), c("priced"))).alias("average_unit_price"),
        repeat_rate.alias("repeat_customer_rate_pct"),
        c("top_product"),
        c("top_country"),
        cancel_rate.alias("cancellation_rate"),
        repeat_rate.alias("repeat_customer_rate"),
    )
