"""Every operator as a query over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.functions import numeric as N
from tillworks.functions import text as X
from tillworks.operators import breakdowns as B
from tillworks.operators import filters as L
from tillworks.operators import kpis as K
from tillworks.operators import insights as I
from tillworks.operators.filters import ReportFilter
from tillworks.plans import dashboard as D
from tillworks.plans import load_queries
from tillworks.plans.catalog import CATALOG
from tillworks.sources.star_tables import fact_sales

Query = Callable[[SparkSession, str], DataFrame]
LINE = ["invoice_no", "stock_code", "quantity", "invoice_timestamp"]


def on_fact(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(fact_sales(spark, folder))


def _amount(name: str = "total_amount") -> Column:
    return N.amount_out(F.col("total_amount")).alias(name)


def _feature(*columns: str | Callable[[], Column]) -> Query:
    return on_fact(lambda fact: fact.select(*LINE, *[c() if callable(c) else c for c in columns]))


def _filtered(chosen: ReportFilter, *more: str, default: str = L.EVERYTHING) -> Query:
    return on_fact(lambda fact: L.apply_filter(fact, chosen, default).select(*LINE, _amount(), *more))


FEATURES: dict[str, Query] = {
    "feat_total": _feature(lambda: _amount("total_price")),
    "feat_year": _feature("invoice_year"),
    "feat_month": _feature("invoice_month"),
    "feat_quarter": _feature("invoice_quarter"),
    "feat_weekday": _feature("day_of_week"),
    "feat_hour": _feature("invoice_hour"),
    "feat_cancellation": _feature("is_cancellation"),
    "feat_customer_type": _feature("customer_id", "customer_type"),
    "feat_revenue_bucket": _feature("revenue_bucket"),
    "feat_all": _feature(
        _amount, "invoice_year", "invoice_month", "invoice_quarter", "day_of_week", "invoice_hour",
        "is_cancellation", "customer_type", "revenue_bucket",
    ),
}

FILTERS: dict[str, Query] = {
    "flt_date_range": _filtered(ReportFilter("1996-03-01", "1997-06-30")),
    "flt_country": _filtered(ReportFilter(country="NATION_7"), "country"),
    "flt_customer_type": _filtered(ReportFilter(customer_type="Guest"), "customer_type"),
    "flt_transaction_type": _filtered(ReportFilter(transaction_type=L.CANCELLATIONS), "is_cancellation"),
    "flt_default_sales": _filtered(ReportFilter(), "is_cancellation", default=L.SALES),
    "flt_registered": on_fact(lambda fact: L.registered(fact).select(*LINE, _amount(), "customer_id")),
    "flt_having": on_fact(L.repeat_buyers),
}


def _formats(fact: DataFrame) -> DataFrame:
    """The display formats, applied to every customer's figures."""
    per_invoice = fact.groupBy("customer_id", "invoice_no").agg(
        F.sum("total_amount").alias("amount"), F.sum("quantity").alias("units"),
        F.bool_or("is_cancellation").alias("cancelled"),
    )
    return per_invoice.groupBy("customer_id").agg(
        X.money_text(F.sum("amount")).alias("revenue_text"),
        X.number_text(F.sum("units")).alias("units_text"),
        X.percent_text(N.percent(F.count_if("cancelled"), F.count("invoice_no"))).alias("cancelled_text"),
    )


KPIS: dict[str, Query] = {
    name: on_fact(report)
    for name, report in {
        "kpi_total_revenue": K.total_revenue,
        "kpi_total_orders": K.total_orders,
        "kpi_total_units": K.total_units,
        "kpi_total_customers": K.total_customers,
        "kpi_total_products": K.total_products,
        "kpi_aov": K.average_order_value,
        "kpi_avg_unit_price": K.average_unit_price,
        "kpi_cancel_count": K.cancellation_count,
        "kpi_cancel_rate": K.cancellation_rate,
        "kpi_cancel_impact": K.cancellation_impact,
        "kpi_repeat_rate": K.repeat_customer_rate,
        "kpi_top_product": K.top_product,
        "kpi_top_country": K.top_country,
        "kpi_items_per_order": K.items_per_order,
        "kpi_revenue_growth": K.revenue_growth,
        "kpi_order_growth": K.order_growth,
        "kpi_registered_customers": K.registered_customers,
        "kpi_guest_customers": K.guest_customers,
        "kpi_registered_revenue": K.registered_revenue,
        "kpi_revenue_per_customer": K.revenue_per_customer,
        "kpi_set_basic": K.kpi_set_basic,
        "kpi_set_full": K.kpi_set_full,
        "kpi_format": _formats,
    }.items()
}

BREAKDOWNS: dict[str, Query] = {
    name: on_fact(report)
    for name, report in {
        "brk_month": B.by_month,
        "brk_country": B.by_country,
        "brk_top_products": B.top_products,
        "brk_top_products_qty": B.top_products_by_quantity,
        "brk_returned_products": B.returned_products,
        "brk_segments": B.segments,
        "brk_customer_summary": B.customer_summary,
        "brk_top_customers": B.top_customers,
        "brk_trend_daily": lambda fact: B.trend(fact, "Daily"),
        "brk_trend_weekly": lambda fact: B.trend(fact, "Weekly"),
        "brk_trend_monthly": lambda fact: B.trend(fact, "Monthly"),
        "brk_trend_quarterly": lambda fact: B.trend(fact, "Quarterly"),
        "brk_cancel_trend": B.cancellation_trend,
        "brk_countries": B.country_choices,
        "svc_sales_trends": B.by_month,
        "svc_customers": B.segments,
        "svc_products": B.top_products,
        "svc_countries": B.by_country,
        "app_share": B.segment_shares,
    }.items()
}

REPORTS: dict[str, Query] = {name: on_fact(report) for name, report in CATALOG.items()}




def _insight(rule: str, limits: I.Thresholds = I.Thresholds()) -> Query:
    return on_fact(lambda fact: I.insights(fact, limits=limits, only=[rule]))


# Limits are lowered where the test tables would not make a rule fire.
INSIGHTS: dict[str, Query] = {
    "ins_cancel_critical": _insight("cancel_critical"),
    "ins_cancel_high": _insight("cancel_high", I.Thresholds(cancellation_critical=90.0)),
    "ins_growth": _insight("growth", I.Thresholds(growth=-100.0)),
    "ins_contraction": _insight("contraction"),
    "ins_concentration": _insight("concentration", I.Thresholds(product_concentration=0.0)),
    "ins_guest_ratio": _insight("guest_ratio", I.Thresholds(guest_ratio=0.0)),
    "ins_all": on_fact(I.insights),
}

PACKAGES: dict[str, Query] = {
    "dash_summary": on_fact(lambda fact: D.dashboard_rows(D.dashboard(fact))),
    "svc_cancellations": on_fact(lambda fact: D.cancellation_rows(D.cancellation_report(fact))),
}


def queries() -> dict[str, Query]:
    return {
        **FEATURES, **FILTERS, **KPIS, **BREAKDOWNS, **REPORTS, **INSIGHTS, **PACKAGES, **load_queries.queries(),
    }
