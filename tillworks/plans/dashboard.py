"""Report packages composed of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.operators import breakdowns as B
from tillworks.operators import insights as I
from tillworks.operators import kpis as K
from tillworks.operators.filters import ReportFilter


def dashboard(fact: DataFrame, chosen: ReportFilter | None = None) -> dict[str, DataFrame]:
    """The six frames of the overview, all lazy.

    KPIs and insights share a row and its scans, countries and customers their visits; the other breakdowns
    take a scan of only the columns they need. The
    fact table is not cached: at full size re-reading a few columns is cheaper than holding all.
    """
    visits = B.sold_visits(fact, chosen)
    row = one_whole_row(K.kpi_row(fact, chosen, with_top_product=True))
    return {
        "kpis": K.kpi_records(row),
        "insights": I.findings(row),
        "revenue_trend": B.by_month(fact, chosen),
        "top_products": B.top_products(fact, chosen, limit=5),
        "country_revenue": B.countries_of(visits, limit=10),
        "customer_summary": B.segments_of(visits),
    }


def one_whole_row(row: DataFrame) -> DataFrame:
    """A one-row frame whose columns are all computed, whichever of them are used: so two reports on it
    are planned alike up to here, and Spark runs the common part once."""
    return row.agg(F.first(F.struct("*")).alias("row")).select("row.*")


def cancellation_report(fact: DataFrame, chosen: ReportFilter | None = None) -> dict[str, DataFrame]:
    """Rate, loss and number of cancellations, and the products most value came back for."""
    wanted = ["cancellation_rate", "cancellation_revenue_impact", "cancellation_count"]
    return {
        "kpis": K.kpi_records(K.kpi_row(fact, chosen)).where(F.col("kpi").isin(wanted)),
        "top_returned_products": B.returned_products(fact, chosen, limit=10),
    }


def _long(section: str, frame: DataFrame, item: list[str], measures: list[str]) -> DataFrame:
    """A frame as (section, item, measure, value) rows."""
    label = F.concat_ws(" / ", *[F.col(name).cast("string") for name in item])
    return frame.select(
        F.lit(section).alias("section"),
        label.alias("item"),
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("measure"), F.col(name).cast("double").alias("value")) for name in measures
        ])),
    )


def dashboard_rows(package: dict[str, DataFrame]) -> DataFrame:
    """The whole overview as one long frame."""
    parts = [
        _long("kpis", package["kpis"], ["kpi"], ["value"]),
        _long("insights", package["insights"], ["title", "severity", "value"], ["position"]),
        _long("revenue_trend", package["revenue_trend"], ["invoice_year", "invoice_month"],
              ["total_orders", "total_units", "total_revenue", "average_order_value"]),
        _long("top_products", package["top_products"], ["stock_code", "description"],
              ["total_units_sold", "total_revenue", "total_orders"]),
        _long("country_revenue", package["country_revenue"], ["country"], ["total_orders", "total_revenue"]),
        _long("customer_summary", package["customer_summary"], ["customer_type"],
              ["customer_count", "total_orders", "total_revenue", "revenue_per_customer"]),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def cancellation_rows(package: dict[str, DataFrame]) -> DataFrame:
    return _long("kpis", package["kpis"], ["kpi"], ["value"]).unionByName(
        _long("top_returned_products", package["top_returned_products"], ["stock_code", "description"],
              ["total_returned_units", "total_returned_value"])
    )
