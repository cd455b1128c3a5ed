"""Rules that turn the KPI row into findings.

All rules are conditional structs of one array, so the KPI row is read once however many fire.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import text as X
from tillworks.operators.filters import ReportFilter
from tillworks.operators.kpis import kpi_row


@dataclass(frozen=True)
class Thresholds:
    """Percentages at which a rule fires."""

    cancellation_high: float = 5.0
    cancellation_critical: float = 10.0
    product_concentration: float = 20.0
    guest_ratio: float = 40.0
    growth: float = 5.0


# Category, severity, metric, title, description and recommendation per rule.
# {value}, {loss} and {name} stand for figures of the KPI row.
RULES = {
    "cancel_critical": (
        "CANCELLATION", "CRITICAL", "Cancellation Rate", "Critical Return & Order Cancellation Volume",
        "Order cancellation rate has reached a critical {value}, representing {loss} in gross lost revenue.",
        "Audit top returned stock items in inventory; inspect supplier quality and logistics handling.",
    ),
    "cancel_high": (
        "CANCELLATION", "HIGH", "Cancellation Rate", "Elevated Order Cancellation Rate",
        "Order cancellation rate is elevated at {value}, exceeding normal operational thresholds.",
        "Review product descriptions and return policies to reduce customer order friction.",
    ),
    "growth": (
        "TREND", "LOW", "MoM Revenue Growth", "Positive Month-over-Month Revenue Growth",
        "Monthly sales revenue expanded by {value} compared to the previous calendar month.",
        "Maintain current marketing spend and ensure inventory fulfillment levels remain strong.",
    ),
    "contraction": (
        "TREND", "HIGH", "MoM Revenue Growth", "Month-over-Month Revenue Contraction",
        "Monthly sales revenue contracted by {value} compared to the previous calendar month.",
        "Investigate regional order volume drops and run targeted promotional discount campaigns.",
    ),
    "concentration": (
        "PRODUCT", "MEDIUM", "Product Concentration Ratio", "High Product Revenue Concentration",
        "Single product '{name}' generates {value} of total company sales revenue.",
        "Diversify product catalog promotions to mitigate single-item supply chain dependency.",
    ),
    "guest_ratio": (
        "CUSTOMER", "MEDIUM", "Guest Customer Ratio", "Significant Reliance on Guest Checkouts",
        "Guest checkouts represent {value} of total customer interactions.",
        "Introduce account creation incentives (e.g. 10% first order discount) to increase registered users.",
    ),
}


def _filled(template: str, **figures: Column) -> Column:
    """The template with its placeholders replaced by columns."""
    parts, rest = [], template
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [F.lit(before), figures[name]]
    return F.concat(*parts, F.lit(rest))


def _finding(rule: str, position: int, fires: Column, value: Column, threshold: str, **figures: Column) -> Column:
    category, severity, metric, title, description, advice = RULES[rule]
    return F.when(
        F.coalesce(fires, F.lit(False)),
        F.struct(
            F.lit(position).alias("position"),
            F.lit(category).alias("category"),
            F.lit(title).alias("title"),
            _filled(description, value=value, **figures).alias("description"),
            F.lit(severity).alias("severity"),
            F.lit(metric).alias("metric"),
            value.alias("value"),
            F.lit(threshold).alias("threshold"),
            F.lit(advice).alias("recommendation"),
        ),
    )


def findings(row: DataFrame, limits: Thresholds = Thresholds(), only: list[str] | None = None) -> DataFrame:
    """Findings of a KPI row that has the top-product columns; ``only`` picks rules."""
    cancel, growth = F.col("cancellation_rate"), F.col("revenue_growth_pct")
    share, guests = F.col("top_product_share"), F.col("guest_share")
    rules = {
        "cancel_critical": (
            cancel >= limits.cancellation_critical, X.percent_text(cancel), f"{limits.cancellation_critical:.1f}%",
            {"loss": X.money_text(F.col("cancellation_revenue_impact"))},
        ),
        "cancel_high": (
            (cancel >= limits.cancellation_high) & (cancel < limits.cancellation_critical),
            X.percent_text(cancel), f"{limits.cancellation_high:.1f}%", {},
        ),
        "growth": (growth > limits.growth, F.concat(F.lit("+"), X.percent_text(growth)), "> 0.0%", {}),
        "contraction": (growth < 0, X.percent_text(growth), "< 0.0%", {}),
        "concentration": (
            share >= limits.product_concentration, X.percent_text(share), f"{limits.product_concentration:.1f}%",
            {"name": F.coalesce(F.col("top_product"), F.lit(""))},
        ),
        "guest_ratio": (guests >= limits.guest_ratio, X.percent_text(guests), f"{limits.guest_ratio:.1f}%", {}),
    }
    entries = [
        _finding(name, position, fires, value, threshold, **figures)
        for position, (name, (fires, value, threshold, figures)) in enumerate(rules.items(), start=1)
        if only is None or name in only
    ]
    return row.select(F.inline(F.array(*entries))).where(F.col("position").isNotNull())


def insights(
    fact: DataFrame, chosen: ReportFilter | None = None, limits: Thresholds = Thresholds(), only: list[str] | None = None
) -> DataFrame:
    return findings(kpi_row(fact, chosen, with_top_product=True), limits, only)
