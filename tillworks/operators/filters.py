"""Report filters: dates, country, customer type and kind of transaction."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.errors import FilterError
from tillworks.functions.dates import moment

SALES = "Sales"
CANCELLATIONS = "Cancellations"
EVERYTHING = "Everything"


def _as_date(text: str) -> date:
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError as problem:
        raise FilterError(f"{text!r} is not a YYYY-MM-DD date") from problem


def transactions(kind: str | None) -> Column:
    """Predicate for sales, for cancellations, or (any other word) for every line."""
    if kind == SALES:
        return ~F.col("is_cancellation")
    if kind == CANCELLATIONS:
        return F.col("is_cancellation")
    return F.lit(True)


@dataclass(frozen=True)
class ReportFilter:
    """What a report is restricted to; a field left out restricts nothing."""

    start_date: str | None = None
    end_date: str | None = None
    country: str | None = None
    customer_type: str | None = None
    transaction_type: str | None = None

    def validate(self) -> ReportFilter:
        first = _as_date(self.start_date) if self.start_date else None
        last = _as_date(self.end_date) if self.end_date else None
        if first and last and first > last:
            raise FilterError(f"start date {first} is after end date {last}")
        return self

    def dates(self, columns: list[str] = ()) -> Column:
        """Whole days from start to end.

        Timestamps are compared as they are, so the predicate reaches the parquet statistics.
        Where the table has year and month columns, the same range is also stated on them: on
        a table partitioned by month only the folders in range are then listed.
        """
        self.validate()
        inside = F.lit(True)
        by_month = set(S.FACT_PARTITIONS) <= set(columns)
        month_no = F.col("invoice_year") * 100 + F.col("invoice_month")
        if self.start_date:
            first = _as_date(self.start_date)
            inside = inside & (F.col("invoice_timestamp") >= moment(f"{first} 00:00:00"))
            if by_month:
                inside = inside & (month_no >= first.year * 100 + first.month)
        if self.end_date:
            last = _as_date(self.end_date)
            inside = inside & (F.col("invoice_timestamp") < moment(f"{last + timedelta(days=1)} 00:00:00"))
            if by_month:
                inside = inside & (month_no <= last.year * 100 + last.month)
        return inside

    def in_country(self) -> Column:
        if not self.country or self.country == S.ALL_COUNTRIES:
            return F.lit(True)
        return F.col("country") == self.country

    def of_customer_type(self) -> Column:
        if not self.customer_type or self.customer_type == S.ALL_TYPES:
            return F.lit(True)
        return F.col("customer_type") == self.customer_type

    def of_transaction_type(self, default: str = EVERYTHING) -> Column:
        """The chosen kind of transaction, or the metric's own default if none was chosen."""
        chosen = self.transaction_type in (SALES, CANCELLATIONS)
        return transactions(self.transaction_type if chosen else default)


NO_FILTER = ReportFilter()


def apply_filter(fact: DataFrame, chosen: ReportFilter | None = None, default: str = EVERYTHING) -> DataFrame:
    """Rows of the fact table inside the filter; ``default`` is the metric's transaction kind."""
    chosen = chosen or NO_FILTER
    return fact.where(
        chosen.dates(fact.columns)
        & chosen.in_country()
        & chosen.of_customer_type()
        & chosen.of_transaction_type(default)
    )


def sales(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return apply_filter(fact, chosen, SALES)


def cancellations(fact: DataFrame, chosen: ReportFilter | None = None) -> DataFrame:
    return apply_filter(fact, chosen, CANCELLATIONS)


def registered(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("customer_id") != S.GUEST_ID)


def repeat_buyers(fact: DataFrame) -> DataFrame:
    """Customers with more than one distinct invoice, and how many they have."""
    return (
        fact.groupBy("customer_id")
        .agg(F.count_distinct("invoice_no").alias("total_orders"))
        .where(F.col("total_orders") > 1)
    )
