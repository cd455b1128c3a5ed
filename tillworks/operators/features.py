"""Engineered columns: amount, date parts, cancellation flag, customer type, revenue bucket.

One projection without a shuffle, so the step stays inside the scan's generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import schema as S


def total_price(quantity: Column, price: Column) -> Column:
    return F.round(quantity * price, 2).cast("decimal(12,2)")


def cancelled(invoice: Column, quantity: Column) -> Column:
    """A ``C`` invoice or a negative quantity; missing values count as neither."""
    return F.coalesce(invoice.startswith("C"), F.lit(False)) | F.coalesce(quantity < 0, F.lit(False))


def customer_type(customer: Column) -> Column:
    """Only the guest marker is a guest; an empty id still counts as registered."""
    return F.when(customer == S.GUEST_ID, S.GUEST).otherwise(S.REGISTERED)


def revenue_bucket(is_cancellation: Column, amount: Column) -> Column:
    """A missing amount counts as low."""
    return (
        F.when(is_cancellation, S.BUCKET_CANCELLATION)
        .when(amount > 50, S.BUCKET_HIGH)
        .when(amount >= 10, S.BUCKET_MEDIUM)
        .otherwise(S.BUCKET_LOW)
    )


def date_parts(moment: Column) -> dict[str, Column]:
    return {
        "InvoiceYear": F.year(moment).cast("smallint"),
        "InvoiceMonth": F.month(moment).cast("smallint"),
        "InvoiceQuarter": F.quarter(moment).cast("smallint"),
        "InvoiceWeekday": F.date_format(moment, "EEEE"),
        "InvoiceHour": F.hour(moment).cast("smallint"),
    }


def add_features(clean: DataFrame) -> DataFrame:
    """Add the engineered columns; absent inputs give the documented defaults."""
    have = set(clean.columns)
    if {"Quantity", "UnitPrice"} <= have:
        amount = total_price(F.col("Quantity"), F.col("UnitPrice"))
    else:
        amount = F.lit(0).cast("decimal(12,2)")
    if {"InvoiceNo", "Quantity"} <= have:
        flag = cancelled(F.col("InvoiceNo"), F.col("Quantity"))
    else:
        flag = F.lit(False)
    kind = customer_type(F.col("CustomerID")) if "CustomerID" in have else F.lit(S.GUEST)
    parts = date_parts(F.col("InvoiceDate")) if "InvoiceDate" in have else {}
    return clean.withColumns({"TotalPrice": amount, **parts, "IsCancellation": flag, "CustomerType": kind}).withColumn(
        "RevenueBucket", revenue_bucket(F.col("IsCancellation"), F.col("TotalPrice"))
    )
