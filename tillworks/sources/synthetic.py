"""Synthetic transactions for timing runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.functions.dates import moment


def from_ids(ids: DataFrame, name: str = "id") -> DataFrame:
    """One transaction per id: each tenth is a return, each third a guest, odd ones unnamed."""
    i = F.col(name)
    tenth = i % 10 == 0
    invoice = F.concat(F.lit("536"), F.when(i < 1000, F.lpad(i.cast("string"), 3, "0")).otherwise(i.cast("string")))
    return ids.select(
        F.when(tenth, F.concat(F.lit("C"), invoice)).otherwise(invoice).alias("InvoiceNo"),
        F.concat(F.lit("8512"), (i % 10).cast("string"), F.lit("A")).alias("StockCode"),
        F.when(i % 2 == 0, "GREEN GLASS TEA LAMP").alias("Description"),
        F.when(tenth, -1).otherwise(6).cast("bigint").alias("Quantity"),
        moment("2010-12-01 08:26:00").alias("InvoiceDate"),
        F.lit("2.55").cast("decimal(10,2)").alias("UnitPrice"),
        F.when(i % 3 != 0, "17850").alias("CustomerID"),
        F.lit("United Kingdom").alias("Country"),
    )


def transactions(spark: SparkSession, rows: int) -> DataFrame:
    return from_ids(spark.range(rows))
