"""Customer and product dimensions, derived from the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks import schema as S


def customer_dimension(fact: DataFrame) -> DataFrame:
    """Newest type and country per customer; the guest entry is a fixed one."""
    newest = F.max_by(
        F.struct("customer_type", "country"), F.struct("invoice_timestamp", "country", "customer_type")
    )
    known = fact.where(F.col("customer_id") != S.GUEST_ID).groupBy("customer_id").agg(newest.alias("n"))
    guest = fact.sparkSession.range(1).select(
        F.lit(S.GUEST_ID).alias("customer_id"), F.lit(S.GUEST).alias("customer_type"), F.lit("Unknown").alias("country")
    )
    return known.select("customer_id", "n.customer_type", "n.country").unionByName(guest)


def product_dimension(fact: DataFrame) -> DataFrame:
    """Newest description per stock code."""
    newest = F.max_by("description", F.struct("invoice_timestamp", "description"))
    return fact.groupBy("stock_code").agg(newest.alias("description"))
