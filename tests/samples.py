"""Small frames shared by the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.operators.fact_shape import to_fact_columns
from tillworks.operators.features import add_features

RAW = ", ".join(f"{name} string" for name in S.RAW_COLUMNS)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def fact(spark, *rows):
    """Fact rows from (invoice, stock, description, quantity, price, timestamp, customer, country)."""
    typed = spark.createDataFrame(
        list(rows),
        "InvoiceNo string, StockCode string, Description string, Quantity bigint, UnitPrice string, "
        "InvoiceDate string, CustomerID string, Country string",
    ).withColumns({
        "UnitPrice": F.col("UnitPrice").cast("decimal(14,4)"),
        "InvoiceDate": F.col("InvoiceDate").cast("timestamp_ntz"),
    })
    return to_fact_columns(add_features(typed))


THREE = [
    ("536365", "85123A", "WHITE HANGING HEART", 6, "2.55", "2010-12-01 08:26:00", "17850", "United Kingdom"),
    ("536366", "71053", "WHITE METAL LANTERN", 10, "3.00", "2010-12-01 08:28:00", "17850", "United Kingdom"),
    ("C536367", "22423", "REGENCY CAKESTAND", -1, "12.75", "2010-12-02 10:15:00", "17851", "France"),
]

CLEAN_ROWS = [
    ("536365", "85123A", "WHITE HANGING HEART T-LIGHT HOLDER", "6", "2010-12-01 08:26:00", "2.55", "17850", "United Kingdom"),
    ("536366", "71053", "WHITE METAL LANTERN", "6", "2010-12-01 08:28:00", "3.39", "17850", "United Kingdom"),
]


def one(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0].asDict()
