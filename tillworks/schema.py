"""Fixed names, types and values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw file layout.
RAW_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]
REQUIRED_COLUMNS = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice"]

# Raw values stay text until validation has counted the ones that do not parse.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# Feature column -> warehouse column, in warehouse order.
FACT_COLUMN_MAP = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "UnitPrice": "unit_price",
    "TotalPrice": "total_amount",
    "InvoiceDate": "invoice_timestamp",
    "InvoiceYear": "invoice_year",
    "InvoiceMonth": "invoice_month",
    "InvoiceQuarter": "invoice_quarter",
    "InvoiceWeekday": "day_of_week",
    "InvoiceHour": "invoice_hour",
    "CustomerID": "customer_id",
    "CustomerType": "customer_type",
    "Country": "country",
    "IsCancellation": "is_cancellation",
    "RevenueBucket": "revenue_bucket",
}

# Warehouse columns and types.
FACT_SCHEMA = T.StructType([
    T.StructField("invoice_no", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
    T.StructField("total_amount", T.DecimalType(12, 2)),
    T.StructField("invoice_timestamp", T.TimestampNTZType()),
    T.StructField("invoice_year", T.ShortType()),
    T.StructField("invoice_month", T.ShortType()),
    T.StructField("invoice_quarter", T.ShortType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("invoice_hour", T.ShortType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("is_cancellation", T.BooleanType()),
    T.StructField("revenue_bucket", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

# Keys, partition columns and zones.
NATURAL_KEY = ["invoice_no", "stock_code", "invoice_timestamp"]
DEDUPE_KEY = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "CustomerID"]
FACT_PARTITIONS = ["invoice_year", "invoice_month"]
LAKE_PARTITIONS = ["InvoiceYear", "InvoiceMonth"]
LAKE_ZONES = ["raw", "staged", "processed"]

# Labels and fill-ins.
GUEST_ID = "GUEST"
GUEST = "Guest"
REGISTERED = "Registered"
UNKNOWN_DESCRIPTION = "UNKNOWN DESCRIPTION"
MISSING_TOKENS = ["", "NAN", "NONE", "NULL", "<NA>"]
BUCKET_CANCELLATION = "Cancellation"
BUCKET_LOW = "Low (< £10)"
BUCKET_MEDIUM = "Medium (£10-£50)"
BUCKET_HIGH = "High (> £50)"
ALL_COUNTRIES = "All Countries"
ALL_TYPES = "All"
TRANSFORMATION_VERSION = "1.0.0"

# Run states.
RUNNING = "RUNNING"
SUCCESS = "SUCCESS"
PARTIAL = "PARTIAL"
SKIPPED = "SKIPPED"
FAILED = "FAILED"

# Columns of the logs.
RUN_EVENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("event_seq", T.IntegerType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("completed_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_hash", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_valid", T.LongType()),
    T.StructField("rows_invalid", T.LongType()),
    T.StructField("rows_transformed", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_skipped", T.LongType()),
    T.StructField("rows_skipped_duplicate", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("execution_duration", T.DecimalType(10, 3)),
    T.StructField("watermark_before", T.TimestampNTZType()),
    T.StructField("watermark_after", T.TimestampNTZType()),
])

LINEAGE_SCHEMA = T.StructType([
    T.StructField("lineage_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_hash", T.StringType()),
    T.StructField("source_row_count", T.LongType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("target_row_count", T.LongType()),
    T.StructField("transformation_version", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

WATERMARK_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("high_watermark_timestamp", T.TimestampNTZType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()),
])
