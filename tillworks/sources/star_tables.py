"""The star-schema test tables seen through the retail data model.

Four views over the given parquet tables. Joins carry no broadcast hints: only ``nation`` has a
bounded size, and Spark sees that (and the real size of the others) from the files. Customers
are joined to orders before the much larger line table, so each row crosses the network once
per key. Lines and orders grow together, so their join is always a shuffled one, which spills to
disk and whose hot keys adaptive execution splits. The number of shuffle partitions follows the size
of the line table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.operators.features import add_features
from tillworks.operators.fact_shape import to_fact_columns
from tillworks.session import fit_shuffles


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _order_lines(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Every order line with its order, customer country and part."""
    fit_shuffles(spark, f"{folder}/lineitem.parquet")
    placed = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "c_mktsegment", "n_name")
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    lines = table(spark, folder, "lineitem") if lines is None else lines
    return (
        lines.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
        .join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )


def _signed_quantity() -> Column:
    units = F.col("l_quantity").cast("int")
    return F.when(F.col("l_returnflag") == "R", -units).otherwise(units)


def _guest_or_id(guest: Column) -> Column:
    return F.when(F.col("c_mktsegment") == "HOUSEHOLD", guest).otherwise(F.col("o_custkey").cast("string"))


def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned transactions in the raw column names: returned lines form ``C`` invoices."""
    order = F.col("o_orderkey").cast("string")
    return _order_lines(spark, folder).select(
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("C"), order)).otherwise(order).alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        _signed_quantity().alias("Quantity"),
        F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate")).alias("InvoiceDate"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("UnitPrice"),
        _guest_or_id(F.lit(S.GUEST_ID)).alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table the reports run on (every line, no deduplication)."""
    return to_fact_columns(add_features(clean_rows(spark, folder)))


# Words for a missing customer, as the planted rows spell them.
PLANTED_MISSING = ["nan", "None", "NULL", "<NA>"]


def dirty_rows(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Raw text transactions with faults planted by key; ``lines`` may be a stream.

    Every fourth order is written twice: the copy has the same key with its quantity spelled as a
    decimal, and another description.
    """
    order = F.col("l_orderkey").cast("string")
    part, customer = F.col("l_partkey"), F.col("o_custkey")
    copies = F.when(F.col("l_orderkey") % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copied = F.col("copy") == 1
    word = F.element_at(F.array(*map(F.lit, PLANTED_MISSING)), (customer % 4 + 1).cast("int"))
    quantity = _signed_quantity().cast("string")
    return _order_lines(spark, folder, lines).withColumn("copy", F.explode(copies)).select(
        F.when(F.col("l_orderkey") % 101 == 0, "  ")
        .when(F.col("l_returnflag") == "R", F.concat(F.lit(" c"), order))
        .otherwise(F.concat(order, F.lit(" "))).alias("InvoiceNo"),
        F.concat(part.cast("string"), F.lit("a")).alias("StockCode"),
        F.when(part % 113 == 0, " None").when(copied, F.concat(F.lit("Copy of "), F.col("p_name")))
        .when(part % 109 != 0, F.concat(F.lit(" \t"), F.col("p_name"))).alias("Description"),
        F.when(part % 107 == 0, "x").when(copied, F.concat(quantity, F.lit(".0"))).otherwise(quantity).alias("Quantity"),
        F.when(F.col("l_orderkey") % 103 == 0, "bad-date")
        .when(F.col("l_orderkey") % 5 == 1, F.date_format("o_orderdate", "M/d/yyyy H:mm"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("InvoiceDate"),
        F.concat(
            F.when(part % 97 == 0, "-").otherwise(""),
            F.col("p_retailprice").cast("decimal(10,2)").cast("string"),
        ).alias("UnitPrice"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", word)
        .when(customer % 3 == 0, F.concat(customer.cast("string"), F.lit(".0"))).otherwise(customer.cast("string")).alias("CustomerID"),
        F.concat(F.lit(" "), F.lower("n_name"), F.when(customer % 5 == 0, " west isle\t").otherwise(" ")).alias("Country"),
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """One finished load run per event."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    read, invalid = k * 10, F.col("event_id") % (k + 1)
    status = (
        F.when(F.col("event_type") == "error", S.FAILED)
        .when(F.col("event_type") == "signup", S.SKIPPED)
        .when(F.col("event_type") == "view", S.PARTIAL)
        .otherwise(S.SUCCESS)
    )
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.lit("fact_sales").alias("pipeline_name"),
        F.col("ts").alias("started_at"),
        F.timestamp_add("SECOND", F.floor("value").cast("int"), F.col("ts")).alias("completed_at"),
        status.alias("status"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string"), F.lit(".csv")).alias("source_file"),
        F.sha2(F.concat(F.lit("user_"), F.col("user_id").cast("string")).cast("binary"), 256).alias("source_hash"),
        read.alias("rows_read"),
        (read - invalid).alias("rows_valid"),
        invalid.alias("rows_invalid"),
        F.when(status.isin(S.SUCCESS, S.PARTIAL), read - invalid).otherwise(F.lit(0).cast("bigint")).alias("rows_inserted"),
        F.when(status == S.SKIPPED, read).otherwise(F.lit(0).cast("bigint")).alias("rows_skipped"),
        F.when(status == S.FAILED, "error").alias("error_message"),
        F.col("value").cast("decimal(10,3)").alias("execution_duration"),
    )


def lineage_log(spark: SparkSession, folder: str) -> DataFrame:
    """One lineage entry per finished run of ``run_log``."""
    return run_log(spark, folder).select(
        F.concat(F.lit("l"), F.col("run_id")).alias("lineage_id"),
        "run_id",
        "source_file",
        "source_hash",
        F.col("rows_read").alias("source_row_count"),
        F.lit("fact_sales").alias("target_table"),
        F.col("rows_inserted").alias("target_row_count"),
        F.lit(S.TRANSFORMATION_VERSION).alias("transformation_version"),
        F.col("started_at").alias("created_at"),
    )
