"""The load side of the library as queries over the star-schema tables.

Queries that write use fresh paths in the shared folder and return what was stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks import schema as S
from tillworks.functions import numeric as N
from tillworks.functions.dates import moment, to_moment
from tillworks.operators import audit as A
from tillworks.operators import cleaning as C
from tillworks.operators import incremental as I
from tillworks.operators import monitoring as M
from tillworks.operators import quality as Q
from tillworks.operators import validation as V
from tillworks.operators.dimensions import customer_dimension, product_dimension
from tillworks.operators.fact_shape import constraint_violations, to_fact_columns
from tillworks.operators.features import add_features
from tillworks.plans.load import Lake, LoadOptions, load_files
from tillworks.session import REMOVED, fresh_path, setting
from tillworks.sources import csv_files as files
from tillworks.sources import lake as Z
from tillworks.sources import star_tables as T
from tillworks.sources.synthetic import from_ids
from tillworks.streaming.landing import landing_stream, stream_load

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = "2001-01-01 00:00:00"
CUTOFF = "1998-01-01 00:00:00"
LINE = ["invoice_no", "stock_code", "quantity", "invoice_timestamp"]
RAW_KEY = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "CustomerID"]


def _dirty(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: step(T.dirty_rows(spark, folder))


def _fact(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: step(T.fact_sales(spark, folder))


def _runs(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: step(T.run_log(spark, folder))


def _amount() -> Column:
    return N.amount_out(F.col("total_amount")).alias("total_amount")


# --- sources and sinks -------------------------------------------------------------------


def exported_csv(spark: SparkSession, folder: str) -> str:
    """The raw text transactions as compressed CSV files, each the share of one task of the join."""
    with setting(spark, REMOVED, "true"):
        return files.write_csv(T.dirty_rows(spark, folder), fresh_path(spark, "csv"), compression="gzip")


def src_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Two folders read together: returned lines have their columns in another order and no Country."""
    rows = T.dirty_rows(spark, folder)
    returned = F.col("InvoiceNo").startswith(" c")
    kept = files.write_csv(rows.where(~returned), fresh_path(spark, "csv"))
    turned = [name for name in reversed(rows.columns) if name != "Country"]
    back = files.write_csv(rows.where(returned).select(*turned), fresh_path(spark, "csv"))
    return files.read_raw(spark, [kept, back])


def src_csv_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the files in UTF-8, half in latin-1, read back together."""
    rows = T.dirty_rows(spark, folder).withColumn("Country", F.concat(F.lit("é£ "), F.col("Country")))
    returned = F.col("InvoiceNo").startswith(" c")
    utf8 = files.write_csv(rows.where(~returned), fresh_path(spark, "utf8"))
    latin = files.write_csv(rows.where(returned), fresh_path(spark, "latin"), encoding=files.SINGLE_BYTE)
    return files.read_raw(spark, [utf8, latin]).select("InvoiceNo", "StockCode", "Quantity", "Country")


def _nation() -> Column:
    return F.split(F.trim("Country"), " ")[0]


def _by_country(spark: SparkSession, folder: str, rows: DataFrame) -> str:
    """The rows as CSV with one folder for each country; a file holds the rows of one country."""
    return _file_each(rows.withColumn("part", _nation()), escape='"')


WRITERS, JOINED = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.unionOutputPartitioning"


def _file_each(rows: DataFrame, **options: str | bool) -> str:
    """The rows as one CSV file for each ``part``, in a folder of that name. A task has a file open for each of its
    parts (up to 100), so it needn't sort its rows."""
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "csv")
    with setting(spark, WRITERS, "100"):
        rows.repartition("part").write.partitionBy("part").options(header=True, **options).csv(path)
    return path


def _country_of(file_path: Column) -> Column:
    return F.regexp_extract(file_path, "part=([^/]*)/", 1).alias("country")


def src_header_check(spark: SparkSession, folder: str) -> DataFrame:
    """Header and required columns of every file, one file for each country in the lines; the
    files lack UnitPrice."""
    path = _by_country(spark, folder, T.dirty_rows(spark, folder).drop("UnitPrice"))
    report = files.header_report(files.stored_manifest(spark, path))
    return report.select(_country_of(F.col("file_path")), "position", "name", "present", "required")


def src_extra_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = _by_country(spark, folder, T.dirty_rows(spark, folder).withColumn("Channel", F.lit("shop")))
    report = files.header_report(files.stored_manifest(spark, path))
    return report.where(~F.col("expected")).select(_country_of(F.col("file_path")), "position", "name")


def src_duplicate_header(spark: SparkSession, folder: str) -> DataFrame:
    """Files of text lines whose first line names InvoiceNo twice."""
    # Whole lines in one column, whose name is written as the first one; no line has the separator.
    line = F.concat_ws(",", F.trim("InvoiceNo"), "StockCode", F.trim("InvoiceNo")).alias("InvoiceNo,StockCode, InvoiceNo ")
    path = _file_each(
        T.dirty_rows(spark, folder).select(_nation().alias("part"), line), sep="\u0001",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    report = files.header_report(files.stored_manifest(spark, path))
    return report.where("repeated").select(_country_of(F.col("file_path")), "position", "name")


def _order_lines(spark: SparkSession, folder: str) -> str:
    """Orders as plain lines, one folder for each status."""
    orders = T.table(spark, folder, "orders")
    path = fresh_path(spark, "lines")
    orders.select(
        F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("value"),
        F.concat(F.lit("d"), (F.col("o_custkey") % 7).cast("string")).alias("part"),
    ).write.partitionBy("part").text(path)
    return path


def _digests(manifest: DataFrame) -> DataFrame:
    """Digests add up over files, however the lines were dealt to them."""
    return manifest.groupBy(F.regexp_extract("file_path", "part=([^/]*)/", 1).alias("part")).agg(
        F.sum("n_lines").alias("n_lines"),
        *[F.sum(name).cast("string").alias(name) for name in files.DIGEST_PARTS], F.bool_and("is_utf8").alias("is_utf8"),
    )


def src_file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(files.file_manifest(spark, _order_lines(spark, folder)))


def src_new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of lines, three folders of which were loaded before."""
    path = _order_lines(spark, folder)
    known = files.file_manifest(spark, path).where(F.col("file_path").rlike("part=d[0-2]/"))
    return _digests(files.new_files(files.file_manifest(spark, path), known))


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return add_features(T.clean_rows(spark, folder))


def lake_write(spark: SparkSession, folder: str) -> DataFrame:
    base = fresh_path(spark, "lake")
    path = Z.write_to_lake(_features(spark, folder), base, "processed", S.LAKE_PARTITIONS)
    rows = spark.read.parquet(path)
    return rows.select("InvoiceNo", "StockCode", "Quantity", F.col("TotalPrice").cast("double").alias("TotalPrice"), "InvoiceYear", "InvoiceMonth")


def lake_read(spark: SparkSession, folder: str) -> DataFrame:
    base = fresh_path(spark, "lake")
    Z.write_to_lake(_features(spark, folder), base, "processed", S.LAKE_PARTITIONS)
    rows = Z.read_from_lake(spark, base, "processed", ["InvoiceNo", "StockCode", "TotalPrice"])
    return rows.withColumn("TotalPrice", F.col("TotalPrice").cast("double"))


def _kept(rows: DataFrame, name: str, *parts: str) -> DataFrame:
    """Rows written to the shared folder and read back, by folders of ``parts``."""
    path = fresh_path(rows.sparkSession, name)
    rows.write.partitionBy(*parts).option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def lake_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Zones with a known number of files, and one without; the base's name has signs of patterns.
    Years are written in two parts each, so the number of files is that of years twice."""
    base = fresh_path(spark, "lake") + "+v1"
    rows = T.dirty_rows(spark, folder)
    # A file is written by one task: the three read files of a third of the rows, not a shuffle of them.
    dealt = _kept(rows.withColumn("third", F.pmod(F.xxhash64(*rows.columns), F.lit(3))), "thirds", "third")
    thirds = [dealt.where(F.col("third") == i).drop("third").coalesce(1) for i in range(3)]
    with setting(spark, JOINED, "false"):  # or else the union puts the three into one task
        Z.write_to_lake(thirds[0].union(thirds[1]).union(thirds[2]), base, "raw")
    # The rows of a year come out of one task, so that the zone writes them as one file.
    years = _features(spark, folder).select("InvoiceNo", "InvoiceYear").distinct()
    for _ in range(2):
        Z.write_to_lake(years.repartition("InvoiceYear"), base, "processed", ["InvoiceYear"])
    return Z.lake_summary(spark, base).select("zone", "file_count", (F.col("total_size_mb") >= 0).alias("has_size"))


def stage_write(spark: SparkSession, folder: str) -> DataFrame:
    base = fresh_path(spark, "lake")
    Z.write_to_lake(_features(spark, folder), base, "staged")
    staged = Z.read_from_lake(spark, base, "staged")
    return staged.select("InvoiceNo", "StockCode", "Quantity", F.col("TotalPrice").cast("double").alias("TotalPrice"), "RevenueBucket")


def fact_load(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "fact")
    Z.write_fact(T.fact_sales(spark, folder), path)
    return Z.read_fact(spark, path).select(*LINE, _amount(), "invoice_year", "invoice_month")


def fact_column_map(spark: SparkSession, folder: str) -> DataFrame:
    return to_fact_columns(_features(spark, folder)).withColumns({
        "unit_price": F.col("unit_price").cast("double"), "total_amount": F.col("total_amount").cast("double")
    })


def gen_synthetic(spark: SparkSession, folder: str) -> DataFrame:
    """One synthetic transaction per order key."""
    rows = from_ids(T.table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return rows.withColumn("UnitPrice", F.col("UnitPrice").cast("double"))


SOURCES: dict[str, Query] = {
    "src_csv": src_csv,
    "src_csv_encoding": src_csv_encoding,
    "src_header_check": src_header_check,
    "src_extra_columns": src_extra_columns,
    "src_duplicate_header": src_duplicate_header,
    "src_file_manifest": src_file_manifest,
    "src_new_files": src_new_files,
    "lake_write": lake_write,
    "lake_read": lake_read,
    "lake_summary": lake_summary,
    "stage_write": stage_write,
    "fact_load": fact_load,
    "fact_column_map": fact_column_map,
    "fact_constraints": _fact(constraint_violations),
    "dim_customer": _fact(customer_dimension),
    "dim_product": _fact(product_dimension),
    "gen_synthetic": gen_synthetic,
}

# --- validation and cleaning -------------------------------------------------------------


def _counter(column: str, name: str) -> Query:
    return _dirty(lambda raw: V.count_violations(raw, AS_OF).select(F.col(column).alias(name)))


VALIDATION: dict[str, Query] = {
    "val_empty": _dirty(lambda raw: V.validate(raw, AS_OF).select("total_rows", "is_empty")),
    "val_invalid_date": _counter("INVALID_DATE_FORMAT", "invalid_dates"),
    "val_invalid_numeric": _counter("INVALID_NUMERIC_TYPE", "invalid_numbers"),
    "val_missing_invoice": _counter("MISSING_INVOICE_NO", "missing_invoices"),
    "val_negative_price": _counter("NEGATIVE_UNIT_PRICE", "negative_prices"),
    "val_future_date": _counter("FUTURE_INVOICE_DATE", "future_dates"),
    "val_cancellation_count": _counter("cancellation_rows", "cancellations"),
    "val_report": _dirty(lambda raw: V.validate(raw, AS_OF)),
    "val_report_by_category": _dirty(
        lambda raw: V.report_by_category(V.count_violations(raw, AS_OF)).select("category", "violations")
    ),
    "val_quarantine": _dirty(
        lambda raw: V.quarantine(raw, AS_OF)[1].select(*RAW_KEY, F.array_join("violations", ",").alias("violations"))
    ),
}

CLEANING: dict[str, Query] = {
    "cln_trim": _dirty(lambda raw: C.trim_text(raw)),
    "cln_upper_codes": _dirty(lambda raw: C.upper_codes(raw).select("InvoiceNo", "StockCode")),
    "cln_title_country": _dirty(lambda raw: C.title_country(raw).select("InvoiceNo", "StockCode", "Country")),
    "cln_drop_invalid": _dirty(lambda raw: C.drop_invalid(C.normalise(raw)).select(*RAW_KEY, "UnitPrice")),
    "cln_impute_customer": _dirty(lambda raw: C.impute_customer(raw).select("InvoiceNo", "StockCode", "CustomerID")),
    "cln_impute_description": _dirty(
        lambda raw: C.impute_description(raw).select("InvoiceNo", "StockCode", "Description")
    ),
    "cln_dedupe": _dirty(
        lambda raw: C.dedupe(C.impute_description(C.impute_customer(C.drop_invalid(C.normalise(raw)))))
    ),
    "cln_cast": _dirty(
        lambda raw: C.cast_types(raw)
        .select("InvoiceNo", "StockCode", "Quantity", F.col("UnitPrice").cast("double").alias("UnitPrice"), "InvoiceDate")
    ),
    "cln_stats": _dirty(C.cleaning_stats),
    "cln_all": _dirty(lambda raw: C.clean(raw).withColumn("UnitPrice", F.col("UnitPrice").cast("double"))),
}

# --- incremental load --------------------------------------------------------------------


def _watermark_log(runs: DataFrame) -> DataFrame:
    return runs.select(
        F.col("source_file").alias("file_path"),
        F.col("source_hash").alias("file_hash"),
        F.when(F.col("status") == S.SUCCESS, F.col("started_at")).alias("high_watermark_timestamp"),
        F.col("rows_inserted").alias("rows_processed"),
        F.col("started_at").alias("created_at"),
    )


def _mark(frame: DataFrame) -> DataFrame:
    return frame.sparkSession.range(1).select(moment(CUTOFF).alias("high_watermark"))


def inc_antijoin(fact: DataFrame) -> DataFrame:
    """The whole table as a batch against a target that holds everything up to a date."""
    target = fact.where(F.col("invoice_timestamp") < moment(CUTOFF))
    return I.not_in_target(I.unique_in_batch(fact), target).select(*LINE, _amount())


def inc_load_run(spark: SparkSession, folder: str) -> DataFrame:
    """Files to fact table, setting bad rows aside; a second run must add nothing."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    options = LoadOptions(on_invalid="quarantine", as_of=AS_OF)
    path = exported_csv(spark, folder)
    for outcome in (load_files(lake, path, options), load_files(lake, path, options)):
        if outcome.status == S.FAILED:
            raise RuntimeError(outcome.error_message)
    return lake.fact().select(*LINE, _amount(), "description", "customer_id", "country", "invoice_year", "invoice_month")


def inc_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows as files in a landing folder, streamed through the same load; the stream starts
    twice."""
    lake, landing = Lake(spark, fresh_path(spark, "lake")), exported_csv(spark, folder)
    options = LoadOptions(on_invalid="quarantine", as_of=AS_OF, late_policy="antijoin")
    checkpoint = fresh_path(spark, "checkpoint")
    for _ in range(2):
        stream_load(landing_stream(spark, landing, pattern="*.csv.gz"), lake, checkpoint, options).awaitTermination()
    return lake.fact().select(*LINE, _amount(), "description", "customer_id", "country", "invoice_year", "invoice_month")


INCREMENTAL: dict[str, Query] = {
    "inc_high_watermark": _fact(I.high_watermark),
    "inc_filter": _dirty(
        lambda raw: I.after_watermark(raw, _mark(raw), to_moment(F.col("InvoiceDate"))).select(*RAW_KEY)
    ),
    "inc_filter_counts": _dirty(lambda raw: I.watermark_counts(raw, _mark(raw), to_moment(F.col("InvoiceDate")))),
    "inc_antijoin": _fact(inc_antijoin),
    "inc_batch_unique": _fact(lambda fact: I.unique_in_batch(fact).select(*LINE, _amount())),
    "inc_watermark_upsert": _runs(lambda runs: I.current_watermarks(_watermark_log(runs))),
    "inc_load_run": inc_load_run,
    "inc_stream": inc_stream,
}

# --- run audit, quality, monitoring ------------------------------------------------------


def _events(runs: DataFrame) -> DataFrame:
    failed = F.col("status") == S.FAILED
    return (
        A.start_events(runs)
        .unionByName(A.complete_events(runs.where(~failed)))
        .unionByName(A.fail_events(runs.where(failed)))
    )


def _plain(runs: DataFrame) -> DataFrame:
    return runs.withColumn("execution_duration", F.col("execution_duration").cast("double"))


def _event_rows(step: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return _runs(lambda runs: _plain(step(runs)).select("run_id", "event_seq", "status", *columns))


RUN = [
    "run_id", "pipeline_name", "started_at", "status", "source_file", "rows_read", "rows_valid", "rows_invalid",
    "rows_inserted", "rows_skipped", "error_message", "execution_duration",
]


def _run_state(runs: DataFrame) -> DataFrame:
    return _plain(A.current_runs(_events(runs))).select(*RUN)


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    raw = T.dirty_rows(spark, folder)
    return Q.summary(
        "run-1", V.validate(raw, AS_OF), C.cleaning_stats(raw), Q.transformed_counts(add_features(C.clean(raw))),
        duration_seconds=2.0,
    )


AUDIT: dict[str, Query] = {
    "run_start": _event_rows(A.start_events, "pipeline_name", "started_at", "source_file"),
    "run_complete": _event_rows(
        lambda runs: A.complete_events(runs.where(F.col("status") != S.FAILED)),
        "rows_read", "rows_inserted", "rows_skipped", "execution_duration",
    ),
    "run_fail": _event_rows(
        lambda runs: A.fail_events(runs.where(F.col("status") == S.FAILED)), "error_message", "execution_duration"
    ),
    "run_current": _runs(_run_state),
    "run_get": _runs(lambda runs: A.run_by_id(_run_state(runs), "77")),
    "lineage_record": _runs(
        lambda runs: A.lineage_entries(runs.where(F.col("status").isin(S.SUCCESS, S.PARTIAL)))
        .select("run_id", "source_file", "source_row_count", "target_table", "target_row_count", "transformation_version")
    ),
    "lineage_by_run": lambda spark, folder: A.lineage_by_run(T.lineage_log(spark, folder), "77"),
    "lineage_by_file": lambda spark, folder: A.lineage_by_file(T.lineage_log(spark, folder), "user_8.csv"),
    "dq_summary": _quality,
    "dq_threshold": _runs(
        lambda runs: Q.with_thresholds(runs, "rows_invalid", "rows_read")
        .select("run_id", "rows_read", "rows_invalid", "threshold_status", "alert_message")
    ),
}

def _day_as_moment(rows: DataFrame) -> DataFrame:
    """Dates as midnight timestamps, which engines hand out alike."""
    return rows.withColumn("run_date", F.col("run_date").cast("timestamp_ntz"))


MONITORING: dict[str, Query] = {
    "v_latest_runs": _runs(M.latest_runs_view),
    "v_failed_runs": _runs(M.failed_runs_view),
    "v_run_daily": _runs(lambda runs: _day_as_moment(M.daily_view(runs))),
    "v_dq": _runs(M.quality_view),
    "mon_latest": _runs(lambda runs: _plain(M.latest_run(runs)).select(*RUN)),
    "mon_recent": _runs(lambda runs: _plain(M.recent_runs(runs)).select(*RUN)),
    "mon_failed": _runs(lambda runs: _plain(M.failed_runs(runs)).select(*RUN)),
    "mon_daily": _runs(lambda runs: _day_as_moment(M.daily_summary(runs))),
    "mon_dq": _runs(M.quality_summary),
    "mon_lineage": lambda spark, folder: M.lineage(T.lineage_log(spark, folder)),
    "mon_health": _runs(M.health),
    "mon_counters": _runs(M.counters),
}


def queries() -> dict[str, Query]:
    return {**SOURCES, **VALIDATION, **CLEANING, **INCREMENTAL, **AUDIT, **MONITORING}
