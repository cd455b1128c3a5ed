"""SQL twins of the load-side queries, insights and report packages."""

from __future__ import annotations

import re

from tillworks.operators.insights import RULES, Thresholds
from tillworks.plans import oracles as O

AS_OF = "TIMESTAMP '2001-01-01 00:00:00'"
CUTOFF = "TIMESTAMP '1998-01-01 00:00:00'"

WORDS = "['nan', 'None', 'NULL', '<NA>']"
MOMENT = "coalesce(TRY_CAST(InvoiceDate AS TIMESTAMP), try_strptime(InvoiceDate, '%m/%d/%Y %H:%M'))"


def missing(name: str) -> str:
    return f"({name} IS NULL OR upper(trim({name})) IN ('', 'NAN', 'NONE', 'NULL', '<NA>'))"


DIRTY = f"""
dirty AS (
  SELECT CASE WHEN l_orderkey % 101 = 0 THEN '  '
              WHEN l_returnflag = 'R' THEN ' c' || CAST(l_orderkey AS VARCHAR)
              ELSE CAST(l_orderkey AS VARCHAR) || ' ' END AS InvoiceNo,
         CAST(l_partkey AS VARCHAR) || 'a' AS StockCode,
         CASE WHEN l_partkey % 113 = 0 THEN ' None' WHEN copy = 1 THEN 'Copy of ' || p_name
              WHEN l_partkey % 109 = 0 THEN NULL ELSE ' ' || chr(9) || p_name END AS Description,
         CASE WHEN l_partkey % 107 = 0 THEN 'x'
              ELSE CAST(CAST(l_quantity AS INTEGER) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS VARCHAR)
                   || CASE WHEN copy = 1 THEN '.0' ELSE '' END
         END AS Quantity,
         CASE WHEN l_orderkey % 103 = 0 THEN 'bad-date' WHEN l_orderkey % 5 = 1 THEN strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS InvoiceDate,
         CASE WHEN l_partkey % 97 = 0 THEN '-' ELSE '' END
           || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS UnitPrice,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN {WORDS}[o_custkey % 4 + 1]
              WHEN o_custkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) || '.0' ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
         ' ' || lower(n_name) || CASE WHEN o_custkey % 5 = 0 THEN ' west isle' || chr(9) ELSE ' ' END AS Country
  {O.JOINS}
  CROSS JOIN (VALUES (0), (1)) copies(copy) WHERE copy = 0 OR l_orderkey % 4 = 0
)
"""

TITLE = (
    "array_to_string([upper(w[1]) || w[2:] FOR w IN string_split(lower(trim(Country)), ' ')], ' ')"
)
CUSTOMER = f"CASE WHEN {missing('CustomerID')} THEN 'GUEST' ELSE regexp_replace(trim(CustomerID), '^([0-9]+)\\.0$', '\\1') END"
DESCRIPTION = f"CASE WHEN {missing('Description')} THEN 'UNKNOWN DESCRIPTION' ELSE trim(Description) END"
# One row per five-column key, quantities by value; of several the first by the other columns.
FIRST = """
row_number() OVER (
  PARTITION BY InvoiceNo, StockCode, coalesce(CAST(TRY_CAST(Quantity AS DOUBLE) AS VARCHAR), Quantity), InvoiceDate, CustomerID
  ORDER BY Description, Quantity, UnitPrice, Country)
"""
CLEAN = f"""
{DIRTY},
norm AS (
  SELECT upper(trim(InvoiceNo)) AS InvoiceNo, upper(trim(StockCode)) AS StockCode, trim(Description) AS Description,
         trim(Quantity) AS Quantity, trim(InvoiceDate) AS InvoiceDate, trim(UnitPrice) AS UnitPrice,
         trim(CustomerID) AS CustomerID, {TITLE} AS Country
  FROM dirty
),
possible AS (SELECT * FROM norm WHERE TRY_CAST(UnitPrice AS DOUBLE) >= 0 AND InvoiceNo NOT IN ('', 'NAN')),
filled AS (
  SELECT * REPLACE ({CUSTOMER} AS CustomerID, {DESCRIPTION} AS Description) FROM possible
),
unique_rows AS (SELECT * EXCLUDE (n) FROM (SELECT *, {FIRST} AS n FROM filled) WHERE n = 1),
typed AS (
  SELECT InvoiceNo, StockCode, Description, coalesce(TRY_CAST(Quantity AS BIGINT), 0) AS Quantity,
         {MOMENT} AS InvoiceDate,
         coalesce(TRY_CAST(UnitPrice AS DECIMAL(14,4)), 0) AS UnitPrice, CustomerID, Country
  FROM unique_rows
)
"""

BAD_DATE = f"{MOMENT} IS NULL"
BAD_QUANTITY = "(Quantity IS NOT NULL AND TRY_CAST(Quantity AS DOUBLE) IS NULL)"
BAD_PRICE = "(UnitPrice IS NOT NULL AND TRY_CAST(UnitPrice AS DOUBLE) IS NULL)"
NO_INVOICE = "coalesce(trim(InvoiceNo), '') = ''"
NEGATIVE = "coalesce(TRY_CAST(UnitPrice AS DOUBLE) < 0, FALSE)"
FUTURE = f"coalesce({MOMENT} > {AS_OF}, FALSE)"
RETURNED = "coalesce(TRY_CAST(Quantity AS DOUBLE) < 0, FALSE)"
HITS = {
    "INVALID_DATE_FORMAT": f"COUNT(*) FILTER ({BAD_DATE})",
    "INVALID_NUMERIC_TYPE": f"COUNT(*) FILTER ({BAD_QUANTITY}) + COUNT(*) FILTER ({BAD_PRICE})",
    "MISSING_INVOICE_NO": f"COUNT(*) FILTER ({NO_INVOICE})",
    "NEGATIVE_UNIT_PRICE": f"COUNT(*) FILTER ({NEGATIVE})",
    "FUTURE_INVOICE_DATE": f"COUNT(*) FILTER ({FUTURE})",
}
BROKEN = {
    "INVALID_DATE_FORMAT": BAD_DATE,
    "INVALID_NUMERIC_TYPE": f"({BAD_QUANTITY} OR {BAD_PRICE})",
    "MISSING_INVOICE_NO": NO_INVOICE,
    "NEGATIVE_UNIT_PRICE": NEGATIVE,
    "FUTURE_INVOICE_DATE": FUTURE,
}
ANY = " OR ".join(f"({rule})" for rule in BROKEN.values())
ALL_HITS = " + ".join(HITS.values())


def on_dirty(query: str) -> str:
    return f"WITH {DIRTY} {query}"


def on_clean(query: str) -> str:
    return f"WITH {CLEAN} {query}"


def counter(expression: str, name: str) -> str:
    return on_dirty(f"SELECT {expression} AS {name} FROM dirty")


VALIDATION = {
    "val_empty": on_dirty("SELECT COUNT(*) AS total_rows, COUNT(*) = 0 AS is_empty FROM dirty"),
    "val_invalid_date": counter(HITS["INVALID_DATE_FORMAT"], "invalid_dates"),
    "val_invalid_numeric": counter(HITS["INVALID_NUMERIC_TYPE"], "invalid_numbers"),
    "val_missing_invoice": counter(HITS["MISSING_INVOICE_NO"], "missing_invoices"),
    "val_negative_price": counter(HITS["NEGATIVE_UNIT_PRICE"], "negative_prices"),
    "val_future_date": counter(HITS["FUTURE_INVOICE_DATE"], "future_dates"),
    "val_cancellation_count": counter(f"COUNT(*) FILTER ({RETURNED})", "cancellations"),
    "val_report": on_dirty(f"""
        SELECT COUNT(*) AS rows_read, COUNT(*) AS total_rows,
               greatest(0, COUNT(*) - least(COUNT(*), {ALL_HITS})) AS valid_rows,
               least(COUNT(*), {ALL_HITS}) AS invalid_rows, ({ALL_HITS}) = 0 AS is_valid, COUNT(*) = 0 AS is_empty,
               COUNT(*) FILTER ({ANY}) AS distinct_invalid_rows, COUNT(*) FILTER ({RETURNED}) AS cancellation_rows,
               {', '.join(f'{count} AS {name}' for name, count in HITS.items())}
        FROM dirty"""),
    "val_report_by_category": on_dirty(" UNION ALL ".join(
        f"SELECT '{name}' AS category, {count} AS violations FROM dirty HAVING ({count}) > 0"
        for name, count in HITS.items()
    )),
    "val_quarantine": on_dirty(
        "SELECT InvoiceNo, StockCode, Quantity, InvoiceDate, CustomerID, concat_ws(',', "
        + ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in BROKEN.items())
        + f") AS violations FROM dirty WHERE {ANY}"
    ),
}

STRIPPED = ", ".join(
    f"trim({name}) AS {name}" for name in
    ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
)
KEYS = "InvoiceNo, StockCode, Quantity, InvoiceDate, CustomerID"
NULLS = (
    f"(SELECT COUNT(*) FILTER ({missing('CustomerID')}) + COUNT(*) FILTER ({missing('Description')}) FROM possible)"
)

CLEANING = {
    "cln_trim": on_dirty(f"SELECT {STRIPPED} FROM dirty"),
    "cln_upper_codes": on_dirty(
        "SELECT upper(trim(InvoiceNo)) AS InvoiceNo, upper(trim(StockCode)) AS StockCode FROM dirty"
    ),
    "cln_title_country": on_dirty(f"SELECT InvoiceNo, StockCode, {TITLE} AS Country FROM dirty"),
    "cln_drop_invalid": on_clean(f"SELECT {KEYS}, UnitPrice FROM possible"),
    "cln_impute_customer": on_dirty(
        f"SELECT InvoiceNo, StockCode, {CUSTOMER} AS CustomerID FROM dirty"
    ),
    "cln_impute_description": on_dirty(
        f"SELECT InvoiceNo, StockCode, {DESCRIPTION} AS Description FROM dirty"
    ),
    "cln_dedupe": on_clean("SELECT * FROM unique_rows"),
    "cln_cast": on_dirty(
        "SELECT InvoiceNo, StockCode, coalesce(TRY_CAST(Quantity AS BIGINT), 0) AS Quantity, "
        "CAST(coalesce(TRY_CAST(UnitPrice AS DECIMAL(14,4)), 0) AS DOUBLE) AS UnitPrice, "
        f"{MOMENT} AS InvoiceDate FROM dirty"
    ),
    "cln_stats": on_clean(f"""
        SELECT (SELECT COUNT(*) FROM dirty) AS initial_rows,
               (SELECT COUNT(*) FROM possible) - (SELECT COUNT(*) FROM unique_rows) AS duplicates_removed,
               (SELECT COUNT(*) FROM dirty) - (SELECT COUNT(*) FROM possible) AS invalid_prices_removed,
               {NULLS} AS nulls_imputed, (SELECT COUNT(*) FROM unique_rows) AS final_rows"""),
    "cln_all": on_clean("SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM typed"),
}

AMOUNT = "CAST(total_amount AS DOUBLE) AS total_amount"
LINE = f"invoice_no, stock_code, quantity, invoice_timestamp, {AMOUNT}"
# One row per natural key; copies differ in quantity only.
UNIQUE = """
unique_fact AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY invoice_no, stock_code, invoice_timestamp ORDER BY description, quantity) AS copy
    FROM fact
  ) WHERE copy = 1
)
"""

# Good rows of the dirty view, cleaned, with features, one per natural key.
LOADED = f"""
WITH {DIRTY},
good AS (
  SELECT upper(trim(InvoiceNo)) AS InvoiceNo, upper(trim(StockCode)) AS StockCode, {DESCRIPTION} AS Description, Quantity,
         InvoiceDate, UnitPrice, {CUSTOMER} AS CustomerID, {TITLE} AS Country
  FROM dirty WHERE NOT ({ANY})
),
shaped AS (
  SELECT InvoiceNo AS invoice_no, StockCode AS stock_code, Description AS description, CAST(Quantity AS INTEGER) AS quantity,
         CAST(UnitPrice AS DECIMAL(10,2)) AS unit_price, {MOMENT} AS invoice_timestamp, CustomerID AS customer_id, Country AS country
  FROM (SELECT *, {FIRST} AS n FROM good) WHERE n = 1
),
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY invoice_no, stock_code, invoice_timestamp ORDER BY description, quantity) AS copy
  FROM shaped
)
SELECT invoice_no, stock_code, quantity, invoice_timestamp, CAST(quantity * unit_price AS DOUBLE) AS total_amount,
       description, customer_id, country, CAST(year(invoice_timestamp) AS SMALLINT) AS invoice_year,
       CAST(month(invoice_timestamp) AS SMALLINT) AS invoice_month
FROM numbered WHERE copy = 1
"""

RUNS = """
base AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
runs AS (
  SELECT *, CASE WHEN status IN ('SUCCESS', 'PARTIAL') THEN rows_valid ELSE 0 END AS rows_inserted,
         CASE WHEN status = 'SKIPPED' THEN rows_read ELSE 0 END AS rows_skipped
  FROM (
    SELECT CAST(event_id AS VARCHAR) AS run_id, 'fact_sales' AS pipeline_name, ts AS started_at,
           ts + to_seconds(CAST(floor(value) AS INTEGER)) AS completed_at,
           CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' WHEN 'view' THEN 'PARTIAL'
                ELSE 'SUCCESS' END AS status,
           'user_' || CAST(user_id AS VARCHAR) || '.csv' AS source_file,
           sha256('user_' || CAST(user_id AS VARCHAR)) AS source_hash,
           k * 10 AS rows_read, event_id % (k + 1) AS rows_invalid, k * 10 - event_id % (k + 1) AS rows_valid,
           CASE WHEN event_type = 'error' THEN 'error' END AS error_message,
           CAST(value AS DECIMAL(10,3)) AS execution_duration
    FROM base
  )
)
"""


def on_runs(query: str) -> str:
    return f"WITH {RUNS} {query}"


DURATION = "CAST(execution_duration AS DOUBLE) AS execution_duration"
RUN = (
    "run_id, pipeline_name, started_at, status, source_file, rows_read, rows_valid, rows_invalid, "
    f"rows_inserted, rows_skipped, error_message, {DURATION}"
)
NEWEST = "ORDER BY started_at DESC, run_id DESC"
MILLIS = "CAST(SUM(execution_duration) * 1000 AS HUGEINT)"
AVG_DURATION = O.half_up(MILLIS, "1000 * COUNT(execution_duration)")
QUALITY = f"CASE WHEN rows_read > 0 THEN {O.percent('rows_valid', 'rows_read')} ELSE 100.0 END"
DAILY = f"""
SELECT CAST(CAST(started_at AS DATE) AS TIMESTAMP) AS run_date, COUNT(*) AS total_runs,
       COUNT(*) FILTER (status = 'SUCCESS') AS successful_runs, COUNT(*) FILTER (status = 'FAILED') AS failed_runs,
       CAST(SUM(rows_read) AS BIGINT) AS total_rows_read, CAST(SUM(rows_inserted) AS BIGINT) AS total_rows_inserted,
       CAST(SUM(rows_skipped) AS BIGINT) AS total_rows_skipped, {AVG_DURATION} AS avg_duration_seconds
FROM runs GROUP BY 1
"""
DQ = f"SELECT run_id, source_file, rows_read, rows_valid, rows_invalid, {QUALITY} AS data_quality_rate_pct, started_at FROM runs"
LINEAGE = (
    "SELECT 'l' || run_id AS lineage_id, run_id, source_file, source_hash, rows_read AS source_row_count, "
    "'fact_sales' AS target_table, rows_inserted AS target_row_count, '1.0.0' AS transformation_version, "
    "started_at AS created_at FROM runs"
)
# Current state of merged run events: failed runs keep zero counters.
MERGED = """
SELECT run_id, pipeline_name, started_at, status, source_file,
       CASE WHEN status = 'FAILED' THEN 0 ELSE rows_read END AS rows_read,
       CASE WHEN status = 'FAILED' THEN 0 ELSE rows_valid END AS rows_valid,
       CASE WHEN status = 'FAILED' THEN 0 ELSE rows_invalid END AS rows_invalid,
       rows_inserted, rows_skipped, error_message, CAST(execution_duration AS DOUBLE) AS execution_duration
FROM runs
"""
RATE = "(100.0 * rows_invalid / nullif(rows_read, 0))"
RATE_TEXT = O.signed_fixed(f"coalesce({O.percent('rows_invalid', 'rows_read', 1)}, 0)")

DQ_STATUS = f"CASE WHEN coalesce({RATE}, 0) >= 15 THEN 'CRITICAL' WHEN coalesce({RATE}, 0) >= 5 THEN 'WARNING' ELSE 'PASS' END"
DQ_ALERT = (
    f"CASE {DQ_STATUS} WHEN 'CRITICAL' THEN 'High invalid row rate detected: ' || {RATE_TEXT} || '% (Threshold: 15.0%)' "
    f"WHEN 'WARNING' THEN 'Elevated invalid row rate: ' || {RATE_TEXT} || '% (Threshold: 5.0%)' END"
)

AUDIT = {
    "run_start": on_runs(
        "SELECT run_id, 0 AS event_seq, 'RUNNING' AS status, pipeline_name, started_at, source_file FROM runs"
    ),
    "run_complete": on_runs(
        f"SELECT run_id, 1 AS event_seq, status, rows_read, rows_inserted, rows_skipped, {DURATION} FROM runs WHERE status <> 'FAILED'"
    ),
    "run_fail": on_runs(
        f"SELECT run_id, 2 AS event_seq, status, error_message, {DURATION} FROM runs WHERE status = 'FAILED'"
    ),
    "run_current": on_runs(MERGED),
    "run_get": on_runs(f"{MERGED} WHERE run_id = '77'"),
    "lineage_record": on_runs(
        "SELECT run_id, source_file, rows_read AS source_row_count, 'fact_sales' AS target_table, "
        "rows_inserted AS target_row_count, '1.0.0' AS transformation_version FROM runs WHERE status IN ('SUCCESS', 'PARTIAL')"
    ),
    "lineage_by_run": on_runs(f"{LINEAGE} WHERE run_id = '77'"),
    "lineage_by_file": on_runs(f"{LINEAGE} WHERE source_file = 'user_8.csv'"),
    "dq_threshold": on_runs(
        f"SELECT run_id, rows_read, rows_invalid, {DQ_STATUS} AS threshold_status, {DQ_ALERT} AS alert_message FROM runs"
    ),
    "dq_summary": on_clean(f"""
        , report AS (
          SELECT COUNT(*) AS rows_read, least(COUNT(*), {ALL_HITS}) AS rows_invalid,
                 COUNT(*) - least(COUNT(*), {ALL_HITS}) AS valid_rows FROM dirty
        ),
        made AS (
          SELECT COUNT(*) FILTER (InvoiceNo LIKE 'C%' OR Quantity < 0) AS cancelled,
                 COUNT(*) FILTER (CustomerID = 'GUEST') AS guests, COUNT(*) AS final_rows FROM typed
        )
        SELECT 'run-1' AS run_id, 'PySpark' AS processing_engine, rows_read AS total_rows, valid_rows,
               rows_invalid AS invalid_rows, {O.percent('valid_rows', 'rows_read')} AS data_quality_score_pct,
               {NULLS} AS null_imputed_count,
               (SELECT COUNT(*) FROM possible) - final_rows AS duplicate_removed_count,
               rows_read - (SELECT COUNT(*) FROM possible) AS invalid_price_count,
               cancelled AS cancellation_count, guests AS guest_customer_count,
               {O.half_up('rows_read', '2')} AS records_per_second, 0.0::DOUBLE AS duplicate_skip_rate_pct,
               {DQ_STATUS} AS threshold_status, {DQ_ALERT} AS alert_message
        FROM report, made"""),
}

HEALTH_RATE = "coalesce({}, 100)".format(O.percent("ok", "n", 1))
MONITORING = {
    "v_latest_runs": on_runs(
        "SELECT run_id, pipeline_name, source_file, status, started_at, completed_at, rows_read, rows_inserted, "
        f"rows_skipped, rows_invalid, {DURATION} FROM runs {NEWEST} LIMIT 50"
    ),
    "v_failed_runs": on_runs(
        f"SELECT run_id, pipeline_name, source_file, started_at, error_message, {DURATION} FROM runs WHERE status = 'FAILED'"
    ),
    "v_run_daily": on_runs(DAILY),
    "v_dq": on_runs(DQ),
    "mon_latest": on_runs(f"SELECT {RUN} FROM runs {NEWEST} LIMIT 1"),
    "mon_recent": on_runs(f"SELECT {RUN} FROM runs {NEWEST} LIMIT 20"),
    "mon_failed": on_runs(f"SELECT {RUN} FROM runs WHERE status = 'FAILED' {NEWEST} LIMIT 20"),
    "mon_daily": on_runs(f"{DAILY} ORDER BY 1 DESC LIMIT 30"),
    "mon_dq": on_runs(f"{DQ} {NEWEST} LIMIT 20"),
    "mon_lineage": on_runs(f"{LINEAGE} ORDER BY started_at DESC, 'l' || run_id DESC LIMIT 20"),
    "mon_health": on_runs(f"""
        , recent AS (SELECT * FROM runs {NEWEST} LIMIT 50),
        counted AS (
          SELECT COUNT(*) AS n, COUNT(*) FILTER (status = 'FAILED') AS bad, COUNT(*) FILTER (status = 'SUCCESS') AS ok,
                 CAST(coalesce(SUM(rows_inserted), 0) AS BIGINT) AS inserted, coalesce({AVG_DURATION}, 0) AS duration
          FROM recent
        )
        SELECT CASE WHEN n = 0 THEN 'NO_RUNS' WHEN {HEALTH_RATE} < 80 OR bad > 2 THEN 'CRITICAL'
                    WHEN {HEALTH_RATE} < 95 OR bad > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS health_status,
               {HEALTH_RATE} AS success_rate_pct, n AS total_runs, bad AS failed_runs,
               inserted AS total_rows_inserted, duration AS avg_duration_seconds
        FROM counted"""),
    "mon_counters": on_runs(" UNION ALL ".join(
        f"SELECT '{name}' AS metric, '{kind}' AS type, CAST({value} AS DOUBLE) AS value FROM runs"
        for name, kind, value in [
            ("pipeline_runs_total", "counter", "COUNT(*)"),
            ("pipeline_failures_total", "counter", "COUNT(*) FILTER (status = 'FAILED')"),
            ("pipeline_duration_seconds_total", "counter", "SUM(execution_duration)"),
            ("rows_processed_total", "counter", "SUM(rows_read)"),
            ("rows_inserted_total", "counter", "SUM(rows_inserted)"),
            ("rows_skipped_total", "counter", "SUM(rows_skipped)"),
        ]
    ) + f" UNION ALL (SELECT 'data_quality_score', 'gauge', {QUALITY} FROM runs {NEWEST} LIMIT 1)"),
}

TABLE_ORDER = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
NEED = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice"]
NATION = "string_split(trim(Country), ' ')[1]"
SHORT_ORDER = [name for name in TABLE_ORDER if name != "UnitPrice"]
DIGESTS = """
SELECT 'd' || CAST(o_custkey % 7 AS VARCHAR) AS part, CAST(COUNT(*) AS BIGINT) AS n_lines,
       CAST(SUM(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS VARCHAR) AS digest_a,
       CAST(SUM(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS VARCHAR) AS digest_b, TRUE AS is_utf8
FROM (SELECT o_custkey, md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR)) AS h FROM orders)
WHERE {where} GROUP BY 1
"""
SOURCES = {
    "src_csv": on_dirty(
        f"SELECT * REPLACE (CASE WHEN NOT list_contains({WORDS}, CustomerID) THEN CustomerID END AS CustomerID, "
        "CASE WHEN InvoiceNo NOT LIKE ' c%' THEN Country END AS Country) FROM dirty"
    ),
    "src_csv_encoding": on_dirty("SELECT InvoiceNo, StockCode, Quantity, 'é£ ' || Country AS Country FROM dirty"),
    "src_header_check": on_dirty(
        f"SELECT country, position, name, present, required FROM (SELECT DISTINCT {NATION} AS country FROM dirty) d, (VALUES "
        + ", ".join(f"(CAST({i} AS INTEGER), '{name}', TRUE, {name in NEED})" for i, name in enumerate(SHORT_ORDER))
        + f", (CAST({len(SHORT_ORDER)} AS INTEGER), 'UnitPrice', FALSE, TRUE)) t(position, name, present, required)"
    ),
    "src_extra_columns": on_dirty(f"SELECT DISTINCT {NATION} AS country, CAST(8 AS INTEGER) AS position, 'Channel' AS name FROM dirty"),
    "src_duplicate_header": on_dirty(
        f"SELECT DISTINCT {NATION} AS country, CAST(p AS INTEGER) AS position, 'InvoiceNo' AS name "
        "FROM dirty, (VALUES (0), (2)) t(p)"
    ),
    "src_file_manifest": DIGESTS.format(where="TRUE"),
    "src_new_files": DIGESTS.format(where="o_custkey % 7 > 2"),
    "lake_summary": O.on_fact(
        "SELECT zone, CASE zone WHEN 'raw' THEN 3 * LEAST(years, 1) WHEN 'processed' THEN 2 * years ELSE 0 END AS file_count, "
        "TRUE AS has_size FROM (VALUES ('raw'), ('staged'), ('processed')) z(zone), "
        "(SELECT COUNT(DISTINCT invoice_year) AS years FROM fact)"
    ),
    "lake_write": O.on_fact(
        "SELECT invoice_no AS InvoiceNo, stock_code AS StockCode, CAST(quantity AS INTEGER) AS Quantity, "
        "CAST(total_amount AS DOUBLE) AS TotalPrice, CAST(invoice_year AS INTEGER) AS InvoiceYear, "
        "CAST(invoice_month AS INTEGER) AS InvoiceMonth FROM fact"
    ),
    "lake_read": O.on_fact(
        "SELECT invoice_no AS InvoiceNo, stock_code AS StockCode, CAST(total_amount AS DOUBLE) AS TotalPrice FROM fact"
    ),
    "stage_write": O.on_fact(
        "SELECT invoice_no AS InvoiceNo, stock_code AS StockCode, CAST(quantity AS INTEGER) AS Quantity, "
        "CAST(total_amount AS DOUBLE) AS TotalPrice, revenue_bucket AS RevenueBucket FROM fact"
    ),
    "fact_load": O.on_fact(f"SELECT {LINE}, invoice_year, invoice_month FROM fact"),
    "fact_column_map": O.on_fact(
        "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount) FROM fact"
    ),
    "fact_constraints": O.on_fact(
        "SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (description IS NULL OR quantity IS NULL OR unit_price IS NULL "
        "OR invoice_timestamp IS NULL OR country IS NULL) AS null_in_required_column, "
        "COUNT(*) FILTER (quantity = 0) AS quantity_zero, COUNT(*) FILTER (unit_price < 0) AS unit_price_negative, "
        "COUNT(*) FILTER (invoice_month NOT BETWEEN 1 AND 12) AS month_out_of_range, "
        "COUNT(*) FILTER (invoice_quarter NOT BETWEEN 1 AND 4) AS quarter_out_of_range, "
        "COUNT(*) FILTER (invoice_hour NOT BETWEEN 0 AND 23) AS hour_out_of_range FROM fact"
    ),
    "dim_customer": O.on_fact(
        ", numbered AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY invoice_timestamp DESC, "
        "country DESC, customer_type DESC) AS n FROM fact WHERE customer_id <> 'GUEST') "
        "SELECT customer_id, customer_type, country FROM numbered WHERE n = 1 UNION ALL SELECT 'GUEST', 'Guest', 'Unknown'"
    ),
    "dim_product": O.on_fact(
        ", numbered AS (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY invoice_timestamp DESC, "
        "description DESC) AS n FROM fact) SELECT stock_code, description FROM numbered WHERE n = 1"
    ),
    "gen_synthetic": """
        SELECT CASE WHEN i % 10 = 0 THEN 'C' ELSE '' END || '536' ||
               CASE WHEN i < 1000 THEN lpad(CAST(i AS VARCHAR), 3, '0') ELSE CAST(i AS VARCHAR) END AS InvoiceNo,
               '8512' || CAST(i % 10 AS VARCHAR) || 'A' AS StockCode,
               CASE WHEN i % 2 = 0 THEN 'GREEN GLASS TEA LAMP' END AS Description,
               CAST(CASE WHEN i % 10 = 0 THEN -1 ELSE 6 END AS BIGINT) AS Quantity,
               TIMESTAMP '2010-12-01 08:26:00' AS InvoiceDate, CAST(2.55 AS DOUBLE) AS UnitPrice,
               CASE WHEN i % 3 <> 0 THEN '17850' END AS CustomerID, 'United Kingdom' AS Country
        FROM (SELECT o_orderkey AS i FROM orders)""",
}

INCREMENTAL = {
    "inc_high_watermark": O.on_fact("SELECT MAX(invoice_timestamp) AS high_watermark FROM fact"),
    "inc_filter": on_dirty(f"SELECT {KEYS} FROM dirty WHERE {MOMENT} > {CUTOFF}"),
    "inc_filter_counts": on_dirty(
        f"SELECT COUNT(*) FILTER (coalesce({MOMENT} > {CUTOFF}, FALSE)) AS kept_rows, "
        f"COUNT(*) FILTER (NOT coalesce({MOMENT} > {CUTOFF}, FALSE)) AS skipped_rows FROM dirty"
    ),
    "inc_antijoin": f"WITH {O.FACT}, {UNIQUE} SELECT {LINE} FROM unique_fact WHERE invoice_timestamp >= {CUTOFF}",
    "inc_batch_unique": f"WITH {O.FACT}, {UNIQUE} SELECT {LINE} FROM unique_fact",
    "inc_watermark_upsert": on_runs("""
        SELECT source_hash AS file_hash, arg_min(source_file, started_at) AS file_path,
               arg_max(started_at, started_at) FILTER (status = 'SUCCESS') AS high_watermark_timestamp,
               CAST(SUM(rows_inserted) AS BIGINT) AS rows_processed, MIN(started_at) AS created_at
        FROM runs GROUP BY source_hash"""),
    "inc_load_run": LOADED,
    "inc_stream": LOADED,
}

# --- insights and packages ---------------------------------------------------------------


def _text(template: str, value: str, **figures: str) -> str:
    text = template.replace("'", "''")
    for name, column in {"value": value, **figures}.items():
        text = text.replace("{" + name + "}", f"' || {column} || '")
    return f"'{text}'"


def finding(rule: str, position: int, fires: str, value: str, threshold: str, **figures: str) -> str:
    category, severity, metric, title, description, advice = RULES[rule]
    return (
        f"SELECT CAST({position} AS INTEGER) AS position, '{category}' AS category, '{title}' AS title, "
        f"{_text(description, value, **figures)} AS description, '{severity}' AS severity, '{metric}' AS metric, "
        f"{value} AS value, '{threshold}' AS threshold, '{advice}' AS recommendation FROM wide WHERE {fires}"
    )


def rules(t: Thresholds = Thresholds()) -> dict[str, str]:
    cancel, growth = O.percent_text("cancel_rate"), O.percent_text("revenue_growth_pct")
    share, guests = O.percent_text("top_share"), O.percent_text("guest_share")
    return {
        "cancel_critical": finding(
            "cancel_critical", 1, f"cancel_rate >= {t.cancellation_critical}", cancel, f"{t.cancellation_critical:.1f}%",
            loss=O.money_text("impact"),
        ),
        "cancel_high": finding(
            "cancel_high", 2, f"cancel_rate >= {t.cancellation_high} AND cancel_rate < {t.cancellation_critical}",
            cancel, f"{t.cancellation_high:.1f}%",
        ),
        "growth": finding("growth", 3, f"revenue_growth_pct > {t.growth}", f"('+' || {growth})", "> 0.0%"),
        "contraction": finding("contraction", 4, "revenue_growth_pct < 0", growth, "< 0.0%"),
        "concentration": finding(
            "concentration", 5, f"top_share >= {t.product_concentration}", share, f"{t.product_concentration:.1f}%",
            name="top_product",
        ),
        "guest_ratio": finding(
            "guest_ratio", 6, f"guest_share >= {t.guest_ratio}", guests, f"{t.guest_ratio:.1f}%"
        ),
    }


def on_wide(query: str) -> str:
    return f"WITH {O.FACT}, {O.KPI_WIDE} {query}"


ALL_RULES = " UNION ALL ".join(rules().values())
INSIGHTS = {
    "ins_cancel_critical": on_wide(rules()["cancel_critical"]),
    "ins_cancel_high": on_wide(rules(Thresholds(cancellation_critical=90.0))["cancel_high"]),
    "ins_growth": on_wide(rules(Thresholds(growth=-100.0))["growth"]),
    "ins_contraction": on_wide(rules()["contraction"]),
    "ins_concentration": on_wide(rules(Thresholds(product_concentration=0.0))["concentration"]),
    "ins_guest_ratio": on_wide(rules(Thresholds(guest_ratio=0.0))["guest_ratio"]),
    "ins_all": on_wide(ALL_RULES),
}


def long_form(section: str, query: str, item: list[str], measures: list[str]) -> str:
    label = " || ' / ' || ".join(f"CAST({name} AS VARCHAR)" for name in item)
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {label} AS item, '{name}' AS measure, CAST({name} AS DOUBLE) AS value FROM ({query})"
        for name in measures
    )


WANTED = "('cancellation_rate', 'cancellation_revenue_impact', 'cancellation_count')"
PACKAGES = {
    "dash_summary": " UNION ALL ".join([
        long_form("kpis", O.KPIS["kpi_set_full"], ["kpi"], ["value"]),
        long_form("insights", INSIGHTS["ins_all"], ["title", "severity", "value"], ["position"]),
        long_form("revenue_trend", O.BY_MONTH, ["invoice_year", "invoice_month"],
                  ["total_orders", "total_units", "total_revenue", "average_order_value"]),
        long_form("top_products", O.TOP_PRODUCTS.replace("LIMIT 10", "LIMIT 5"), ["stock_code", "description"],
                  ["total_units_sold", "total_revenue", "total_orders"]),
        long_form("country_revenue", f"{O.BY_COUNTRY} ORDER BY SUM(total_amount) DESC, country LIMIT 10", ["country"],
                  ["total_orders", "total_revenue"]),
        long_form("customer_summary", O.SEGMENTS, ["customer_type"],
                  ["customer_count", "total_orders", "total_revenue", "revenue_per_customer"]),
    ]),
    "svc_cancellations": " UNION ALL ".join([
        long_form("kpis", f"SELECT * FROM ({O.KPIS['kpi_set_full']}) WHERE kpi IN {WANTED}", ["kpi"], ["value"]),
        long_form("top_returned_products", O.RETURNED, ["stock_code", "description"],
                  ["total_returned_units", "total_returned_value"]),
    ]),
}


def oracle_sql() -> dict[str, str]:
    queries = {
        **SOURCES, **VALIDATION, **CLEANING, **INCREMENTAL, **AUDIT, **MONITORING, **INSIGHTS, **PACKAGES,
    }
    # The planted white space has tabs as well, which a plain trim leaves.
    return {name: re.sub(r"\btrim\((\w+)\)", r"trim(\1, ' ' || chr(9))", sql) for name, sql in queries.items()}
