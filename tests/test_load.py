import os
import time
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import CLEAN_ROWS, THREE, fact, one, raw
from tillworks import schema as S
from tillworks.errors import SchemaError
from tillworks.operators import audit as A
from tillworks.operators import incremental as I
from tillworks.operators import monitoring as M
from tillworks.operators import validation as V
from tillworks.operators.cleaning import row_counts
from tillworks.plans import load as L
from tillworks.plans.load import Lake, LoadOptions, _counts, load_batch, load_files
from tillworks.sources import csv_files as C
from tillworks.sources import lake as Z
from tillworks.streaming.landing import landing_stream, stream_load

HEADER = ",".join(S.RAW_COLUMNS)


def write(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    os.makedirs(folder, exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as out:
        out.write(text)
    return path


def csv_text(rows, header=HEADER):
    return "\n".join([header, *[",".join("" if v is None else v for v in row) for row in rows]]) + "\n"


# --- files -------------------------------------------------------------------------------


def test_read_csv_by_header_name_with_missing_words(spark, folder):
    header = "StockCode,InvoiceNo,Quantity,UnitPrice,InvoiceDate,CustomerID,Channel"
    path = write(folder, "a.csv", f'{header}\n"A ""x"", y",1,6,2.55,2010-12-01,nan,web\n')
    row = one(C.read_transactions(spark, path))
    assert (row["InvoiceNo"], row["StockCode"], row["CustomerID"], row["Channel"]) == ("1", 'A "x", y', None, "web")


@pytest.mark.parametrize("text", ["", HEADER + "\n"])
def test_empty_files_are_refused(spark, folder, text):
    with pytest.raises(SchemaError, match="empty"):
        C.read_transactions(spark, write(folder, "a.csv", text))


def test_header_faults(spark, folder):
    with pytest.raises(SchemaError, match="duplicate"):
        C.read_raw(spark, write(folder, "a.csv", "InvoiceNo,StockCode,InvoiceNo\n1,A,2\n"))
    with pytest.raises(SchemaError, match="missing required"):
        C.read_raw(spark, write(folder, "b.csv", "InvoiceNo,Description\n1,A\n"))
    report = C.header_report(C.file_manifest(spark, os.path.join(folder, "a.csv"))).where("repeated").collect()
    assert {r["name"] for r in report} == {"InvoiceNo"}


def test_each_file_has_its_own_encoding(spark, folder):
    row = ("1", "A", "Café £5", "1", "2010-12-01", "1.00", "7", "Österreich")
    write(folder, "a.csv", csv_text([row]), "utf-8")
    write(folder, "b.csv", csv_text([("2", *row[1:])]), "latin-1")
    for r in C.read_raw(spark, folder).collect():
        assert (r["Description"], r["Country"]) == ("Café £5", "Österreich")


def test_manifest_hashes_content_not_names(spark, folder):
    text = csv_text(CLEAN_ROWS)
    write(folder, "a.csv", text)
    write(folder, "b.csv", text)
    write(folder, "c.csv", text + "x")
    found = C.file_manifest(spark, folder, "*.csv").collect()
    assert len(found) == 3 and all(len(r["file_hash"]) == 64 for r in found)
    assert len({r["file_hash"] for r in found}) == 2
    turned = "\n".join(reversed(text.split("\n")[:-1])) + "\n"
    write(folder, "d.csv", turned)
    assert len({r["file_hash"] for r in C.file_manifest(spark, folder, "[ad].csv").collect()}) == 1
    os.remove(os.path.join(folder, "d.csv"))
    known = C.file_manifest(spark, os.path.join(folder, "a.csv"))
    assert C.new_files(C.file_manifest(spark, folder, "*.csv"), known).count() == 1


def test_every_file_has_its_own_header(spark, folder):
    write(folder, "a.csv", "InvoiceNo,StockCode,Quantity,InvoiceDate,UnitPrice,Country\n1,A,2,2010-12-01,3,UK\n")
    write(folder, "b.csv", "\ufeffStockCode,InvoiceNo, UnitPrice,InvoiceDate,Quantity,\"Shop, no\",Country\nB,2,4,2010-12-02,5,x,UK\n")
    write(folder, "c.csv", "")
    rows = {r["InvoiceNo"]: r.asDict() for r in C.read_raw(spark, folder).collect()}
    assert (rows["1"]["StockCode"], rows["1"]["Quantity"], rows["1"]["Country"], rows["1"]["Shop, no"]) == ("A", "2", "UK", None)
    assert (rows["2"]["StockCode"], rows["2"]["Quantity"], rows["2"]["UnitPrice"], rows["2"]["Shop, no"]) == ("B", "5", "4", "x")
    lake = Lake(spark, folder + "-lake")
    stream_load(landing_stream(spark, folder), lake, folder + "-checkpoint").awaitTermination()
    assert {(r["invoice_no"], r["stock_code"], r["quantity"]) for r in lake.fact().collect()} == {("1", "A", 2), ("2", "B", 5)}
    write(folder, "d.csv", "InvoiceNo,StockCode\n3,C\n")
    with pytest.raises(SchemaError, match="missing required.*d.csv"):
        C.read_raw(spark, folder)


def test_names_with_signs_of_patterns(spark, folder):
    lake = Lake(spark, folder + "/lake+v1")
    done = load_files(lake, folder + "/in") if write(folder + "/in", "f[1]{x}.csv", csv_text(CLEAN_ROWS)) else None
    assert (done.status, done.rows_inserted) == (S.SUCCESS, 2), done
    sizes = {r["zone"]: r for r in Z.lake_summary(spark, lake.base).collect()}
    for zone in ("raw", "staged"):
        files = [os.path.join(d, f) for d, _, names in os.walk(f"{lake.base}/{zone}") for f in names if f.endswith(".parquet")]
        assert sizes[zone]["file_count"] == len(files) > 0
        assert sizes[zone]["total_size_mb"] == round(sum(map(os.path.getsize, files)) / 1024 / 1024, 2)


@pytest.mark.parametrize("policy", ["strict", "antijoin"])
@pytest.mark.parametrize("published", [False, True])
def test_a_load_that_broke_off_is_repeated(spark, folder, monkeypatch, policy, published):
    """The append of two months dies before or after its rename: none or all rows are seen, and the
    repeated run adds what is missing."""
    rows = [CLEAN_ROWS[0], ("9", "Z", "d", "1", "2011-01-05 08:00:00", "2.00", "1", "UK")]
    lake, path = Lake(spark, folder + "/lake"), write(folder + "/in", "a.csv", csv_text(rows))
    whole, options = Z.publish_fact, LoadOptions(late_policy=policy)

    def dies(*args):
        if published:
            whole(*args)
        raise OSError("the driver is gone")

    monkeypatch.setattr(Z, "publish_fact", dies)
    assert load_files(lake, path, options).status == S.FAILED
    assert os.listdir(lake.fact_path) and lake.fact().count() == 2 * published
    monkeypatch.setattr(Z, "publish_fact", whole)
    again = load_files(lake, path, options)
    assert (again.status, again.rows_inserted) == (S.SUCCESS, 0 if published else 2), again
    assert sorted(r["invoice_no"] for r in lake.fact().collect()) == ["536365", "9"]
    assert Z.read_from_lake(spark, lake.base, "raw").count() == 2
    assert not os.path.exists(f"{lake.base}/work") or not os.listdir(f"{lake.base}/work")


def test_a_months_folders_become_visible_together(spark, folder):
    """Between two months of an append a reader sees the rows from before."""
    path, rows = folder + "/fact", fact(spark, *THREE, ("9", "A", "d", 1, "1.00", "2009-05-01 00:00:00", "1", "UK"))
    Z.write_fact(rows.limit(1), path)
    Z.pend_fact(rows.where("invoice_year = 2009"), path, "half")
    assert Z.read_fact(spark, path).count() == 1
    Z.write_fact(rows, path)
    assert Z.read_fact(spark, path).count() == 5


def test_files_without_new_rows_are_known(spark, folder):
    lake = Lake(spark, folder + "/lake")
    load_files(lake, write(folder + "/in", "a.csv", csv_text(CLEAN_ROWS)))
    old = write(folder + "/in", "b.csv", csv_text([("1", "Z", "d", "1", "2009-01-05 08:00:00", "2.00", "1", "UK")]))
    assert load_files(lake, old).rows_skipped == 1
    assert load_files(lake, old).rows_read == 0
    assert lake.watermarks().count() == 2


# --- lake --------------------------------------------------------------------------------


def test_lake_round_trip(spark, folder):
    rows = spark.createDataFrame(
        [("1", 2010, 12, 5.0), ("2", 2011, 1, 6.0)], "InvoiceNo string, InvoiceYear int, InvoiceMonth int, TotalPrice double"
    )
    base = folder + "/lake"
    assert Z.write_to_lake(rows.limit(0), base) == "" and not os.path.exists(base + "/processed")
    path = Z.write_to_lake(rows, base, "processed", S.LAKE_PARTITIONS)
    assert os.path.isdir(f"{path}/InvoiceYear=2010/InvoiceMonth=12")
    assert Z.read_from_lake(spark, base, "processed", ["InvoiceNo"]).columns == ["InvoiceNo"]
    assert Z.read_from_lake(spark, base).count() == 2
    assert Z.read_from_lake(spark, base, "raw").count() == 0
    sizes = {r["zone"]: r["file_count"] for r in Z.lake_summary(spark, base).collect()}
    assert sizes == {"raw": 0, "staged": 0, "processed": 2}
    assert {r["file_count"] for r in Z.lake_summary(spark, base + "-none").collect()} == {0}
    with pytest.raises(ValueError):
        Z.zone_path(base, "other")


def test_fact_table_modes(spark, folder):
    path, rows = folder + "/fact", fact(spark, *THREE)
    Z.write_fact(rows, path, "fail")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        Z.write_fact(rows, path, "fail")
    Z.write_fact(rows, path, "append")
    assert Z.read_fact(spark, path).count() == 6
    Z.write_fact(rows, path, "replace")
    assert Z.read_fact(spark, path).count() == 3


def test_what_is_written_runs_once(spark, folder):
    from pyspark.sql import functions as F

    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("once"))
    rows = spark.range(50).select(F.col("id"), F.lit(2010).alias("y"))
    spark.sparkContext.setJobGroup("once", "")
    try:
        rows.write.parquet(folder + "/plain")
        plain = jobs()
        assert Z.write_to_lake(rows, folder + "/lake").endswith("/processed")
        assert jobs() == 2 * plain
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# --- incremental -------------------------------------------------------------------------


def test_watermark_filter_is_strict(spark):
    rows = spark.createDataFrame([("08:00",), ("09:00",), ("10:00",), ("12:00",), (None,)], "t string")
    moment = F.concat(F.lit("2010-12-01 "), F.col("t")).try_cast("timestamp_ntz")
    mark = spark.sql("select timestamp_ntz'2010-12-01 09:00:00' m")
    assert [r["t"] for r in I.after_watermark(rows, mark, moment).collect()] == ["10:00", "12:00"]
    assert one(I.watermark_counts(rows, mark, moment)) == {"kept_rows": 2, "skipped_rows": 3}
    nothing = spark.sql("select cast(null as timestamp_ntz) m")
    assert I.after_watermark(rows, nothing, moment).count() == 5
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|more than one row"):
        I.after_watermark(rows, mark.union(mark), moment).count()


def test_high_watermark(spark, folder):
    rows = fact(spark, *THREE, ("9", "A", "d", 1, "1.00", "2009-05-01 00:00:00", "1", "UK"))
    assert one(I.high_watermark(rows))["high_watermark"] == datetime(2010, 12, 2, 10, 15)
    Z.write_fact(rows, folder + "/fact")
    stored = Z.read_fact(spark, folder + "/fact")
    assert one(I.high_watermark_of_table(stored))["high_watermark"] == datetime(2010, 12, 2, 10, 15)
    assert one(I.high_watermark_of_table(stored.limit(0)))["high_watermark"] is None


def test_natural_keys(spark):
    rows = fact(spark, *THREE, (*THREE[0][:3], 7, *THREE[0][4:]))
    unique = I.unique_in_batch(rows)
    assert unique.count() == 3
    assert unique.where("invoice_no = '536365'").first()["quantity"] == 6
    assert I.not_in_target(unique, fact(spark, THREE[0])).count() == 2


def test_watermark_log(spark):
    def at(hour):
        return datetime(2020, 1, 1, hour)

    log = spark.createDataFrame(
        [("a", "h", at(1), 10, at(1)), ("b", "h", None, 5, at(2)), ("c", "g", None, 1, at(3))], S.WATERMARK_SCHEMA
    )
    state = {r["file_hash"]: r for r in I.current_watermarks(log).collect()}
    assert (state["h"]["file_path"], state["h"]["rows_processed"], state["h"]["high_watermark_timestamp"]) == ("a", 15, at(1))
    assert state["g"]["high_watermark_timestamp"] is None


# --- whole loads -------------------------------------------------------------------------


def test_load_twice_adds_nothing(spark, folder):
    lake, path = Lake(spark, folder + "/lake"), write(folder + "/in", "a.csv", csv_text(CLEAN_ROWS))
    first = load_files(lake, path)
    assert (first.status, first.rows_read, first.rows_inserted, first.rows_valid) == (S.SUCCESS, 2, 2, 2), first
    assert first.watermark_after == datetime(2010, 12, 1, 8, 28)
    assert len(first.source_hash) == 64
    assert first.quality["threshold_status"] == "PASS" and first.quality["data_quality_score_pct"] == 100.0
    again = load_files(lake, path)
    assert (again.status, again.rows_inserted) == (S.SKIPPED, 0)
    forced = load_files(lake, path, LoadOptions(skip_processed_files=False))
    assert (forced.status, forced.rows_skipped, forced.rows_inserted) == (S.SKIPPED, 2, 0)
    late = load_files(lake, path, LoadOptions(skip_processed_files=False, late_policy="antijoin"))
    assert (late.status, late.rows_skipped_duplicate, late.rows_inserted) == (S.SUCCESS, 2, 0)
    assert lake.fact().count() == 2

    runs = {r["run_id"]: r for r in lake.runs().collect()}
    assert len(runs) == 4 and runs[first.run_id]["status"] == S.SUCCESS
    assert runs[first.run_id]["rows_inserted"] == 2 and runs[first.run_id]["completed_at"] is not None
    assert runs[late.run_id]["watermark_before"] == datetime(2010, 12, 1, 8, 28)
    entry = one(A.lineage_by_run(lake.lineage(), first.run_id))
    assert (entry["source_row_count"], entry["target_row_count"], entry["transformation_version"]) == (2, 2, "1.0.0")
    assert one(lake.watermarks())["rows_processed"] == 2


def test_new_file_beside_an_old_one(spark, folder):
    lake = Lake(spark, folder + "/lake")
    write(folder + "/in", "a file.csv", csv_text(CLEAN_ROWS))
    load_files(lake, folder + "/in")
    later = ("536367", "X", "LAMP", "1", "2010-12-03 08:00:00", "1.00", None, "france")
    write(folder + "/in", "b.csv", csv_text([later]))
    second = load_files(lake, folder + "/in")
    assert (second.status, second.rows_read, second.rows_inserted) == (S.SUCCESS, 1, 1), second
    row = one(lake.fact().where("invoice_no = '536367'"))
    assert (row["customer_type"], row["country"], row["total_amount"]) == ("Guest", "France", Decimal("1.00"))
    assert {r["rows_processed"] for r in lake.watermarks().collect()} == {2, 1}
    assert Z.read_from_lake(spark, lake.base, "staged").count() == 3
    assert {r["run"] for r in Z.read_from_lake(spark, lake.base, "raw", ["run"]).collect()} >= {second.run_id}


BAD = [("", "Y", "d", "1", "2010-12-04", "1.00", "7", "UK"), ("5", "Y", "d", "0", "2010-12-04", "1.00", "7", "UK")]


def test_invalid_rows_fail_the_run_by_default(spark, folder):
    lake, path = Lake(spark, folder + "/lake"), write(folder + "/in", "a.csv", csv_text(CLEAN_ROWS + BAD))
    failed = load_files(lake, path)
    assert failed.status == S.FAILED and "1 invalid" in failed.error_message
    assert lake.fact().count() == 0 and lake.watermarks().count() == 0
    run = one(lake.runs())
    assert (run["status"], run["error_message"]) == (S.FAILED, failed.error_message)
    assert one(M.health(lake.runs()))["health_status"] == "CRITICAL"


def test_quarantine_loads_the_rest(spark, folder):
    lake, path = Lake(spark, folder + "/lake"), write(folder + "/in", "a.csv", csv_text(CLEAN_ROWS + BAD))
    done = load_files(lake, path, LoadOptions(on_invalid="quarantine"))
    assert (done.status, done.rows_inserted, done.rows_invalid) == (S.PARTIAL, 2, 1), done
    set_aside = spark.read.parquet(lake.quarantine_path(done.run_id, "invalid"))
    assert one(set_aside)["violations"] == ["MISSING_INVOICE_NO"]
    assert one(spark.read.parquet(lake.quarantine_path(done.run_id, "constraints")))["quantity"] == 0


def test_bad_header_and_load_switched_off(spark, folder):
    lake = Lake(spark, folder + "/lake")
    failed = load_files(lake, write(folder + "/x", "a.csv", "InvalidHeader\n1\n"))
    assert failed.status == S.FAILED and "missing required" in failed.error_message
    staged = load_files(lake, write(folder + "/y", "a.csv", csv_text(CLEAN_ROWS)), LoadOptions(load=False, stage_csv=True))
    assert (staged.status, staged.rows_transformed, staged.rows_inserted) == (S.SUCCESS, 2, 0)
    assert spark.read.parquet(staged.staged_path).count() == 2
    assert lake.fact().count() == 0


def test_stream_second_start_adds_nothing(spark, folder):
    lake, landing = Lake(spark, folder + "/lake"), folder + "/in"
    write(landing, "a.csv", csv_text(CLEAN_ROWS))

    def run():
        stream_load(landing_stream(spark, landing), lake, folder + "/checkpoint").awaitTermination()
        return lake.fact().count()

    assert run() == 2
    assert run() == 2
    write(landing, "b.csv", csv_text([("7", "Z", "d", "1", "2010-11-30", "2.00", "1", "UK"), CLEAN_ROWS[0]]))
    assert run() == 3


def test_replayed_micro_batch_is_known_by_its_name(spark, folder):
    """The commit of a batch is lost, so it runs again: nothing is read, no zone gets another copy."""
    lake, landing, checkpoint = Lake(spark, folder + "/lake"), folder + "/in", folder + "/checkpoint"
    write(landing, "a.csv", csv_text(CLEAN_ROWS))
    options = LoadOptions(late_policy="antijoin")
    stream_load(landing_stream(spark, landing), lake, checkpoint, options).awaitTermination()
    zones = [lake.in_zone(zone, "")[:-len("/run=")] for zone in ("raw", "staged")]
    before, runs = [os.listdir(zone) for zone in zones], lake.run_events().count()
    for mark in ("0", ".0.crc"):
        os.remove(f"{checkpoint}/commits/{mark}")
    os.remove(landing + "/a.csv")
    stream_load(landing_stream(spark, landing), lake, checkpoint, options).awaitTermination()
    assert [os.listdir(zone) for zone in zones] == before and all(len(names) == 1 for names in before)
    assert lake.run_events().count() == runs and lake.fact().count() == 2
    # Another stream on the same lake starts its numbers anew, and its batches aren't taken for these.
    write(landing, "b.csv", csv_text([("7", "Z", "d", "1", "2010-11-30", "2.00", "1", "UK")]))
    stream_load(landing_stream(spark, landing), lake, folder + "/other", options).awaitTermination()
    assert lake.fact().count() == 3


def test_raw_rows_are_counted_in_one_pass(spark, folder):
    """Checks, watermark and cleaning take their counts from one job over the stored raw rows."""
    bad = [("8", "B", "d", "many", "2010-12-01", "1.00", "1", "UK"), ("9", "B", "d", "0", "2010-12-01", "1.00", None, "UK"),
           (" 9", "c", "d", "1", "2010-12-01", "1.00", None, "UK")]
    rows = raw(spark, *CLEAN_ROWS, *bad, CLEAN_ROWS[0])
    options = LoadOptions(on_invalid="quarantine", late_policy="antijoin")
    counted = one(_counts(rows, options, F.lit(True)))
    assert {name: counted[name] for name in V.CATEGORIES} == {name: one(V.validate(rows))[name] for name in V.CATEGORIES}
    passed, broken = V.quarantine(rows)
    alone = one(row_counts(passed))
    assert {name: counted[name] for name in alone} == alone and counted["distinct_invalid_rows"] == broken.count()
    assert _counts(rows, options, F.lit(True))._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    result = load_batch(Lake(spark, folder + "/lake"), rows, "batch", options)
    assert result.quality["null_imputed_count"] == alone["nulls_imputed"]
    assert result.quality["duplicate_removed_count"] == 1


def test_batch_replay_adds_nothing(spark, folder):
    lake, rows = Lake(spark, folder + "/lake"), raw(spark, *CLEAN_ROWS)
    options = LoadOptions(late_policy="antijoin")
    assert load_batch(lake, rows, "batch", options).rows_inserted == 2
    assert load_batch(lake, rows, "batch", options).rows_inserted == 0


# --- monitoring --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def two_runs(spark):
    runs = spark.createDataFrame(
        [("run-1", datetime(2026, 8, 14, 10), "SUCCESS", 100, 95, 5, 95, 0, "2.0"),
         ("run-2", datetime(2026, 8, 14, 11), "FAILED", 50, 0, 50, 0, 0, "1.0")],
        "run_id string, started_at timestamp_ntz, status string, rows_read bigint, rows_valid bigint, "
        "rows_invalid bigint, rows_inserted bigint, rows_skipped bigint, execution_duration string",
    )
    return runs.withColumns({
        "execution_duration": F.col("execution_duration").cast("decimal(10,3)"), "source_file": F.lit("a.csv")
    }).cache()


def test_health(two_runs):
    assert M.latest_run(two_runs).first()["run_id"] == "run-2"
    assert M.failed_runs(two_runs).count() == 1
    state = one(M.health(two_runs))
    assert (state["health_status"], state["success_rate_pct"], state["avg_duration_seconds"]) == ("CRITICAL", 50.0, 1.5)
    assert one(M.health(two_runs.where("status = 'SUCCESS'")))["health_status"] == "HEALTHY"
    empty = one(M.health(two_runs.limit(0)))
    assert (empty["health_status"], empty["success_rate_pct"], empty["total_runs"]) == ("NO_RUNS", 100.0, 0)


def test_counters_and_quality(two_runs):
    values = {r["metric"]: r["value"] for r in M.counters(two_runs).collect()}
    assert (values["pipeline_runs_total"], values["pipeline_failures_total"]) == (2.0, 1.0)
    assert (values["pipeline_duration_seconds_total"], values["data_quality_score"]) == (3.0, 0.0)
    assert {r["metric"]: r["value"] for r in M.counters(two_runs.limit(0)).collect()}["data_quality_score"] == 100.0
    rates = {r["run_id"]: r["data_quality_rate_pct"] for r in M.quality_view(two_runs).collect()}
    assert rates == {"run-1": 95.0, "run-2": 0.0}
    day = one(M.daily_view(two_runs))
    assert (day["total_runs"], day["successful_runs"], day["failed_runs"], day["avg_duration_seconds"]) == (2, 1, 1, 1.5)


@pytest.mark.parametrize("encodings", [("utf-8", "utf-8"), ("latin-1", "latin-1"), ("utf-8", "latin-1")])
@pytest.mark.parametrize("turned", [False, True])
def test_files_alike_in_encoding_are_decoded_by_the_reader(spark, folder, encodings, turned):
    rows = [("536365", "85123A", "CAFÉ £", "6", "2010-12-01 08:26:00", "2.55", "17850", "España")]
    for i, encoding in enumerate(encodings):
        names, values = S.RAW_COLUMNS, [(f"{i}", *row[1:]) for row in rows]
        if turned and i:
            names, values = names[::-1], [row[::-1] for row in values]
        write(folder, f"{i}.csv", csv_text(values, ",".join(names)), encoding)
    read = C.read_raw(spark, folder, keep_source=True)
    assert sorted((r["InvoiceNo"], r["Description"], r["Country"]) for r in read.collect()) == [
        ("0", "CAFÉ £", "España"), ("1", "CAFÉ £", "España")]
    assert {r[C.SOURCE_FILE].rpartition("/")[2] for r in read.collect()} == {"0.csv", "1.csv"}
    plan = spark._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "extended").split("Optimized Logical Plan")[1]
    assert ("encode(" in plan) == (len(set(encodings)) > 1)
    assert ("Join" in plan) == (turned or len(set(encodings)) > 1)
    # Where a column stands is looked up once for a file, below the join.
    assert "array_position" not in plan.partition("Join")[0]


MANY = [
    (code, item, note, quantity, f"2010-{1 + i % 12:02d}-01 08:00:00", "2.00", "7", "UK")
    for i in range(60)
    for code, item, note, quantity in [
        (f"{i}a", f"s{i % 7}", "one", "3"), (f" {i}A ", f"S{i % 7}", "copy", "3.0"), (f"{i}A", f"\ts{i % 7}", "other", "4"),
    ]
]


def loaded(spark, base, rows, monkeypatch, part_bytes):
    monkeypatch.setattr(L, "PART_BYTES", part_bytes)
    monkeypatch.setattr(L, "STAGED_PARTS", 3)
    lake, options = Lake(spark, base), LoadOptions(on_invalid="quarantine", late_policy="antijoin")
    results = [load_batch(lake, raw(spark, *batch), f"batch {i}", options) for i, batch in enumerate((rows, rows[:30] + MANY[3:9]))]
    facts = lake.fact().drop("loaded_at").orderBy("invoice_no", "stock_code").collect()
    return lake, facts, [(r.status, r.rows_read, r.rows_transformed, r.rows_inserted, r.rows_skipped_duplicate) for r in results]


def test_rows_are_loaded_in_parts_that_share_no_key(spark, folder, monkeypatch):
    """Copies with other spellings, other quantities of a line and lines in the table meet in one part, whatever the part."""
    rows, pended, pend = [*MANY, *BAD], [], Z.pend_fact
    monkeypatch.setattr(Z, "pend_fact", lambda frame, *rest: pended.append(frame.count()) or pend(frame, *rest))
    lake, parts, results = loaded(spark, folder + "/parts", rows, monkeypatch, 1)
    # Rows to add, then those that meet the rules (one doesn't), then the second batch, all of it in the table.
    assert [sum(pended[i:i + 3]) for i in (0, 3, 6)] == [61, 60, 0] and len(pended) == 9 and max(pended) < 40
    assert (lake.fact().count(), Z.read_from_lake(spark, lake.base, "staged").count()) == (60, 121 + 20)
    pended.clear()
    _, whole, same = loaded(spark, folder + "/whole", rows, monkeypatch, 1 << 40)
    assert (parts, results) == (whole, same) and len(pended) == 3
    assert results == [("PARTIAL", 182, 121, 60, 60), ("SUCCESS", 36, 20, 0, 20)]


def test_a_part_that_fails_leaves_nothing_staged(spark, folder, monkeypatch):
    lake, transform, calls = Lake(spark, folder + "/lake"), L._transform, []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("the disk is full")
        return transform(*args)

    monkeypatch.setattr(L, "PART_BYTES", 1)
    monkeypatch.setattr(L, "_transform", dies)
    assert load_batch(lake, raw(spark, *MANY), "batch").status == S.FAILED
    assert len(calls) == 2 and not os.path.exists(lake.base + "/staged")
    assert load_batch(lake, raw(spark, *MANY), "batch").rows_inserted == 60


def test_a_load_leaves_no_shuffle_files(spark, folder):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    path, before = write(folder + "/in", "a.csv", csv_text(MANY)), shuffled()
    assert load_files(Lake(spark, folder + "/lake"), path).rows_inserted == 60
    until = time.monotonic() + 20  # they go in the background
    while (left := shuffled() - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_compressed_files_are_the_same_content(spark, folder):
    rows = raw(spark, *CLEAN_ROWS, ("7", "Z", 'a "b", £', "1", "2010-11-30", "2.00", None, " España "))
    plain, packed = (C.write_csv(rows.coalesce(1), f"{folder}/{kind}", compression=kind) for kind in ("none", "gzip"))
    assert all(name.endswith(".csv.gz") for name in os.listdir(packed) if name.startswith("part"))
    assert {r["file_hash"] for r in C.file_manifest(spark, plain, "*.csv").collect()} == {
        r["file_hash"] for r in C.file_manifest(spark, packed, "*.csv.gz").collect()}
    assert sorted(C.read_raw(spark, plain).collect()) == sorted(C.read_raw(spark, packed).collect())


def test_stream_takes_compressed_files_in_parts(spark, folder, monkeypatch):
    landing, lake = C.write_csv(raw(spark, *MANY), folder + "/in", compression="gzip"), Lake(spark, folder + "/lake")
    monkeypatch.setattr(L, "PART_BYTES", 1)
    monkeypatch.setattr(L, "STAGED_PARTS", 2)
    for _ in range(2):
        stream_load(landing_stream(spark, landing, pattern="*.csv.gz"), lake, folder + "/checkpoint").awaitTermination()
        assert (lake.fact().count(), Z.read_from_lake(spark, lake.base, "raw").count(), lake.runs().count()) == (60, 180, 1)
