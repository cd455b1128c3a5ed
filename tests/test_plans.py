"""The physical plans are what they are meant to be, and hot keys change no result."""

import os
import random
import re
from functools import reduce
from operator import or_

import pandas as pd
import pytest
from pyspark.sql import functions as F

from samples import fact, one
from tillworks import session
from tillworks.operators import breakdowns as B
from tillworks.operators import cleaning as C
from tillworks.operators import incremental as I
from tillworks.operators import kpis as K
from tillworks.operators.filters import ReportFilter, sales
from tillworks.plans import load_queries
from tillworks.plans.catalog import CATALOG
from tillworks.plans.dashboard import dashboard, dashboard_rows
from tillworks.sources import csv_files as files
from tillworks.sources import lake as Z
from tillworks.sources import star_tables as T

SMALL = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def details(frame):
    """The plan with its scans written out in full."""
    query = frame._jdf.queryExecution()
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(query, "formatted")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "fact")
    Z.write_fact(T.fact_sales(spark, SMALL), path)
    return Z.read_fact(spark, path)


def test_shuffles_follow_the_size_of_the_lines(spark, monkeypatch):
    """More lines are dealt to more tasks, not to larger ones, unless the session has more partitions anyway."""
    own = {name: spark.conf.get(name, None) for name in (session.SHUFFLES, session.TASK)}
    size = os.path.getsize(f"{SMALL}/lineitem.parquet")
    try:
        for most, parts in ((1000, -(-size // 1000)), (size, int(spark.conf.get("spark.sql.shuffle.partitions")))):
            monkeypatch.setattr(session, "FILE_BYTES", most)
            text = plan(C.dedupe(T.dirty_rows(spark, SMALL)))
            assert set(re.findall(r"hashpartitioning\(.*, (\d+)\)", text)) == {str(parts)}
    finally:
        for name, value in own.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_partitions_stay_small_on_large_tables(spark, folder):
    """Eight shuffled bytes for a byte of the line files are no more than two tasks' share in a partition."""
    own = {name: spark.conf.get(name, None) for name in (session.SHUFFLES, session.TASK)}
    size = 3 << 30
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/large", "wb") as f:
        f.truncate(size)
    try:
        session.fit_shuffles(spark, f"{folder}/large")
        assert 8 * size / int(spark.conf.get(session.SHUFFLES)) <= 2 * int(spark.conf.get(session.TASK))
    finally:
        for name, value in own.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_manifest_does_not_sort_lines(spark, folder):
    """Hashes and first lines of files are kept in objects, a few for each file."""
    spark.createDataFrame([(f"line {i}",) for i in range(50)], "value string").coalesce(1).write.text(f"{folder}/lines")
    text = plan(files.file_manifest(spark, f"{folder}/lines"))
    assert "ObjectHashAggregate" in text and "SortAggregate" not in text and "Sort [_source_file" not in text


def test_lake_summary_writes_three_files_without_three_shuffled_heaps(spark, monkeypatch):
    """The raw zone's files come from stored rows, and the invoices of different years out of different tasks."""
    plans, write = [], Z.write_to_lake

    def watched(rows, base, zone, *rest):
        plans.append((zone, plan(rows)))
        return write(rows, base, zone, *rest)

    monkeypatch.setattr(Z, "write_to_lake", watched)
    found = {r.zone: r.file_count for r in load_queries.lake_summary(spark, SMALL).collect()}
    assert found["raw"] == 3 and [zone for zone, _ in plans] == ["raw", "processed", "processed"]
    assert "Exchange" not in plans[0][1]
    assert all("SinglePartition" not in text and "hashpartitioning(InvoiceYear" in text for _, text in plans[1:])


@pytest.mark.parametrize("report", [
    K.kpi_set_full, K.kpi_set_basic, lambda f: K.kpi_row(f, with_top_product=True), CATALOG["q18"], CATALOG["q23"],
    B.segments, CATALOG["v_monthly_sales"],
])
def test_one_scan_and_no_line_copied_per_counter(stored, report):
    text = plan(report(stored))
    assert text.count("FileScan") == 1
    scan = text.index("FileScan")
    first_shuffle = text.rindex("Exchange", 0, scan)
    assert "Expand" not in text[first_shuffle:scan]


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_catalogue_runs_on_built_in_expressions(stored, name):
    text = plan(CATALOG[name](stored))
    assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text)
    # The fact rows are aggregated before anything runs in a single task.
    if "SinglePartition" in text:
        assert "Aggregate" in text[text.rindex("SinglePartition"):]


def test_filters_reach_the_files(stored):
    text = details(sales(stored, ReportFilter("1996-03-01", "1996-04-30")).select("invoice_no", "total_amount"))
    assert "GreaterThanOrEqual(invoice_timestamp" in text
    assert re.search(r"PartitionFilters: \[[^\]]*invoice_year", text)
    columns = re.search("ReadSchema: struct<([^>]*)>", text).group(1)
    assert "description" not in columns and "customer_id" not in columns


def test_newest_month_only_is_read_for_the_watermark(stored):
    assert re.search(r"PartitionFilters: \[[^\]]*[sS]ubquery", details(I.high_watermark_of_table(stored)))


@pytest.mark.parametrize("frame", [
    lambda spark, stored: C.dedupe(T.dirty_rows(spark, SMALL)),
    lambda spark, stored: I.unique_in_batch(stored),
    lambda spark, stored: CATALOG["q22"](stored),
])
def test_ranks_are_bounded_before_the_shuffle(spark, stored, frame):
    assert plan(frame(spark, stored)).count("WindowGroupLimit") == 2


def test_top_k_keeps_k_rows_per_task(stored):
    for report in (CATALOG["q10"], CATALOG["q23"], B.top_customers):
        assert "TakeOrderedAndProject" in plan(report(stored))


def test_lines_and_orders_are_never_broadcast(spark):
    text = plan(T.fact_sales(spark, SMALL))
    assert "SortMergeJoin [l_orderkey" in text


def test_anti_join_reads_keys_only(stored):
    text = details(I.not_in_target(stored, stored))
    assert "LeftAnti" in text
    widths = [len(re.sub(r"\([^)]*\)", "", match).split(",")) for match in re.findall("ReadSchema: struct<([^>]*)>", text)]
    assert min(widths) == 3


@pytest.fixture(scope="module")
def hot(spark):
    """Lines where one invoice, customer, product and month hold a third of all rows."""
    pick = random.Random(7)
    rows = []
    for i in range(3000):
        hot_row = i % 3 == 0
        n = 0 if hot_row else pick.randint(1, 400)
        back = pick.random() < 0.2
        day = 1 if hot_row else pick.randint(1, 28)
        month = 6 if hot_row else pick.randint(1, 12)
        rows.append((
            ("C" if back else "") + f"{n}", f"s{n % 50}", f"d{n % 45}", (-1 if back else 1) * pick.randint(1, 9),
            f"{pick.randint(1, 9999) / 100:.2f}", f"2010-{month:02d}-{day:02d} 10:00:00",
            "GUEST" if n % 7 == 3 else f"c{n % 90}", f"k{n % 5}",
        ))
    return fact(spark, *rows).cache()


def test_kpis_on_hot_keys_match_brute_force(hot):
    pdf = hot.toPandas()
    sold, lost = pdf[~pdf.is_cancellation], pdf[pdf.is_cancellation]
    row = one(K.kpi_row(hot, with_top_product=True))
    assert row["total_revenue"] == float(sold.total_amount.sum())
    assert row["total_orders"] == sold.invoice_no.nunique()
    assert row["total_customers"] == pdf.customer_id.nunique()
    assert row["total_products"] == pdf.stock_code.nunique()
    assert row["cancellation_count"] == lost.invoice_no.nunique()
    assert row["cancellation_revenue_impact"] == float(abs(lost.total_amount.sum()))
    assert row["registered_customers"] == sold[sold.customer_type == "Registered"].customer_id.nunique()
    assert row["guest_customers"] == 1
    assert row["registered_customer_revenue"] == float(sold[sold.customer_type == "Registered"].total_amount.sum())
    monthly = sold.groupby("invoice_month").agg(r=("total_amount", "sum"), n=("invoice_no", "nunique")).sort_index()
    last, before = monthly.iloc[-1], monthly.iloc[-2]
    assert row["revenue_growth_pct"] == pytest.approx(float((last.r - before.r) / before.r * 100), abs=0.006)
    assert row["monthly_order_growth_pct"] == pytest.approx((last.n - before.n) / before.n * 100, abs=0.006)
    best = sold.groupby(["stock_code", "description"]).total_amount.sum().astype(float).idxmax()
    assert row["top_product"] == best[1]


def test_basic_set_on_hot_keys_matches_brute_force(hot):
    pdf = hot.toPandas()
    chosen = ReportFilter("2010-02-01", "2010-11-30", country="k0", customer_type="Registered")
    inside = pdf[(pdf.invoice_month >= 2) & (pdf.invoice_month <= 11)]
    here = inside[inside.country == "k0"]
    mine = here[here.customer_type == "Registered"]
    sold = mine[~mine.is_cancellation]
    row = one(K.kpi_set_basic(hot, chosen))
    assert row["total_revenue"] == float(sold.total_amount.sum())
    assert row["total_orders"] == sold.invoice_no.nunique()
    assert row["total_customers"] == mine.customer_id.nunique()
    orders = sold[sold.customer_id != "GUEST"].groupby("customer_id").invoice_no.nunique()
    assert row["repeat_customer_rate_pct"] == pytest.approx(100 * (orders > 1).mean(), abs=0.006)
    products = here[~here.is_cancellation].groupby("description").total_amount.sum().astype(float)
    assert row["top_product"] == products.idxmax()
    everywhere = inside[~inside.is_cancellation].groupby("country").total_amount.sum().astype(float)
    assert row["top_country"] == everywhere.idxmax()
    assert row["average_unit_price"] == pytest.approx(float(sold.unit_price.mean()), abs=0.006)


def test_copies_of_one_key_collapse_to_one_row(spark):
    copies = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
        F.lit("A").alias("StockCode"), F.concat(F.lit("d"), F.col("id") % 5).alias("Description"),
        F.lit("1").alias("Quantity"), F.lit("2010-12-01").alias("InvoiceDate"), F.lit("1.00").alias("UnitPrice"),
        F.lit("7").alias("CustomerID"), F.lit("UK").alias("Country"),
    )
    kept = C.dedupe(copies)
    assert kept.count() == 20001
    assert one(kept.where("InvoiceNo = 'hot'"))["Description"] == "d0"
    assert one(C.cleaning_stats(copies))["duplicates_removed"] == 9999


def test_leaderboards_on_hot_keys(hot):
    pdf = hot.toPandas()
    sold = pdf[~pdf.is_cancellation & (pdf.customer_id != "GUEST")]
    spent = sold.groupby("customer_id").total_amount.sum().astype(float).sort_values(ascending=False)
    rows = CATALOG["q23"](hot).collect()
    assert [r["total_spent"] for r in rows] == [round(v, 2) for v in spent.head(20)]
    assert rows[0]["pct_of_total_revenue"] == pytest.approx(100 * spent.iloc[0] / spent.sum(), abs=0.006)
    ranks = pd.Series([r["total_spent"] for r in rows]).rank(method="dense", ascending=False).astype(int)
    assert [r["customer_rank"] for r in rows] == list(ranks)


def test_antijoin_reads_the_months_of_the_batch(stored):
    """Folder names are compared with the batch's months as literals, and other folders aren't opened."""
    months = [tuple(r) for r in stored.select("invoice_year", "invoice_month").distinct().orderBy("invoice_year", "invoice_month").limit(2).collect()]
    batch = stored.where(reduce(or_, [(F.col("invoice_year") == y) & (F.col("invoice_month") == m) for y, m in months]))
    found = I.in_months_of(stored, batch)
    filters = re.search(r"PartitionFilters: \[(.*)\]", details(found))[1]
    assert set(map(int, re.findall(r"\d+", re.sub(r"#\d+", "", filters)))) == {n for pair in months for n in pair}
    assert found.select("invoice_year", "invoice_month").distinct().count() == 2 and found.count() == batch.count()
    assert I.in_months_of(stored, stored.limit(0)).count() == 0
    assert found.inputFiles() and I.not_in_target(batch, found).count() == 0


def test_reports_from_shared_visits_are_the_same(hot):
    chosen = ReportFilter("2010-02-01", "2010-11-30")
    visits = B.sold_visits(hot, chosen)
    assert B.segments_of(visits).orderBy("customer_type").collect() == B.segments(hot, chosen).orderBy("customer_type").collect()
    assert B.countries_of(visits, 3).collect() == B.by_country(hot, chosen, 3).collect()


def test_dashboard_shares_the_kpi_row(stored):
    rows = dashboard_rows(dashboard(stored))
    rows.collect()
    text = plan(rows)
    assert "ReusedExchange" in text
    assert len(re.findall(r"FileScan", text.partition("Initial Plan")[0])) <= 4
