import pytest

from samples import THREE, fact, one
from tillworks.errors import FilterError
from tillworks.operators import breakdowns as B
from tillworks.operators import insights as I
from tillworks.operators import kpis as K
from tillworks.operators.filters import CANCELLATIONS, ReportFilter, apply_filter, repeat_buyers
from tillworks.plans import dashboard as D
from tillworks.plans.catalog import CATALOG


@pytest.fixture(scope="module")
def three(spark):
    return fact(spark, *THREE).cache()


@pytest.fixture(scope="module")
def guests(spark):
    second = (*THREE[1][:6], "GUEST", "France")
    third = (*THREE[2][:6], "17850", "United Kingdom")
    return fact(spark, THREE[0], second, third).cache()


def test_basic_set(three):
    row = one(K.kpi_set_basic(three))
    assert (row["total_revenue"], row["total_orders"], row["total_units_sold"], row["average_order_value"]) == (
        45.3, 2, 16, 22.65
    )
    assert (row["top_product"], row["top_country"]) == ("WHITE METAL LANTERN", "United Kingdom")
    assert row["cancellation_rate"] == row["cancellation_rate_pct"] == 33.33
    assert row["repeat_customer_rate"] == 100.0


def test_single_figures_agree_with_the_sets(three):
    basic, row = one(K.kpi_set_basic(three)), one(K.kpi_row(three))
    for report, column, expected in [
        (K.total_revenue, "total_revenue", basic["total_revenue"]),
        (K.average_unit_price, "average_unit_price", basic["average_unit_price"]),
        (K.repeat_customer_rate, "repeat_customer_rate_pct", basic["repeat_customer_rate_pct"]),
        (K.top_product, "top_product", basic["top_product"]),
        (K.cancellation_count, "cancellation_count", row["cancellation_count"]),
        (K.cancellation_impact, "cancellation_revenue_impact", row["cancellation_revenue_impact"]),
        (K.total_products, "total_products", row["total_products"]),
        (K.items_per_order, "average_items_per_order", row["average_items_per_order"]),
        (K.revenue_growth, "revenue_growth_pct", row["revenue_growth_pct"]),
        (K.registered_revenue, "registered_customer_revenue", row["registered_customer_revenue"]),
    ]:
        assert one(report(three))[column] == expected, column


def test_no_rows_give_zeroes(three):
    empty = three.limit(0)
    row = one(K.kpi_set_basic(empty))
    assert [row[c] for c in ("total_revenue", "total_orders", "total_units_sold", "average_order_value")] == [0.0, 0, 0, 0.0]
    assert row["top_product"] == "N/A"
    assert set(one(K.kpi_row(empty)).values()) == {0.0}
    assert one(K.top_country(empty))["top_country"] == "N/A"
    assert one(CATALOG["q19"](empty))["total_cancellation_loss"] is None
    assert one(CATALOG["q05"](empty))["average_unit_price"] is None
    assert I.insights(empty).count() == 0
    assert [r["country"] for r in B.country_choices(empty).collect()] == ["All Countries"]


def test_guest_variant(guests):
    kinds = {r["customer_type"]: r for r in B.segments(guests).collect()}
    assert len(kinds) == 2 and kinds["Registered"]["total_revenue"] == 15.3
    best = B.top_products(guests).first()
    assert (best["stock_code"], best["total_revenue"]) == ("71053", 30.0)
    countries = {r["country"]: r["total_revenue"] for r in B.by_country(guests).collect()}
    assert countries == {"France": 30.0, "United Kingdom": 15.3}
    assert sum(r["revenue_share_pct"] for r in B.segment_shares(guests).collect()) == pytest.approx(100, abs=0.01)


def test_kpi_records(three):
    rows = {r["kpi"]: r for r in K.kpi_set_full(three).collect()}
    assert len(rows) == 15
    assert rows["total_revenue"]["formatted_value"] == "£45.30"
    assert rows["average_items_per_order"]["formatted_value"] == "8.0"
    assert rows["cancellation_rate"]["formatted_value"] == "33.3%"
    assert rows["total_customers"]["value"] == 2.0


def test_transaction_filter(three):
    only_lost = ReportFilter(transaction_type="Cancellations")
    row = one(K.kpi_row(three, only_lost))
    assert (row["total_orders"], row["total_revenue"], row["cancellation_rate"]) == (1, -12.75, 100.0)
    only_sold = one(K.kpi_row(three, ReportFilter(transaction_type="Sales")))
    assert (only_sold["cancellation_count"], only_sold["cancellation_rate"]) == (0, 0.0)
    assert only_sold["cancellation_revenue_impact"] == 12.75
    assert apply_filter(three, ReportFilter(transaction_type="whatever")).count() == 3
    assert apply_filter(three, ReportFilter(), CANCELLATIONS).count() == 1


def test_date_and_place_filters(three):
    assert apply_filter(three, ReportFilter("2010-12-02", "2010-12-02")).count() == 1
    assert apply_filter(three, ReportFilter(end_date="2010-12-01")).count() == 2
    assert apply_filter(three, ReportFilter(country="All Countries", customer_type="All")).count() == 3
    assert apply_filter(three, ReportFilter(country="France")).count() == 1


@pytest.mark.parametrize("start, end", [("2020-12-31", "2010-01-01"), ("2010-13-01", "2010-12-01"), ("x", "y")])
def test_bad_filters(start, end):
    with pytest.raises(FilterError):
        ReportFilter(start, end).validate()


def test_last_fraction_of_the_end_day_counts(spark):
    late = fact(spark, ("1", "A", "d", 1, "1.00", "2010-12-01 23:59:59.5", "1", "UK"))
    assert apply_filter(late, ReportFilter(end_date="2010-12-01")).count() == 1


def test_growth(spark):
    def month(m, amount, n):
        return [(f"{m}-{i}", "A", "d", 1, amount, f"2010-{m}-05 00:00:00", "1", "UK") for i in range(n)]

    rows = fact(spark, *month(11, "100.00", 10), *month(12, "100.00", 11))
    row = one(K.kpi_row(rows))
    assert (row["revenue_growth_pct"], row["monthly_order_growth_pct"]) == (10.0, 10.0)
    assert one(K.kpi_row(rows, ReportFilter(start_date="2010-12-01")))["revenue_growth_pct"] == 0.0
    assert [r["mom_growth_pct"] for r in CATALOG["q21"](rows).collect()] == [None, 10.0]


def _kpis(spark, **values):
    columns = {
        "cancellation_rate": 0.0, "revenue_growth_pct": 0.0, "top_product_share": 0.0, "guest_share": 0.0,
        "cancellation_revenue_impact": 0.0, "top_product": "LAMP", **values,
    }
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in columns.items())
    return spark.createDataFrame([tuple(columns.values())], kinds)


@pytest.mark.parametrize("values, category, severity, text", [
    ({"cancellation_rate": 12.5, "cancellation_revenue_impact": 150000.0}, "CANCELLATION", "CRITICAL", "£150.0K"),
    ({"cancellation_rate": 5.0}, "CANCELLATION", "HIGH", "5.0%"),
    ({"revenue_growth_pct": 5.1}, "TREND", "LOW", "+5.1%"),
    ({"revenue_growth_pct": -15.4}, "TREND", "HIGH", "-15.4%"),
    ({"top_product_share": 20.0}, "PRODUCT", "MEDIUM", "'LAMP'"),
    ({"guest_share": 50.0}, "CUSTOMER", "MEDIUM", "50.0%"),
])
def test_insight_rules(spark, values, category, severity, text):
    found = one(I.findings(_kpis(spark, **values)))
    assert (found["category"], found["severity"]) == (category, severity)
    assert text in found["description"]


def test_quiet_figures_give_no_insight(spark):
    assert I.findings(_kpis(spark, revenue_growth_pct=5.0)).count() == 0


def test_ranks_keep_ties(spark):
    rows = fact(spark, *[
        (str(i), code, "d", 1, price, "2010-12-01 00:00:00", str(i), "UK")
        for i, (code, price) in enumerate([("A", "9"), ("B", "9"), ("C", "8"), ("D", "7"), ("E", "6")])
    ])
    ranks = [(r["revenue_rank"], r["stock_code"]) for r in CATALOG["q22"](rows).collect()]
    assert ranks == [(1, "A"), (1, "B"), (2, "C"), (3, "D")]
    assert [r["customer_rank"] for r in CATALOG["q23"](rows).collect()] == [1, 1, 2, 3, 4]
    assert [r["rank"] for r in B.top_customers(rows, limit=3).collect()] == [1, 1, 2]
    assert CATALOG["q23"](rows).first()["pct_of_total_revenue"] == 23.08


def test_invoice_in_two_months_counts_in_both_but_once_overall(spark):
    rows = fact(
        spark,
        ("1", "A", "d", 1, "5.00", "2010-11-30 00:00:00", "1", "UK"),
        ("1", "A", "d", 1, "5.00", "2010-12-01 00:00:00", "1", "UK"),
    )
    row = one(K.kpi_row(rows))
    assert (row["total_orders"], row["monthly_order_growth_pct"]) == (1, 0.0)
    assert [r["total_orders"] for r in B.by_month(rows).collect()] == [1, 1]


def test_packages(three):
    package = D.dashboard(three)
    assert set(package) == {
        "kpis", "insights", "revenue_trend", "top_products", "country_revenue", "customer_summary"
    }
    lost = D.cancellation_report(three)
    assert lost["kpis"].count() == 3
    assert lost["top_returned_products"].first()["description"] == "REGENCY CAKESTAND"


def test_repeat_buyers_and_unknown_granularity(three):
    assert [r["customer_id"] for r in repeat_buyers(three).collect()] == ["17850"]
    assert B.trend(three, "Yearly").collect() == B.trend(three, "Monthly").collect()
