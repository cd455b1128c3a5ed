from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import fact, one, raw
from tillworks.functions import numeric as N
from tillworks.functions import text as X
from tillworks.functions.dates import to_moment
from tillworks.operators import cleaning as C
from tillworks.operators.fact_shape import constraint_violations, meets_constraints, to_fact_columns
from tillworks.operators.features import add_features
from tillworks.sources import synthetic

DIRTY = [
    (" 536365 ", "85123a", " WHITE HEART ", "6", "2010-12-01 08:26:00", "2.55", None, " united kingdom "),
    ("536365 ", "85123a", " WHITE HEART ", "6", "2010-12-01 08:26:00", "2.55", None, " united kingdom "),
    ("536366", "71053", None, "10", "2010-12-01 09:15:00", "-5.00", "17850", "france"),
]


def test_dirty_rows_are_cleaned(spark):
    rows = raw(spark, *DIRTY)
    kept = one(C.clean(rows))
    assert (kept["InvoiceNo"], kept["StockCode"], kept["CustomerID"], kept["Country"]) == (
        "536365", "85123A", "GUEST", "United Kingdom"
    )
    assert kept["InvoiceDate"] == datetime(2010, 12, 1, 8, 26)
    assert one(C.cleaning_stats(rows)) == {
        "initial_rows": 3, "duplicates_removed": 1, "invalid_prices_removed": 1, "nulls_imputed": 2, "final_rows": 1
    }
    assert one(C.stats_after(C.row_counts(rows), 1)) == one(C.cleaning_stats(rows))


def test_stats_of_no_rows(spark):
    assert set(one(C.cleaning_stats(raw(spark))).values()) == {0}


def test_numeric_keys_become_text_and_float_ids_lose_their_tail(spark):
    rows = spark.createDataFrame(
        [(536365, 85123, 6, "2010-12-01", 2.55, 17850.0), (536366, 71053, 6, "2010-12-01", 3.39, None)],
        "InvoiceNo bigint, StockCode bigint, Quantity bigint, InvoiceDate string, UnitPrice double, CustomerID double",
    )
    out = {r["InvoiceNo"]: r for r in C.clean(rows).collect()}
    assert out["536365"]["StockCode"] == "85123"
    assert out["536365"]["CustomerID"] == "17850"
    assert out["536366"]["CustomerID"] == "GUEST"
    assert out["536365"]["UnitPrice"] == Decimal("2.5500")


@pytest.mark.parametrize("text, value", [
    ("6", 6.0), (" 6 ", 6.0), ("-0.40", -0.4), ("1e3", 1000.0), ("5.", 5.0), ("x", None), ("1.5d", None),
    ("NaN", None), ("Infinity", None), ("0x1p3", None), ("", None), (None, None),
])
def test_number(spark, text, value):
    assert spark.createDataFrame([(text,)], "x string").select(C.number(F.col("x")).alias("n")).first()["n"] == value


def test_strip_handles_tabs_and_wide_spaces(spark):
    value = spark.createDataFrame([("\t\xa0a b　\r\n",)], "x string").select(X.strip(F.col("x")).alias("x"))
    assert value.first()["x"] == "a b"


@pytest.mark.parametrize("text, expected", [
    ("2010-12-01 08:26:00", datetime(2010, 12, 1, 8, 26)),
    ("12/1/2010 8:26", datetime(2010, 12, 1, 8, 26)),
    ("2010-12-01", datetime(2010, 12, 1)),
    ("12/1/10 8:26", datetime(2010, 12, 1, 8, 26)), ("1/2/69", datetime(1969, 1, 2)), ("01-Dec-2010", datetime(2010, 12, 1)),
    ("1 december 2010 08:26", datetime(2010, 12, 1, 8, 26)), ("20101201", datetime(2010, 12, 1)),
    ("invalid_date_str", None), ("13/45/2010", None), (None, None), ("01-eca-2010", None), ("13/45/10", None), ("", None),
])
def test_dates(spark, text, expected):
    assert spark.createDataFrame([(text,)], "x string").select(to_moment(F.col("x")).alias("d")).first()["d"] == expected


def test_ids_lose_a_whole_number_point_only(spark):
    ids = spark.createDataFrame([(x,) for x in ("A.1.0", "A.2.0", "1.2.0", "12.0", "7", "nan")], "CustomerID string")
    assert [r[0] for r in C.impute_customer(ids).collect()] == ["A.1.0", "A.2.0", "1.2.0", "12", "7", "GUEST"]
    numbers = spark.createDataFrame([(12345678.0,), (1.5,), (None,), (float("nan"),)], "CustomerID double")
    assert [r[0] for r in C.impute_customer(numbers).collect()] == ["12345678", "1.5", "GUEST", "GUEST"]


def test_dedupe_is_stable_and_matches_quantities_by_value(spark):
    a = ("1", "A", "b", "6", "2010-12-01", "2.00", "7", "X")
    b = ("1", "A", "a", "6.0", "2010-12-01", "1.00", "7", "X")
    for rows in ([a, b], [b, a]):
        assert one(C.dedupe(raw(spark, *rows)))["Description"] == "a"
    assert C.dedupe(raw(spark, a, ("1", "A", "b", "x", "2010-12-01", "2.00", "7", "X"))).count() == 2


def test_a_price_too_large_for_its_type_is_not_zeroed(spark):
    row = one(C.clean(raw(spark, ("1", "A", "d", "1", "2010-12-01", "99999999999.5", "7", "X"))))
    assert row["UnitPrice"] is None


def test_features(spark):
    rows = fact(
        spark,
        ("536365", "A", "d", 10, "3.00", "2010-12-01 08:26:00", "17850", "UK"),
        ("C536366", "B", "d", -2, "5.00", "2010-12-05 14:30:00", "GUEST", "UK"),
        ("3", "C", "d", 1, "9.99", "2010-12-05 14:30:00", "1", "UK"),
        ("4", "C", "d", 1, "50.00", "2010-12-05 14:30:00", "1", "UK"),
        ("5", "C", "d", 1, "50.01", "2010-12-05 14:30:00", "1", "UK"),
        ("6", "C", "d", -1, "50.01", "2010-12-05 14:30:00", "1", "UK"),
    )
    out = {r["invoice_no"]: r for r in rows.collect()}
    first, second = out["536365"], out["C536366"]
    assert first["total_amount"] == Decimal("30.00")
    assert [first[c] for c in ("invoice_year", "invoice_month", "invoice_quarter", "day_of_week", "invoice_hour")] == [
        2010, 12, 4, "Wednesday", 8
    ]
    assert (first["is_cancellation"], first["customer_type"], first["revenue_bucket"]) == (False, "Registered", "Medium (£10-£50)")
    assert (second["is_cancellation"], second["customer_type"], second["revenue_bucket"]) == (True, "Guest", "Cancellation")
    assert second["total_amount"] == Decimal("-10.00")
    assert (second["day_of_week"], second["invoice_hour"]) == ("Sunday", 14)
    assert [out[i]["revenue_bucket"] for i in "3456"] == ["Low (< £10)", "Medium (£10-£50)", "High (> £50)", "Cancellation"]


def test_features_with_missing_columns(spark):
    row = one(add_features(spark.createDataFrame([("1",)], "StockCode string")))
    assert (row["TotalPrice"], row["IsCancellation"], row["CustomerType"], row["RevenueBucket"]) == (
        Decimal("0.00"), False, "Guest", "Low (< £10)"
    )
    row = one(add_features(spark.createDataFrame([(None, None, None)], "InvoiceNo string, Quantity int, UnitPrice decimal(10,2)")))
    assert (row["IsCancellation"], row["RevenueBucket"]) == (False, "Low (< £10)")


def test_line_total_is_rounded_after_multiplying(spark):
    row = one(fact(spark, ("1", "A", "d", 6, "2.555", "2010-12-01 00:00:00", "1", "UK")))
    assert row["total_amount"] == Decimal("15.33")


def test_constraints(spark):
    rows = fact(
        spark,
        ("1", "A", "d", 0, "1.00", "2010-12-01 00:00:00", "1", "UK"),
        ("2", "A", "d", 1, "-1.00", "2010-12-01 00:00:00", "1", "UK"),
        ("3", "A", None, 1, "1.00", "2010-12-01 00:00:00", "1", "UK"),
        ("4", "A", "d", 3_000_000_000, "1.00", "2010-12-01 00:00:00", "1", "UK"),
        ("5", "A", "d", 1, "1.00", "2010-12-01 00:00:00", "1", "UK"),
    )
    counts = one(constraint_violations(rows))
    assert (counts["total_rows"], counts["quantity_zero"], counts["unit_price_negative"]) == (5, 1, 1)
    assert counts["null_in_required_column"] == 2
    assert [r["invoice_no"] for r in rows.where(meets_constraints()).collect()] == ["5"]


def test_synthetic_rows(spark):
    rows = synthetic.transactions(spark, 30).collect()
    assert len(rows) == 30
    assert [r["InvoiceNo"] for r in rows[:3]] == ["C536000", "536001", "536002"]
    assert [r["Quantity"] for r in rows[:2]] == [-1, 6]
    assert [r["CustomerID"] for r in rows[:4]] == [None, "17850", "17850", None]
    assert [r["Description"] is None for r in rows[:2]] == [False, True]


@pytest.mark.parametrize("value, text", [
    (None, "£0.00"), ("0", "£0.00"), ("45.30", "£45.30"), ("1250.50", "£1,250.50"), ("150000", "£150.0K"),
    ("1250000", "£1.25M"), ("-45.30", "-£45.30"), ("-1250000", "-£1.25M"), ("999999.99", "£1000.0K"),
])
def test_money_text(spark, value, text):
    row = spark.createDataFrame([(value,)], "x string").select(X.money_text(F.col("x").cast("decimal(18,2)")).alias("t"))
    assert row.first()["t"] == text


@pytest.mark.parametrize("value, text", [
    (None, "0"), (12450, "12,450"), (1250000, "1.25M"), (-12450, "-12,450"), (0, "0"),
])
def test_number_text(spark, value, text):
    assert spark.createDataFrame([(value,)], "x bigint").select(X.number_text(F.col("x")).alias("t")).first()["t"] == text


def test_percent_text(spark):
    row = spark.createDataFrame([(4.7, 12.345, None)], "a double, b double, c double").select(
        X.percent_text(F.col("a")), X.percent_text(F.col("b"), 2), X.percent_text(F.col("c"))
    ).first()
    assert tuple(row) == ("4.7%", "12.35%", "0.0%")


@pytest.mark.parametrize("numerator, denominator, places, expected", [
    (1, 3, 2, 0.33), (2, 3, 2, 0.67), (1, 200, 2, 0.01), (-1, 200, 2, -0.01), (2675, 1000, 2, 2.68), (1, 0, 2, None),
    (10**30, 10**29, 2, 10.0), (0, 5, 2, 0.0),
])
def test_half_up(spark, numerator, denominator, places, expected):
    row = spark.createDataFrame([(str(numerator), str(denominator))], "n string, d string")
    value = row.select(N.half_up(N.whole(F.col("n")), N.whole(F.col("d")), places).alias("v")).first()["v"]
    assert value == expected


def test_fact_columns_are_in_warehouse_order(spark):
    rows = fact(spark, ("1", "A", "d", 1, "1.00", "2010-12-01 00:00:00", "1", "UK"))
    assert rows.columns[:4] == ["invoice_no", "stock_code", "description", "quantity"]
    assert dict(rows.dtypes)["total_amount"] == "decimal(12,2)"
    assert to_fact_columns(spark.createDataFrame([("1",)], "InvoiceNo string")).columns == ["invoice_no"]


def test_numbers_and_stripped_text_are_as_spelled_out(spark):
    """The short ways against the rules they stand for, and a value is looked at twice at most."""
    ends = ["", *X.WHITESPACE, " \t", "  ", "a", "é", "~", "!", "\x7f", "\n\n"]
    texts = [a + middle + b for a in ends for middle in ("", "x y", "1", "-1.5", "é") for b in ends]
    numbers = ["1", "-1.5", "1.", ".5", "1e5", "1e400", "0x1p3", "0X1", "1.5d", "1f", "NaN", "Infinity", "1 ", "1  ", " 1", "1\n", "1\t", "", " ", ".", "1x", "1 1", "\n1"]
    rows = spark.createDataFrame([(text,) for text in [*texts, *numbers, None]], "v string")
    value = F.col("v")
    last = F.substring(F.rtrim(value), -1, 1)
    plain = (last.between("0", "9") | (last == ".")) & ~value.contains("x") & ~value.contains("X")
    both = rows.select(
        "v", X.strip(value).alias("a"), F.trim(value, F.lit(X.WHITESPACE)).alias("b"),
        C.number(value).alias("c"), F.when(plain, value.try_cast("double")).alias("d"),
    )
    assert [r["v"] for r in both.where("NOT (a <=> b AND c <=> d)").collect()] == []
    shown = spark._jvm.PythonSQLUtils.explainString(rows.where(C.number(value) > 0)._jdf.queryExecution(), "simple")
    assert shown.split("Filter", 1)[1].split("\n")[0].count("v#") <= 3  # with one for the check on null
