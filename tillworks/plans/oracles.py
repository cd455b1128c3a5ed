"""The same questions in SQL, for checking the DataFrame plans against another engine.

Rounded ratios use whole-number arithmetic here too, so both sides are exact.
"""

from __future__ import annotations

from tillworks.operators.kpis import KPI_SET

JOINS = """
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
"""

FACT = f"""
raw AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS invoice_no,
         CAST(l_partkey AS VARCHAR) AS stock_code,
         p_name AS description,
         CAST(l_quantity AS INTEGER) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS invoice_timestamp,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'GUEST' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         n_name AS country
  {JOINS}
),
featured AS (
  SELECT *,
         CAST(quantity * unit_price AS DECIMAL(12,2)) AS total_amount,
         CAST(year(invoice_timestamp) AS SMALLINT) AS invoice_year,
         CAST(month(invoice_timestamp) AS SMALLINT) AS invoice_month,
         CAST(quarter(invoice_timestamp) AS SMALLINT) AS invoice_quarter,
         dayname(invoice_timestamp) AS day_of_week,
         CAST(hour(invoice_timestamp) AS SMALLINT) AS invoice_hour,
         CASE WHEN customer_id = 'GUEST' THEN 'Guest' ELSE 'Registered' END AS customer_type,
         (invoice_no LIKE 'C%' OR quantity < 0) AS is_cancellation
  FROM raw
),
fact AS (
  SELECT *,
         CASE WHEN is_cancellation THEN 'Cancellation'
              WHEN total_amount < 10 THEN 'Low (< £10)'
              WHEN total_amount <= 50 THEN 'Medium (£10-£50)'
              ELSE 'High (> £50)' END AS revenue_bucket
  FROM featured
),
sales AS (SELECT * FROM fact WHERE NOT is_cancellation),
cancelled AS (SELECT * FROM fact WHERE is_cancellation)
"""


def on_fact(query: str) -> str:
    return f"WITH {FACT} {query}"


def half_up(numerator: str, denominator: str, places: int = 2) -> str:
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    steps = f"((2 * abs({n}) * {10**places} + {d}) // nullif(2 * {d}, 0))"
    return f"(CAST(CASE WHEN {n} < 0 THEN -{steps} ELSE {steps} END AS DOUBLE) / {10**places})"


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def money_ratio(amount: str, count: str, places: int = 2) -> str:
    return half_up(cents(amount), f"100 * ({count})", places)


def percent(part: str, total: str, places: int = 2) -> str:
    return half_up(f"100 * ({part})", total, places)


def growth(current: str, previous: str, places: int = 2) -> str:
    return f"CASE WHEN {previous} > 0 THEN {half_up(f'100 * (({current}) - ({previous}))', previous, places)} END"


def dbl(amount: str) -> str:
    return f"CAST({amount} AS DOUBLE)"


ORDERS = "COUNT(DISTINCT invoice_no) AS total_orders"
REVENUE = "CAST(SUM(total_amount) AS DOUBLE) AS total_revenue"
UNITS = "CAST(SUM(quantity) AS BIGINT)"
REV0 = "coalesce(SUM(total_amount), 0)"


# --- display formats ---------------------------------------------------------------------


def fixed_text(steps: str, places: int) -> str:
    """A non-negative whole number of 10^-places steps as plain decimal text."""
    return f"(({steps}) // {10**places} || '.' || lpad(CAST(({steps}) % {10**places} AS VARCHAR), {places}, '0'))"


def grouped_text(number: str) -> str:
    return f"format('{{:,}}', CAST({number} AS BIGINT))"


def money_text(amount: str) -> str:
    """Pounds, from an amount with two decimals."""
    c = f"abs(CAST(({amount}) * 100 AS HUGEINT))"
    return f"""(CASE WHEN ({amount}) IS NULL THEN '£0.00' ELSE CASE WHEN ({amount}) < 0 THEN '-' ELSE '' END || '£' ||
      CASE WHEN {c} >= 100000000 THEN {fixed_text(f'(({c} * 2 + 1000000) // 2000000)', 2)} || 'M'
           WHEN {c} >= 10000000 THEN {fixed_text(f'(({c} * 2 + 10000) // 20000)', 1)} || 'K'
           WHEN {c} >= 100000 THEN {grouped_text(f'{c} // 100')} || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0')
           ELSE {fixed_text(c, 2)} END END)"""


def number_text(number: str) -> str:
    """Counts, from a whole number."""
    n = f"abs(CAST({number} AS HUGEINT))"
    return f"""(CASE WHEN ({number}) IS NULL THEN '0' ELSE CASE WHEN ({number}) < 0 THEN '-' ELSE '' END ||
      CASE WHEN {n} >= 1000000 THEN {fixed_text(f'(({n} * 2 + 10000) // 20000)', 2)} || 'M'
           ELSE {grouped_text(n)} END END)"""


def signed_fixed(value: str) -> str:
    """One decimal, half up, from a DOUBLE that has at most two."""
    steps = f"((abs(CAST(round(({value}) * 100) AS HUGEINT)) * 2 + 10) // 20)"
    return f"(CASE WHEN ({value}) < 0 AND {steps} > 0 THEN '-' ELSE '' END || {fixed_text(steps, 1)})"


def percent_text(value: str) -> str:
    return f"(CASE WHEN ({value}) IS NULL THEN '0.0%' ELSE {signed_fixed(value)} || '%' END)"


# --- filters -----------------------------------------------------------------------------

LINE = "invoice_no, stock_code, quantity, invoice_timestamp, CAST(total_amount AS DOUBLE) AS total_amount"
DATES = "invoice_timestamp >= TIMESTAMP '1996-03-01' AND invoice_timestamp < TIMESTAMP '1997-07-01'"

FILTERS = {
    "flt_date_range": on_fact(f"SELECT {LINE} FROM fact WHERE {DATES}"),
    "flt_country": on_fact(f"SELECT {LINE}, country FROM fact WHERE country = 'NATION_7'"),
    "flt_customer_type": on_fact(f"SELECT {LINE}, customer_type FROM fact WHERE customer_type = 'Guest'"),
    "flt_transaction_type": on_fact(f"SELECT {LINE}, is_cancellation FROM fact WHERE is_cancellation"),
    "flt_default_sales": on_fact(f"SELECT {LINE}, is_cancellation FROM fact WHERE NOT is_cancellation"),
    "flt_registered": on_fact(f"SELECT {LINE}, customer_id FROM fact WHERE customer_id <> 'GUEST'"),
    "flt_having": on_fact(
        "SELECT customer_id, COUNT(DISTINCT invoice_no) AS total_orders FROM fact "
        "GROUP BY customer_id HAVING COUNT(DISTINCT invoice_no) > 1"
    ),
}

# --- features ----------------------------------------------------------------------------

KEY = "invoice_no, stock_code, quantity, invoice_timestamp"
FEATURES = {
    "feat_total": on_fact(f"SELECT {KEY}, CAST(total_amount AS DOUBLE) AS total_price FROM fact"),
    "feat_year": on_fact(f"SELECT {KEY}, invoice_year FROM fact"),
    "feat_month": on_fact(f"SELECT {KEY}, invoice_month FROM fact"),
    "feat_quarter": on_fact(f"SELECT {KEY}, invoice_quarter FROM fact"),
    "feat_weekday": on_fact(f"SELECT {KEY}, day_of_week FROM fact"),
    "feat_hour": on_fact(f"SELECT {KEY}, invoice_hour FROM fact"),
    "feat_cancellation": on_fact(f"SELECT {KEY}, is_cancellation FROM fact"),
    "feat_customer_type": on_fact(f"SELECT {KEY}, customer_id, customer_type FROM fact"),
    "feat_revenue_bucket": on_fact(f"SELECT {KEY}, revenue_bucket FROM fact"),
    "feat_all": on_fact(
        f"SELECT {KEY}, CAST(total_amount AS DOUBLE) AS total_amount, invoice_year, invoice_month, "
        "invoice_quarter, day_of_week, invoice_hour, is_cancellation, customer_type, revenue_bucket FROM fact"
    ),
}

# --- KPIs --------------------------------------------------------------------------------

CANCELLED_INVOICES = "COUNT(DISTINCT CASE WHEN is_cancellation THEN invoice_no END)"
MONTHLY = """
monthly AS (
  SELECT date_trunc('month', invoice_timestamp) AS m, SUM(total_amount) AS revenue,
         COUNT(DISTINCT invoice_no) AS orders
  FROM sales GROUP BY 1
),
lagged AS (
  SELECT m, revenue, orders, LAG(revenue) OVER (ORDER BY m) AS prev_revenue,
         LAG(orders) OVER (ORDER BY m) AS prev_orders
  FROM monthly
),
growth AS (
  SELECT coalesce(MAX({rev}), 0) AS revenue_growth_pct, coalesce(MAX({ord}), 0) AS monthly_order_growth_pct
  FROM lagged WHERE m = (SELECT MAX(m) FROM monthly)
)
""".format(
    rev=growth(cents("revenue"), cents("prev_revenue")), ord=growth("orders", "prev_orders")
)

KPI_WIDE = f"""
{MONTHLY},
sold AS (
  SELECT {REV0} AS revenue, coalesce(SUM(quantity), 0) AS units, COUNT(DISTINCT invoice_no) AS orders,
         COUNT(DISTINCT CASE WHEN customer_type = 'Registered' THEN customer_id END) AS registered,
         COUNT(DISTINCT CASE WHEN customer_type = 'Guest' THEN customer_id END) AS guests,
         coalesce(SUM(CASE WHEN customer_type = 'Registered' THEN total_amount END), 0) AS registered_revenue
  FROM sales
),
every AS (
  SELECT COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT stock_code) AS products,
         COUNT(DISTINCT invoice_no) AS invoices, {CANCELLED_INVOICES} AS cancelled,
         abs(coalesce(SUM(CASE WHEN is_cancellation THEN total_amount END), 0)) AS impact
  FROM fact
),
best AS (
  SELECT description AS top_product, SUM(total_amount) AS top_revenue
  FROM sales GROUP BY stock_code, description
  ORDER BY top_revenue DESC, stock_code, description LIMIT 1
),
wide AS (
  SELECT revenue, orders, customers, products,
         coalesce({money_ratio('revenue', 'orders')}, 0) AS aov,
         coalesce({half_up('units', 'orders', 1)}, 0) AS items,
         cancelled, coalesce({percent('cancelled', 'invoices')}, 0) AS cancel_rate, impact,
         revenue_growth_pct, monthly_order_growth_pct, registered, guests, registered_revenue,
         coalesce({money_ratio('revenue', 'customers')}, 0) AS per_customer,
         top_product, {percent(cents('top_revenue'), cents('revenue'), 1)} AS top_share,
         {percent('guests', 'customers', 1)} AS guest_share
  FROM sold, every, growth LEFT JOIN best ON TRUE
)
"""

# KPI key -> (value in wide, formatted text)
KPI_VALUES = {
    "total_revenue": ("revenue", money_text("revenue")),
    "total_orders": ("orders", number_text("orders")),
    "total_customers": ("customers", number_text("customers")),
    "total_products": ("products", number_text("products")),
    "average_order_value": ("aov", money_text("CAST(aov AS DECIMAL(18,2))")),
    "average_items_per_order": ("items", signed_fixed("items")),
    "cancellation_count": ("cancelled", number_text("cancelled")),
    "cancellation_rate": ("cancel_rate", percent_text("cancel_rate")),
    "cancellation_revenue_impact": ("impact", money_text("impact")),
    "revenue_growth_pct": ("revenue_growth_pct", percent_text("revenue_growth_pct")),
    "monthly_order_growth_pct": ("monthly_order_growth_pct", percent_text("monthly_order_growth_pct")),
    "registered_customers": ("registered", number_text("registered")),
    "guest_customers": ("guests", number_text("guests")),
    "registered_customer_revenue": ("registered_revenue", money_text("registered_revenue")),
    "revenue_per_customer": ("per_customer", money_text("CAST(per_customer AS DECIMAL(18,2))")),
}


def kpi_records() -> str:
    return " UNION ALL ".join(
        f"SELECT {place} AS position, '{key}' AS kpi, '{name}' AS name, {dbl(KPI_VALUES[key][0])} AS value, "
        f"{KPI_VALUES[key][1]} AS formatted_value, '{category}' AS category, '{description}' AS description, "
        f"'{unit}' AS unit FROM wide"
        for place, (key, name, category, unit, description) in enumerate(KPI_SET, start=1)
    )


TOP_NAME = (
    "SELECT coalesce((SELECT {name} FROM sales GROUP BY {name} "
    "ORDER BY SUM(total_amount) DESC, {name} LIMIT 1), 'N/A') AS {out}"
)
BUYERS = (
    "(SELECT customer_id, COUNT(DISTINCT invoice_no) AS n FROM sales "
    "WHERE customer_type = 'Registered' AND customer_id <> 'GUEST' GROUP BY customer_id)"
)
REPEAT_RATE = f"(SELECT coalesce({percent('COUNT(*) FILTER (n > 1)', 'COUNT(*)')}, 0) FROM {BUYERS})"
CANCEL_RATE = f"(SELECT coalesce({percent(CANCELLED_INVOICES, 'COUNT(DISTINCT invoice_no)')}, 0) FROM fact)"


def from_wide(value: str, name: str) -> str:
    return f"WITH {FACT}, {KPI_WIDE} SELECT {value} AS {name} FROM wide"


KPIS = {
    "kpi_total_revenue": on_fact(f"SELECT {dbl(REV0)} AS total_revenue FROM sales"),
    "kpi_total_orders": on_fact(f"SELECT {ORDERS} FROM sales"),
    "kpi_total_units": on_fact("SELECT CAST(coalesce(SUM(quantity), 0) AS BIGINT) AS total_units_sold FROM sales"),
    "kpi_total_customers": on_fact("SELECT COUNT(DISTINCT customer_id) AS total_customers FROM fact"),
    "kpi_total_products": on_fact("SELECT COUNT(DISTINCT stock_code) AS total_products FROM fact"),
    "kpi_aov": on_fact(
        f"SELECT coalesce({money_ratio(REV0, 'COUNT(DISTINCT invoice_no)')}, 0) AS average_order_value FROM sales"
    ),
    "kpi_avg_unit_price": on_fact(
        f"SELECT coalesce({money_ratio('SUM(unit_price)', 'COUNT(unit_price)')}, 0) AS average_unit_price FROM sales"
    ),
    "kpi_cancel_count": on_fact(f"SELECT {CANCELLED_INVOICES} AS cancellation_count FROM fact"),
    "kpi_cancel_rate": on_fact(f"SELECT {CANCEL_RATE} AS cancellation_rate_pct"),
    "kpi_cancel_impact": on_fact(f"SELECT {dbl(f'abs({REV0})')} AS cancellation_revenue_impact FROM cancelled"),
    "kpi_repeat_rate": on_fact(f"SELECT {REPEAT_RATE} AS repeat_customer_rate_pct"),
    "kpi_top_product": on_fact(TOP_NAME.format(name="description", out="top_product")),
    "kpi_top_country": on_fact(TOP_NAME.format(name="country", out="top_country")),
    "kpi_items_per_order": from_wide("items", "average_items_per_order"),
    "kpi_revenue_growth": from_wide("revenue_growth_pct", "revenue_growth_pct"),
    "kpi_order_growth": from_wide("monthly_order_growth_pct", "monthly_order_growth_pct"),
    "kpi_registered_customers": from_wide("registered", "registered_customers"),
    "kpi_guest_customers": from_wide("guests", "guest_customers"),
    "kpi_registered_revenue": from_wide(dbl("registered_revenue"), "registered_customer_revenue"),
    "kpi_revenue_per_customer": from_wide("per_customer", "revenue_per_customer"),
    "kpi_set_basic": on_fact(f"""
        SELECT {dbl(REV0)} AS total_revenue, {ORDERS},
               CAST(coalesce(SUM(quantity), 0) AS BIGINT) AS total_units_sold,
               (SELECT COUNT(DISTINCT customer_id) FROM fact) AS total_customers,
               coalesce({money_ratio(REV0, 'COUNT(DISTINCT invoice_no)')}, 0) AS average_order_value,
               {CANCEL_RATE} AS cancellation_rate_pct,
               coalesce({money_ratio('SUM(unit_price)', 'COUNT(unit_price)')}, 0) AS average_unit_price,
               {REPEAT_RATE} AS repeat_customer_rate_pct,
               ({TOP_NAME.format(name='description', out='p')}) AS top_product,
               ({TOP_NAME.format(name='country', out='c')}) AS top_country,
               {CANCEL_RATE} AS cancellation_rate,
               {REPEAT_RATE} AS repeat_customer_rate
        FROM sales"""),
    "kpi_set_full": f"WITH {FACT}, {KPI_WIDE} {kpi_records()}",
    "kpi_format": on_fact(f"""
        SELECT customer_id, {money_text('SUM(total_amount)')} AS revenue_text,
               {number_text('SUM(quantity)')} AS units_text,
               {percent_text(percent(CANCELLED_INVOICES, 'COUNT(DISTINCT invoice_no)'))} AS cancelled_text
        FROM fact GROUP BY customer_id"""),
}

# --- breakdowns --------------------------------------------------------------------------

AOV = f"{money_ratio('SUM(total_amount)', 'COUNT(DISTINCT invoice_no)')} AS average_order_value"


def trend(unit: str) -> str:
    return on_fact(
        f"SELECT date_trunc('{unit}', invoice_timestamp)::TIMESTAMP AS period, {ORDERS}, {UNITS} AS total_units, "
        f"{REVENUE}, {AOV} FROM sales GROUP BY 1"
    )


PRODUCT = "stock_code, description"
BY_MONTH = on_fact(
    "SELECT date_trunc('month', invoice_timestamp)::TIMESTAMP AS period, invoice_year, invoice_month, "
    f"{ORDERS}, {UNITS} AS total_units, {REVENUE}, {AOV} FROM sales GROUP BY 1, 2, 3"
)
BY_COUNTRY = on_fact(f"SELECT country, {ORDERS}, {REVENUE} FROM sales GROUP BY country")
TOP_PRODUCTS = on_fact(
    f"SELECT {PRODUCT}, {UNITS} AS total_units_sold, {REVENUE}, {ORDERS} FROM sales GROUP BY {PRODUCT} "
    f"ORDER BY SUM(total_amount) DESC, {PRODUCT} LIMIT 10"
)
SEGMENT = f"customer_type, COUNT(DISTINCT customer_id) AS customer_count, {ORDERS}, {REVENUE}"
SEGMENTS = on_fact(
    f"SELECT {SEGMENT}, {money_ratio('SUM(total_amount)', 'COUNT(DISTINCT customer_id)')} AS revenue_per_customer "
    "FROM sales GROUP BY customer_type"
)
RETURNED = on_fact(
    f"SELECT {PRODUCT}, abs({UNITS}) AS total_returned_units, {dbl('abs(SUM(total_amount))')} AS total_returned_value "
    f"FROM cancelled GROUP BY {PRODUCT} ORDER BY abs(SUM(total_amount)) DESC, {PRODUCT} LIMIT 10"
)

BREAKDOWNS = {
    "brk_month": BY_MONTH,
    "brk_country": BY_COUNTRY,
    "brk_top_products": TOP_PRODUCTS,
    "brk_top_products_qty": on_fact(
        f"SELECT {PRODUCT}, {UNITS} AS total_units_sold, {REVENUE} FROM sales GROUP BY {PRODUCT} "
        f"ORDER BY SUM(quantity) DESC, {PRODUCT} LIMIT 10"
    ),
    "brk_returned_products": RETURNED,
    "brk_segments": SEGMENTS,
    "brk_customer_summary": on_fact(f"SELECT {SEGMENT} FROM sales GROUP BY customer_type"),
    "brk_top_customers": on_fact(f"""
        , per AS (
          SELECT customer_id, customer_type, country, {ORDERS}, SUM(total_amount) AS revenue
          FROM sales WHERE customer_id <> 'GUEST' GROUP BY 1, 2, 3
        )
        SELECT DENSE_RANK() OVER (ORDER BY revenue DESC) AS rank, customer_id, customer_type, country,
               total_orders, {dbl('revenue')} AS total_revenue
        FROM per ORDER BY revenue DESC, customer_id, country LIMIT 10"""),
    "brk_trend_daily": trend("day"),
    "brk_trend_weekly": trend("week"),
    "brk_trend_monthly": trend("month"),
    "brk_trend_quarterly": trend("quarter"),
    "brk_cancel_trend": on_fact(
        "SELECT date_trunc('month', invoice_timestamp)::TIMESTAMP AS period, "
        f"COUNT(DISTINCT invoice_no) AS cancelled_orders, abs({UNITS}) AS cancelled_units, "
        f"{dbl('abs(SUM(total_amount))')} AS lost_revenue FROM cancelled GROUP BY 1"
    ),
    "brk_countries": on_fact(
        "SELECT 'All Countries' AS country, 0 AS place UNION ALL SELECT DISTINCT country, 1 FROM fact"
    ),
    "svc_sales_trends": BY_MONTH,
    "svc_customers": SEGMENTS,
    "svc_products": TOP_PRODUCTS,
    "svc_countries": BY_COUNTRY,
    "app_share": on_fact(f"""
        , per AS (SELECT customer_type, SUM(total_amount) AS revenue FROM sales GROUP BY 1)
        SELECT customer_type, {dbl('revenue')} AS total_revenue,
               {percent(cents('revenue'), f"(SELECT {cents('SUM(revenue)')} FROM per)")} AS revenue_share_pct
        FROM per"""),
}

# --- catalogue ---------------------------------------------------------------------------


def per(keys: str) -> str:
    return on_fact(f"SELECT {keys}, {ORDERS}, {REVENUE} FROM sales GROUP BY {keys}")


SALES_DAY = "date_trunc('day', invoice_timestamp)::TIMESTAMP AS sales_date"

CATALOG = {
    "q01": KPIS["kpi_total_revenue"],
    "q02": KPIS["kpi_total_orders"],
    "q03": KPIS["kpi_total_units"],
    "q04": on_fact(f"SELECT {money_ratio(REV0, 'COUNT(DISTINCT invoice_no)')} AS average_order_value FROM sales"),
    "q05": on_fact(f"SELECT {money_ratio('SUM(unit_price)', 'COUNT(unit_price)')} AS average_unit_price FROM sales"),
    "q06": KPIS["kpi_total_customers"],
    "q07": on_fact("SELECT customer_type, COUNT(DISTINCT customer_id) AS customer_count FROM fact GROUP BY 1"),
    "q08": BY_COUNTRY,
    "q09": on_fact(f"SELECT {PRODUCT}, {UNITS} AS total_units_sold, {REVENUE} FROM sales GROUP BY {PRODUCT}"),
    "q10": on_fact(
        f"SELECT {PRODUCT}, {REVENUE} FROM sales GROUP BY {PRODUCT} ORDER BY SUM(total_amount) DESC, {PRODUCT} LIMIT 10"
    ),
    "q11": on_fact(
        f"SELECT {PRODUCT}, {UNITS} AS total_units_sold FROM sales GROUP BY {PRODUCT} "
        f"ORDER BY SUM(quantity) DESC, {PRODUCT} LIMIT 10"
    ),
    "q12": per("invoice_year, invoice_month"),
    "q13": per("invoice_year, invoice_quarter"),
    "q14": per("invoice_year"),
    "q15": on_fact(f"SELECT {SALES_DAY}, {ORDERS}, {REVENUE} FROM sales GROUP BY 1"),
    "q16": per("day_of_week"),
    "q17": per("invoice_hour"),
    "q18": on_fact(
        f"SELECT COUNT(DISTINCT invoice_no) AS total_invoices, {CANCELLED_INVOICES} AS cancelled_invoices, "
        f"{percent(CANCELLED_INVOICES, 'COUNT(DISTINCT invoice_no)')} AS cancellation_rate_pct FROM fact"
    ),
    "q19": on_fact(f"SELECT {dbl('abs(SUM(total_amount))')} AS total_cancellation_loss FROM cancelled"),
    "q20": on_fact(
        f"SELECT customer_type, {ORDERS}, {REVENUE}, {money_ratio('SUM(total_amount)', 'COUNT(*)')} "
        "AS avg_line_item_value FROM sales GROUP BY 1"
    ),
    "q21": on_fact(f"""
        , monthly AS (SELECT invoice_year, invoice_month, SUM(total_amount) AS cur FROM sales GROUP BY 1, 2),
        lagged AS (SELECT *, LAG(cur) OVER (ORDER BY invoice_year, invoice_month) AS prev FROM monthly)
        SELECT invoice_year, invoice_month, {dbl('cur')} AS current_month_revenue,
               coalesce({dbl('prev')}, 0) AS previous_month_revenue,
               {growth(cents('cur'), cents('prev'))} AS mom_growth_pct
        FROM lagged"""),
    "q22": on_fact(f"""
        , ranked AS (
          SELECT country, stock_code, description, SUM(total_amount) AS revenue,
                 DENSE_RANK() OVER (PARTITION BY country ORDER BY SUM(total_amount) DESC) AS revenue_rank
          FROM sales GROUP BY 1, 2, 3
        )
        SELECT country, revenue_rank, stock_code, description, {dbl('revenue')} AS total_revenue
        FROM ranked WHERE revenue_rank <= 3"""),
    "q23": on_fact(f"""
        , per AS (
          SELECT customer_id, customer_type, {ORDERS}, SUM(total_amount) AS spent
          FROM sales WHERE customer_id <> 'GUEST' GROUP BY 1, 2
        )
        SELECT DENSE_RANK() OVER (ORDER BY spent DESC) AS customer_rank, customer_id, customer_type, total_orders,
               {dbl('spent')} AS total_spent,
               {percent(cents('spent'), f"(SELECT {cents('SUM(spent)')} FROM per)")} AS pct_of_total_revenue
        FROM per ORDER BY spent DESC, customer_id LIMIT 20"""),
    "q24": on_fact(f"""
        , daily AS (SELECT {SALES_DAY}, SUM(total_amount) AS revenue FROM sales GROUP BY 1)
        SELECT sales_date, {dbl('revenue')} AS daily_revenue,
               {dbl('SUM(revenue) OVER (ORDER BY sales_date)')} AS cumulative_running_revenue
        FROM daily"""),
    "q25": on_fact(f"""
        SELECT customer_id, {ORDERS}, MIN(invoice_timestamp) AS first_purchase_date,
               MAX(invoice_timestamp) AS last_purchase_date, {dbl('SUM(total_amount)')} AS lifetime_value
        FROM sales WHERE customer_id <> 'GUEST' GROUP BY customer_id HAVING COUNT(DISTINCT invoice_no) > 1"""),
    "v_monthly_sales": on_fact(f"""
        SELECT invoice_year, invoice_month, {ORDERS}, {REVENUE}, {UNITS} AS total_units_sold,
               COUNT(DISTINCT CASE WHEN customer_id <> 'GUEST' THEN customer_id END) AS active_registered_customers
        FROM sales GROUP BY 1, 2"""),
    "v_top_products": on_fact(
        f"SELECT {PRODUCT}, {UNITS} AS total_quantity_sold, {REVENUE}, {ORDERS} FROM sales GROUP BY {PRODUCT}"
    ),
}


def oracle_sql() -> dict[str, str]:
    return {**FEATURES, **FILTERS, **KPIS, **BREAKDOWNS, **CATALOG}
