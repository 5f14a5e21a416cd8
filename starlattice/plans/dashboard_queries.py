"""Sales dashboard, inventory dashboard and filter lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from starlattice.operators import filters as lists
from starlattice.operators import inventory as inv
from starlattice.operators import sales
from starlattice.plans.registry import on_star
from starlattice.plans.star_sql import sales_by, stock_by

REVENUE = "CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS total_revenue"
QUANTITY = "CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_quantity"


def ratio_sql(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE) ELSE 0 END"


# --- sales dashboard --------------------------------------------------------


def sales_overview_sql(where: str) -> str:
    price = ratio_sql("SUM(amount)", "SUM(quantity)")
    return f"SELECT {REVENUE}, {QUANTITY}, {price} AS average_price FROM sold WHERE {where}"


on_star("sales_overview", lambda wh: sales.overview(wh, decimals=None), sales_overview_sql("TRUE"))
on_star(
    "sales_overview_of_a_state_and_type",
    lambda wh: sales.overview(wh, {"state": "ASIA", "customer_type": "Both", "year": "1998"}, None),
    sales_overview_sql("state = 'ASIA' AND customer_type = 'Both' AND year = 1998"),
)


def trend_sql(columns: str, label: str, where: str = "TRUE") -> str:
    return (
        f"SELECT {columns}, {label} AS label, CAST(SUM(amount) AS DOUBLE) AS value, "
        f"CAST(SUM(quantity) AS BIGINT) AS quantity FROM sold WHERE {where} GROUP BY {columns}"
    )


on_star("sales_trend_year", lambda wh: sales.trend(wh, "year"), trend_sql("year", "CAST(year AS VARCHAR)"))
on_star(
    "sales_trend_quarter",
    lambda wh: sales.trend(wh, "quarter", {"city": "NATION_7"}),
    trend_sql("year, quarter", "year || '-Q' || quarter", "city = 'NATION_7'"),
)
on_star(
    "sales_trend_quarter_of_a_year",
    lambda wh: sales.trend(wh, "quarter", {"year": 1996}),
    trend_sql("quarter", "'Q' || quarter", "year = 1996"),
)
on_star(
    "sales_trend_month",
    lambda wh: sales.trend(wh, "month"),
    trend_sql("year, quarter, month", "'Q' || quarter || '-M' || month"),
)
on_star(
    "sales_trend_month_of_a_year",
    lambda wh: sales.trend(wh, "month", {"year": 2000, "customer_type": "Tourist"}),
    trend_sql("quarter, month", "'Q' || quarter || '-M' || month", "year = 2000 AND customer_type = 'Tourist'"),
)
on_star(
    "sales_trend_month_of_a_quarter",
    lambda wh: sales.trend(wh, "month", {"quarter": 3}),
    trend_sql("month", "'M' || month", "quarter = 3"),
)


def products_sql(direction: str, where: str = "TRUE") -> str:
    return (
        "SELECT product_key, 'Product ' || product_key AS product_name, CAST(SUM(amount) AS DOUBLE) AS sum_amount, "
        f"CAST(SUM(quantity) AS BIGINT) AS total_quantity FROM sold WHERE {where} GROUP BY product_key "
        f"ORDER BY SUM(amount) {direction}, product_key LIMIT 5"
    )


on_star("sales_top_products", lambda wh: sales.ranked_products(wh), products_sql("DESC"))
on_star(
    "sales_top_products_of_a_city",
    lambda wh: sales.ranked_products(wh, {"city": "NATION_3", "quarter": 4}),
    products_sql("DESC", "city = 'NATION_3' AND quarter = 4"),
)
on_star("sales_bottom_products", lambda wh: sales.ranked_products(wh, best=False), products_sql("ASC"))


def segments_sql(where: str = "TRUE") -> str:
    return (
        "SELECT customer_type, CAST(SUM(amount) AS DOUBLE) AS sum_amount, "
        "CAST(SUM(amount) AS DOUBLE) / CAST(SUM(SUM(amount)) OVER () AS DOUBLE) * 100 AS percentage "
        f"FROM sold WHERE {where} GROUP BY customer_type"
    )


on_star("sales_segments", lambda wh: sales.customer_segments(wh, decimals=None), segments_sql())
on_star(
    "sales_segments_of_a_quarter",
    lambda wh: sales.customer_segments(wh, {"year": 1997, "quarter": 2}, None),
    segments_sql("year = 1997 AND quarter = 2"),
)


def customers_sql(where: str = "TRUE") -> str:
    return (
        "SELECT customer_key, customer_name, customer_type, CAST(SUM(amount) AS DOUBLE) AS sum_amount, "
        "CAST(SUM(quantity) AS BIGINT) AS total_quantity, CAST(0 AS INTEGER) AS order_count, "
        "CAST(SUM(amount) AS DOUBLE) AS avg_order_value "
        f"FROM sold WHERE {where} GROUP BY customer_key, customer_name, customer_type "
        "ORDER BY SUM(amount) DESC, customer_key LIMIT 5"
    )


on_star("sales_top_customers", lambda wh: sales.top_customers(wh), customers_sql())
on_star(
    "sales_top_customers_of_a_type_and_state",
    lambda wh: sales.top_customers(wh, {"customer_type": "MailOrder", "state": "AFRICA", "year": 1999}),
    customers_sql("customer_type = 'MailOrder' AND state = 'AFRICA' AND year = 1999"),
)
on_star(
    "customer_cards",
    lambda wh: sales.customer_cards(wh),
    "SELECT customer_key, customer_name, customer_type, CAST(first_order_date AS VARCHAR) AS first_order_date, "
    "city, state, city || ', ' || state AS location FROM buyer LEFT JOIN location USING (location_key)",
)


def summary_sql(where: str = "TRUE", by: str = "") -> str:
    return (
        f"SELECT {by + ', ' if by else ''}{REVENUE}, {QUANTITY}, COUNT(*) AS order_count, "
        f"{ratio_sql('SUM(amount)', 'COUNT(*)')} AS avg_amount_per_order, "
        "COALESCE(MAX(year || '-' || LPAD(CAST(month AS VARCHAR), 2, '0')), 'N/A') AS last_order_date "
        f"FROM sold WHERE {where}{' GROUP BY ' + by if by else ''}"
    )


on_star(
    "customer_summary_of_every_customer",
    lambda wh: sales.customer_summary(wh, by=("customer_key",)),
    summary_sql(by="customer_key"),
)
on_star(
    "customer_summary_of_one",
    lambda wh: sales.customer_summary(wh, {"customer_key": 0, "year": "1998", "state": "All"}),
    summary_sql("customer_key = 0 AND year = 1998"),
)
on_star(
    "customer_summary_of_a_segment",
    lambda wh: sales.customer_summary(wh, {"customer_type": "Tourist", "state": "EUROPE"}),
    summary_sql("customer_type = 'Tourist' AND state = 'EUROPE'"),
)


def transactions_sql(where: str, limit: str) -> str:
    return (
        "SELECT year || '-' || LPAD(CAST(month AS VARCHAR), 2, '0') AS period, product_key, customer_key, "
        "p_name AS product_name, CAST(quantity AS BIGINT) AS quantity_ordered, CAST(amount AS DOUBLE) AS total_amount "
        f"FROM sold JOIN part ON p_partkey = product_key WHERE {where} "
        f"ORDER BY time_key DESC, p_name, product_key, customer_key {limit}"
    )


on_star(
    "customer_transactions_of_one",
    lambda wh: sales.customer_transactions(wh, {"customer_key": 1}, page=2),
    transactions_sql("customer_key = 1", "LIMIT 5 OFFSET 5"),
)
on_star(
    "customer_transactions_of_a_city",
    lambda wh: sales.customer_transactions(wh, {"city": "NATION_4"}, page=3, page_size=40),
    transactions_sql("city = 'NATION_4'", "LIMIT 40 OFFSET 80"),
)
on_star(
    "customer_transaction_counts",
    lambda wh: sales.customer_transaction_counts(wh, {"city": "NATION_4"}, 40),
    "SELECT COUNT(*) AS total_rows, CAST(CEIL(COUNT(*) / 40) AS BIGINT) AS total_pages FROM sold WHERE city = 'NATION_4'",
)

# --- inventory dashboard ----------------------------------------------------

TIME = {"year": "year", "quarter": "year, quarter", "month": "year, quarter, month"}
LABEL = {
    "year": "CAST(year AS VARCHAR)",
    "quarter": "year || '-' || quarter",
    "month": "year || '-' || quarter || '-' || month",
}


def merged_sql(keys: str, sales_where: str | None = None, stock_where: str | None = None) -> str:
    names = keys.split(", ")
    return (
        f"SELECT {keys}, COALESCE(total_quantity, 0) AS sold_quantity, COALESCE(sum_amount, 0) AS sold_amount, "
        "COALESCE(total_quantity_on_hand, 0) AS held FROM "
        f"({sales_by(names, sales_where)}) s FULL JOIN ({stock_by(names, stock_where)}) i USING ({keys})"
    )


def coverage_sql(level: str, by: str = "", sales_where: str | None = None, stock_where: str | None = None) -> str:
    keys = f"{by}, {TIME[level]}" if by else TIME[level]
    window = f"({'PARTITION BY ' + by if by else ''} ORDER BY {TIME[level]})"
    return (
        f"SELECT {keys}, {LABEL[level]} AS time_key, CAST(COALESCE(next_quantity, 0) AS BIGINT) AS total_quantity, "
        "COALESCE(next_amount, 0) AS sum_amount, held AS total_quantity_on_hand, "
        f"{ratio_sql('held', 'next_quantity')} AS coverage_ratio FROM ("
        f"SELECT *, LEAD(sold_quantity) OVER {window} AS next_quantity, LEAD(sold_amount) OVER {window} AS next_amount "
        f"FROM ({merged_sql(keys, sales_where, stock_where)}))"
    )


for _level in TIME:

    def _register_coverage(level: str) -> None:
        on_star(
            f"forward_coverage_{level}",
            lambda wh: inv.forward_coverage(wh, level, decimals=None),
            coverage_sql(level),
        )
        on_star(
            f"forward_coverage_{level}_of_every_product",
            lambda wh: inv.forward_coverage(wh, level, by=["product_key"], decimals=None),
            coverage_sql(level, "product_key"),
        )

    _register_coverage(_level)

on_star(
    "sales_by_period_of_a_state",
    lambda wh: inv.sales_by_period(wh, "quarter", {"state": "EUROPE", "store_key": 3}),
    sales_by(["year", "quarter"], "state = 'EUROPE'"),
)
on_star(
    "stock_by_period_of_a_store",
    lambda wh: inv.stock_by_period(wh, "month", {"store_key": 0}),
    stock_by(["year", "quarter", "month"], "store_key = 0"),
)
on_star(
    "product_analysis_trend",
    lambda wh: inv.product_analysis(wh, 0, "quarter", {"state": "ASIA"}, None),
    coverage_sql(
        "quarter",
        sales_where="state = 'ASIA' AND product_key = 0",
        stock_where="state = 'ASIA' AND product_key = 0",
    ),
)


def one_period_sql(shown: str, label: str, sales_where: str, stock_where: str) -> str:
    return (
        f"SELECT {shown}, '{label}' AS time_key, CAST(COALESCE(total_quantity, 0) AS BIGINT) AS total_quantity, "
        "COALESCE(sum_amount, 0) AS sum_amount, "
        "CAST(COALESCE(total_quantity_on_hand, 0) AS BIGINT) AS total_quantity_on_hand, "
        f"{ratio_sql('COALESCE(total_quantity_on_hand, 0)', 'total_quantity')} AS coverage_ratio "
        f"FROM ({sales_by([], sales_where)}), ({stock_by([], stock_where)})"
    )


on_star(
    "product_analysis_december",
    lambda wh: inv.product_analysis(wh, None, "month", {"year": 1998, "quarter": 4, "month": 12}, None),
    one_period_sql(
        "1998 AS year, 4 AS quarter, 12 AS month",
        "1998-4-12",
        "year = 1999 AND quarter = 1 AND month = 1",
        "year = 1998 AND quarter = 4 AND month = 12",
    ),
)
on_star(
    "product_analysis_fourth_quarter",
    lambda wh: inv.product_analysis(wh, None, "quarter", {"year": 1997, "quarter": 4, "city": "NATION_9"}, None),
    one_period_sql(
        "1997 AS year, 4 AS quarter",
        "1997-4",
        "year = 1998 AND quarter = 1 AND city = 'NATION_9'",
        "year = 1997 AND quarter = 4 AND city = 'NATION_9'",
    ),
)
on_star(
    "product_analysis_year",
    lambda wh: inv.product_analysis(wh, None, "year", {"year": 1999}, None),
    one_period_sql("1999 AS year", "1999", "year = 2000", "year = 1999"),
)


def stock_overview_sql(where: str | None = None) -> str:
    latest = (
        f"SELECT * FROM kept{' WHERE ' + where if where else ''} "
        "QUALIFY ROW_NUMBER() OVER (PARTITION BY product_key, store_key ORDER BY time_key DESC) = 1"
    )
    return (
        "SELECT CAST(SUM(on_hand) AS BIGINT) AS total_inventory, COUNT(DISTINCT store_key) AS total_stores, "
        "COUNT(DISTINCT product_key) AS total_products, "
        f"{ratio_sql('SUM(on_hand)', 'COUNT(DISTINCT store_key)')} AS avg_inventory_per_store FROM ({latest})"
    )


on_star("stock_overview", lambda wh: inv.overview(wh, decimals=None), stock_overview_sql())
on_star(
    "stock_overview_of_a_state_and_year",
    lambda wh: inv.overview(wh, {"state": "AMERICA", "year": 1998}, None),
    stock_overview_sql("state = 'AMERICA' AND year = 1998"),
)

STATUS = (
    "CASE WHEN CAST(held AS DOUBLE) > CAST(sold_quantity AS DOUBLE) * CAST(1.2 AS DOUBLE) THEN 'overstock' "
    "WHEN CAST(held AS DOUBLE) < CAST(sold_quantity AS DOUBLE) * CAST(0.8 AS DOUBLE) THEN 'understock' "
    "ELSE 'optimal' END"
)


def scatter_sql(sales_where: str | None = None, stock_where: str | None = None) -> str:
    return (
        "SELECT product_key, 'Product ' || product_key AS product_name, CAST(sold_quantity AS BIGINT) AS sales, "
        "CAST(held AS BIGINT) AS inventory, CASE WHEN sold_quantity > 0 "
        "THEN CAST(held AS DOUBLE) / CAST(sold_quantity AS DOUBLE) "
        f"WHEN held > 0 THEN CAST(999 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS coverage_ratio, {STATUS} AS status "
        f"FROM ({merged_sql('product_key', sales_where, stock_where)})"
    )


MARCH = {"year": 1998, "quarter": 1, "month": 3}
MARCH_SALES = "year = 1998 AND quarter = 2 AND month = 4"
MARCH_STOCK = "year = 1998 AND quarter = 1 AND month = 3"

on_star("product_scatter", lambda wh: inv.product_scatter(wh, decimals=None), scatter_sql())
on_star(
    "product_scatter_of_a_month",
    lambda wh: inv.product_scatter(wh, MARCH, None),
    scatter_sql(MARCH_SALES, MARCH_STOCK),
)
on_star(
    "product_scatter_of_a_store",
    lambda wh: inv.product_scatter(wh, {"store_key": 2, "state": "All"}, None),
    scatter_sql(None, "store_key = 2"),
)


def status_sql(scatter: str) -> str:
    counts = ", ".join(f"COUNT(*) FILTER (status = '{s}') AS {s}" for s in inv.STATUSES)
    return f"SELECT {counts} FROM ({scatter})"


on_star(
    "product_status_counts",
    lambda wh: inv.status_counts(inv.product_scatter(wh, MARCH)),
    status_sql(scatter_sql(MARCH_SALES, MARCH_STOCK)),
)
on_star(
    "most_over_ordered_products",
    lambda wh: inv.most_over_ordered(inv.product_scatter(wh, decimals=None)),
    f"SELECT * FROM ({scatter_sql()}) ORDER BY inventory DESC, sales, product_key LIMIT 5",
)
on_star(
    "most_short_products",
    lambda wh: inv.most_short(inv.product_scatter(wh, decimals=None)),
    f"SELECT * FROM ({scatter_sql()}) ORDER BY inventory, sales DESC, product_key LIMIT 5",
)


def city_risk_sql(where: str | None = None) -> str:
    def score(top: str, bottom: str) -> str:
        divisor = f"CASE WHEN {bottom} > 0 THEN {bottom} ELSE 1 END"
        return f"CAST(CAST({top} AS DOUBLE) / CAST({divisor} AS DOUBLE) AS DECIMAL(38,12))"

    def mean(status: str, column: str) -> str:
        kept = f"FILTER (status = '{status}')"
        return ratio_sql(f"SUM({column}) {kept}", f"COUNT(*) {kept}")

    return (
        "SELECT city, state, COUNT(*) FILTER (status = 'overstock') AS overstock_count, "
        f"{mean('overstock', 'over')} AS overstock_score, "
        "COUNT(*) FILTER (status = 'understock') AS understock_count, "
        f"{mean('understock', 'under')} AS understock_score, "
        f"{ratio_sql('SUM(held)', 'COUNT(*)')} AS avg_inventory, CAST(SUM(sold_quantity) AS BIGINT) AS total_sales "
        f"FROM (SELECT *, {STATUS} AS status, {score('held', 'sold_quantity')} AS over, "
        f"{score('sold_quantity', 'held')} AS under "
        f"FROM ({merged_sql('city, state, product_key', where, where)})) GROUP BY city, state"
    )


on_star("city_risk", lambda wh: inv.city_risk(wh, decimals=None), city_risk_sql())
on_star(
    "city_risk_of_a_quarter",
    lambda wh: inv.city_risk(wh, {"year": 1999, "quarter": 2}, None),
    city_risk_sql("year = 1999 AND quarter = 2"),
)


def _register_riskiest(kind: str) -> None:
    on_star(
        f"riskiest_cities_by_{kind}",
        lambda wh: inv.riskiest_cities(inv.city_risk(wh, decimals=None), kind),
        f"SELECT * FROM ({city_risk_sql()}) WHERE {kind}_count > 0 ORDER BY {kind}_score DESC, city, state LIMIT 3",
    )


for _kind in ("overstock", "understock"):
    _register_riskiest(_kind)

on_star(
    "stocked_products_page",
    lambda wh: inv.stocked_products(wh, page=2),
    "SELECT product_key, 'Product ' || product_key AS product_name, total_quantity_on_hand AS total_inventory "
    f"FROM ({stock_by(['product_key'])}) ORDER BY product_key LIMIT 50 OFFSET 50",
)
on_star(
    "stocked_stores",
    lambda wh: inv.stocked_stores(wh),
    "SELECT store_key, 'Store ' || store_key AS store_name, total_quantity_on_hand AS total_inventory "
    f"FROM ({stock_by(['store_key'])})",
)

# --- filter lists -----------------------------------------------------------

on_star("filter_years", lists.years, "SELECT DISTINCT year FROM sales JOIN months USING (time_key)")
on_star("filter_states", lists.states, "SELECT DISTINCT state FROM sold")
on_star("filter_cities", lists.cities, "SELECT DISTINCT state, city FROM sold")
on_star(
    "filter_cities_of_a_state",
    lambda wh: lists.cities(wh, "EUROPE"),
    "SELECT DISTINCT state, city FROM sold WHERE state = 'EUROPE'",
)
on_star("filter_customer_types", lists.customer_types, "SELECT DISTINCT customer_type FROM sold")


def as_text(df):
    """The two short lists as comma-separated text."""
    return df.select(*[F.concat_ws(",", c).alias(c) for c in df.columns])


def cascading_sql(where: str) -> str:
    lists_ = ", ".join(
        f"ARRAY_TO_STRING(LIST_SORT(LIST(DISTINCT {c})), ',') AS {c}s" for c in ("quarter", "month")
    )
    return f"SELECT {lists_} FROM sold WHERE {where}"


on_star(
    "filter_periods_of_a_year",
    lambda wh: as_text(lists.cascading_periods(wh, 2001)),
    cascading_sql("year = 2001"),
)
on_star(
    "filter_periods_of_a_quarter",
    lambda wh: as_text(lists.cascading_periods(wh, 1999, 2)),
    cascading_sql("year = 1999 AND quarter = 2"),
)
on_star(
    "search_products",
    lambda wh: lists.search_products(wh, "17"),
    "SELECT DISTINCT product_key, 'Product ' || product_key AS product_name FROM sales "
    "WHERE CAST(product_key AS VARCHAR) LIKE '%17%' ORDER BY product_key LIMIT 10",
)
on_star(
    "search_customers",
    lambda wh: lists.search_customers(wh, " 5 ", "ASIA", customer_type="Tourist", limit=1000),
    "SELECT DISTINCT customer_key FROM sold WHERE CAST(customer_key AS VARCHAR) ILIKE '%5%' "
    "AND state = 'ASIA' AND customer_type = 'Tourist' ORDER BY customer_key LIMIT 100",
)
on_star(
    "search_stores",
    lambda wh: lists.search_stores(wh, "", "AFRICA", "All"),
    "SELECT DISTINCT store_key FROM kept WHERE state = 'AFRICA' ORDER BY store_key LIMIT 20",
)
on_star(
    "search_products_by_grams",
    lambda wh: lists.search_products(wh, "101", limit=1_000_000, by_grams=True),
    "SELECT DISTINCT product_key, 'Product ' || product_key AS product_name FROM sales "
    "WHERE CAST(product_key AS VARCHAR) LIKE '%101%'",
)
on_star(
    "search_customers_by_grams",
    lambda wh: lists.search_customers(wh, " 1_3%11 ", "ASIA", customer_type="Tourist", limit=1_000_000, by_grams=True)
    .unionByName(lists.search_customers(wh, "112", customer_type="Tourist", limit=1_000_000, by_grams=True)),
    "SELECT DISTINCT customer_key FROM sold WHERE CAST(customer_key AS VARCHAR) ILIKE '%1_3%11%' "
    "AND state = 'ASIA' AND customer_type = 'Tourist' UNION ALL "
    "SELECT DISTINCT customer_key FROM sold WHERE CAST(customer_key AS VARCHAR) LIKE '%112%' AND customer_type = 'Tourist'",
)
on_star(
    "search_stores_by_grams",
    lambda wh: lists.search_stores(wh, "10%", "AFRICA", limit=1_000_000, by_grams=True)
    .unionByName(lists.search_stores(wh, "100", limit=1_000_000, by_grams=True)),
    "SELECT DISTINCT store_key FROM kept WHERE CAST(store_key AS VARCHAR) LIKE '%10%' AND state = 'AFRICA' UNION ALL "
    "SELECT DISTINCT store_key FROM kept WHERE CAST(store_key AS VARCHAR) LIKE '%100%'",
)
on_star(
    "filter_products_page",
    lambda wh: lists.products(wh, page=2),
    "SELECT DISTINCT product_key, 'Product ' || product_key AS product_name FROM sales "
    "ORDER BY product_key LIMIT 100 OFFSET 100",
)
on_star(
    "filter_product_page_counts",
    lists.product_page_counts,
    "SELECT COUNT(DISTINCT product_key) AS total_rows, CAST(CEIL(COUNT(DISTINCT product_key) / 100) AS BIGINT) AS total_pages FROM sales",
)
