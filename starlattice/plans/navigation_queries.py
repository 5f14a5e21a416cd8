"""Pivots, paging, drill operators and reports over the cuboids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from starlattice.functions.paging import page_after, page_of, sort_keys
from starlattice.operators import adhoc
from starlattice.operators import navigate as nav
from starlattice.plans.registry import on_star
from starlattice.plans.star_sql import SALES_SUMS, sales_by, stock_by
from starlattice.sources.warehouse import Warehouse

AMOUNT = "CAST(SUM(amount) AS DOUBLE) AS sum_amount"
ROW_TOTAL = '"__row_total__"'


def amount_cells(columns: Iterable[str], where: str = "TRUE") -> str:
    columns = list(columns)
    return f"SELECT {', '.join(columns)}, SUM(amount) AS amount FROM sold WHERE {where} GROUP BY {', '.join(columns)}"


def pivot_sql(rows: list[str], columns: list[str], where: str = "TRUE", page: str = "") -> str:
    """Amount cells with the total of their row; `page` keeps some of the row groups."""
    shown = ", ".join([*rows, *columns])
    key = ", ".join(rows)
    kept = f" WHERE ({key}) IN ({page})" if page else ""
    return (
        f"SELECT {shown}, CAST(amount AS DOUBLE) AS sum_amount, "
        f"CAST(SUM(amount) OVER (PARTITION BY {key}) AS DOUBLE) AS {ROW_TOTAL} "
        f"FROM ({amount_cells([*rows, *columns], where)}){kept}"
    )


# --- pivots -----------------------------------------------------------------

YEAR_BY_TYPE = nav.Pivot(rows=("year",), columns=("customer_type",), page=None)
on_star(
    "pivot_year_by_customer_type",
    lambda wh: nav.pivot(wh, YEAR_BY_TYPE),
    pivot_sql(["year"], ["customer_type"]),
)
on_star(
    "pivot_grand_total",
    lambda wh: nav.pivot(wh, nav.Pivot(measures=("sum_amount", "total_quantity"))),
    f"SELECT {SALES_SUMS}, CAST(SUM(amount) AS DOUBLE) AS {ROW_TOTAL} FROM sales",
)
on_star(
    "pivot_columns_only",
    lambda wh: nav.pivot(wh, nav.Pivot(columns=("quarter", "year"), filters={"customer_type": "Tourist"})),
    f"SELECT quarter, year, CAST(amount AS DOUBLE) AS sum_amount, CAST(SUM(amount) OVER () AS DOUBLE) AS {ROW_TOTAL} "
    f"FROM ({amount_cells(['quarter', 'year'], 'customer_type = ' + chr(39) + 'Tourist' + chr(39))})",
)
on_star(
    "pivot_product_by_year",
    lambda wh: nav.pivot(wh, nav.Pivot(rows=("product_key",), columns=("year",), page=None)),
    pivot_sql(["product_key"], ["year"]),
)
on_star(
    "pivot_state_by_customer_type_without_cuboid",
    lambda wh: nav.pivot(wh, nav.Pivot(rows=("state",), columns=("customer_type",), page=None)),
    pivot_sql(["state"], ["customer_type"]),
)

PRODUCT_PAGE = nav.Pivot(
    rows=("product_key",),
    columns=("quarter",),
    filters={"year": 1997, "customer_type": "All"},
    page=3,
    page_size=25,
    sort_column=nav.ROW_TOTAL,
    sort_order="desc",
)
PRODUCT_PAGE_KEYS = (
    "SELECT product_key FROM sold WHERE year = 1997 GROUP BY product_key "
    "ORDER BY SUM(amount) DESC, product_key LIMIT 25 OFFSET 50"
)
on_star(
    "pivot_page_by_row_total",
    lambda wh: nav.pivot(wh, PRODUCT_PAGE),
    pivot_sql(["product_key"], ["quarter"], "year = 1997", PRODUCT_PAGE_KEYS),
)
on_star(
    "pivot_page_counts",
    lambda wh: nav.pivot_page_counts(wh, PRODUCT_PAGE),
    "SELECT COUNT(DISTINCT product_key) AS total_rows, "
    "CAST(GREATEST(1, CEIL(COUNT(DISTINCT product_key) / 25)) AS BIGINT) AS total_pages FROM sold WHERE year = 1997",
)
CITY_PAGE = nav.Pivot(
    rows=("state", "city"), columns=("year",), page=2, page_size=10, sort_column="city", sort_order="desc"
)
on_star(
    "pivot_page_by_row_column",
    lambda wh: nav.pivot(wh, CITY_PAGE),
    pivot_sql(
        ["state", "city"],
        ["year"],
        page="SELECT state, city FROM (SELECT DISTINCT state, city FROM sold) "
        "ORDER BY city DESC, state, city LIMIT 10 OFFSET 10",
    ),
)
on_star(
    "pivot_page_by_rows",
    lambda wh: nav.pivot(wh, nav.Pivot(rows=("state", "city"), columns=("quarter",), page=1, page_size=10)),
    pivot_sql(
        ["state", "city"],
        ["quarter"],
        page="SELECT state, city FROM (SELECT DISTINCT state, city FROM sold) ORDER BY state, city LIMIT 10",
    ),
)

# --- the cube operations ----------------------------------------------------

on_star(
    "slice_by_state",
    lambda wh: nav.answer(wh, "sales", ["year"], {"state": "EUROPE"}),
    sales_by(["year"], "state = 'EUROPE'"),
)
on_star(
    "dice_by_state_and_quarter",
    lambda wh: nav.answer(wh, "sales", ["city"], {"state": "ASIA", "quarter": 2, "customer_key": ""}),
    sales_by(["city"], "state = 'ASIA' AND quarter = 2"),
)
on_star(
    "swap_axes",
    lambda wh: nav.pivot(wh, nav.swap_axes(YEAR_BY_TYPE)),
    pivot_sql(["customer_type"], ["year"]),
)
on_star(
    "drill_down",
    lambda wh: nav.pivot(wh, nav.drill_down(YEAR_BY_TYPE, "quarter")),
    pivot_sql(["year", "quarter"], ["customer_type"]),
)
on_star(
    "roll_up",
    lambda wh: nav.pivot(wh, nav.roll_up(nav.Pivot(rows=("year", "month"), columns=("state",), page=None))),
    pivot_sql(["year"], ["state"]),
)

def melted(table: DataFrame, rows: list[str]) -> DataFrame:
    """A crosstab with one row per cell, so that its columns need not be known beforehand."""
    return table.unpivot([*rows, nav.ROW_TOTAL], None, "column_label", "sum_amount")


def crosstab_sql(rows: list[str], label: str) -> str:
    """Every row with every column group of the data, and the total over all sales of the row."""
    keys = ", ".join(rows)
    same = " AND ".join(f"c.{r} IS NOT DISTINCT FROM t.{r}" for r in rows)
    return (
        f"SELECT {', '.join(f't.{r}' for r in rows)}, CAST(t.amount AS DOUBLE) AS {ROW_TOTAL}, l.label AS column_label, "
        "CAST(COALESCE(c.amount, 0) AS DOUBLE) AS sum_amount "
        f"FROM (SELECT {keys}, SUM(amount) AS amount FROM sold GROUP BY {keys}) t "
        f"CROSS JOIN (SELECT DISTINCT {label} AS label FROM sold) l "
        f"LEFT JOIN (SELECT {keys}, {label} AS label, SUM(amount) AS amount FROM sold GROUP BY {keys}, {label}) c "
        f"ON {same} AND c.label = l.label"
    )


on_star(
    "crosstab_city_by_year",
    lambda wh: melted(nav.crosstab(wh, nav.Pivot(rows=("state", "city"), columns=("year",))), ["state", "city"]),
    crosstab_sql(["state", "city"], "CAST(year AS VARCHAR)"),
)
on_star(
    "crosstab_year_by_quarter_and_type",
    lambda wh: melted(nav.crosstab(wh, nav.Pivot(rows=("year",), columns=("quarter", "customer_type"))), ["year"]),
    crosstab_sql(["year"], "CAST(quarter AS VARCHAR) || ' | ' || customer_type"),
)
LISTED_YEARS = ["1996", "1998"]
on_star(
    "crosstab_listed_years_and_the_rest",
    lambda wh: nav.crosstab(wh, nav.Pivot(rows=("state",), columns=("year",)), LISTED_YEARS),
    "SELECT state, "
    + "".join(f"CAST(COALESCE(SUM(amount) FILTER (year = {y}), 0) AS DOUBLE) AS \"{y}\", " for y in LISTED_YEARS)
    + "CAST(COALESCE(SUM(amount) FILTER (year NOT IN (1996, 1998)), 0) AS DOUBLE) AS other, "
    f"CAST(SUM(amount) AS DOUBLE) AS {ROW_TOTAL} FROM sold GROUP BY state",
)
on_star(
    "top_100_cells",
    lambda wh: nav.top_cells(wh, nav.Pivot(rows=("product_key",), columns=("year", "state"))),
    f"SELECT product_key, year, state, CAST(amount AS DOUBLE) AS sum_amount "
    f"FROM ({amount_cells(['product_key', 'year', 'state'])}) "
    "ORDER BY amount DESC, product_key, year, state LIMIT 100",
)

# --- stock answers ----------------------------------------------------------

on_star(
    "stock_by_city_and_year",
    lambda wh: nav.inventory_query(wh, group_by=["year", "state", "city"]),
    stock_by(["year", "state", "city"]),
)
on_star(
    "stock_by_product_in_first_quarters",
    lambda wh: nav.answer(wh, "inventory", ["product_key"], {"quarter": 1}),
    stock_by(["product_key"], "quarter = 1"),
)
on_star(
    "stock_by_quarter_over_years",
    lambda wh: nav.answer(wh, "inventory", ["quarter", "state"]),
    stock_by(["quarter", "state"]),
)
on_star(
    "stock_columns_of_a_year",
    lambda wh: nav.inventory_query(
        wh, columns=["year", "store_key", "total_quantity_on_hand"], filters={"year": 1999}
    ),
    stock_by(["year", "store_key"], "year = 1999"),
)
on_star(
    "stock_pivot_store_by_year",
    lambda wh: nav.pivot(
        wh,
        nav.Pivot(
            rows=("store_key",), columns=("year",), measures=("total_quantity_on_hand",), cube="inventory", page=None
        ),
    ),
    f"SELECT *, CAST(SUM(total_quantity_on_hand) OVER (PARTITION BY store_key) AS BIGINT) AS {ROW_TOTAL} "
    f"FROM ({stock_by(['store_key', 'year'])})",
)

# --- raw rows and drill-through ---------------------------------------------

BASE_SALES = sales_by(["year", "quarter", "month", "product_key", "customer_key", "state", "city"])
on_star(
    "raw_sales_page",
    lambda wh: nav.raw_rows(wh, "sales", filters={"state": "AFRICA"}, page=2),
    f"SELECT * FROM ({BASE_SALES}) WHERE state = 'AFRICA' "
    "ORDER BY sum_amount DESC, year, quarter, month, product_key, customer_key, state, city LIMIT 100 OFFSET 100",
)
on_star(
    "raw_sales_page_counts",
    lambda wh: nav.raw_row_counts(wh, "sales", {"state": "AFRICA"}),
    f"SELECT COUNT(*) AS total_rows, CAST(CEIL(COUNT(*) / 100) AS BIGINT) AS total_pages "
    f"FROM ({BASE_SALES}) WHERE state = 'AFRICA'",
)
on_star(
    "raw_stock_page",
    lambda wh: nav.raw_rows(
        wh, "inventory", ["year", "month", "product_key", "store_key", "total_quantity_on_hand"], page_size=50
    ),
    "SELECT year, month, product_key, store_key, CAST(on_hand AS BIGINT) AS total_quantity_on_hand FROM kept "
    "ORDER BY on_hand DESC, year, quarter, month, product_key, store_key LIMIT 50",
)
on_star(
    "drill_through_sales_month",
    lambda wh: nav.drill_through(wh, "sales", {"time_key": 199703, "customer_key": "All"}, page=2, page_size=50),
    "SELECT time_key, product_key, customer_key, CAST(quantity AS BIGINT) AS quantity_ordered, "
    "CAST(amount AS DOUBLE) AS total_amount FROM sales WHERE time_key = 199703 "
    "ORDER BY time_key, product_key, customer_key LIMIT 50 OFFSET 50",
)
on_star(
    "drill_through_stock_columns",
    lambda wh: nav.drill_through(
        wh, "inventory", {"time_key": 200005}, ["store_key", "product_key", "quantity_on_hand"]
    ),
    "SELECT store_key, product_key, CAST(on_hand AS BIGINT) AS quantity_on_hand FROM stock WHERE time_key = 200005 "
    "ORDER BY time_key, store_key, product_key LIMIT 100",
)


def drill_across_sql(keys: list[str], where: str | None = None) -> str:
    return (
        f"SELECT {', '.join(keys)}, s.sum_amount AS sales_sum_amount, "
        "i.total_quantity_on_hand AS inventory_total_quantity_on_hand "
        f"FROM ({sales_by(keys, where)}) s FULL JOIN ({stock_by(keys, where)}) i USING ({', '.join(keys)})"
    )


on_star(
    "drill_across_product_month",
    lambda wh: nav.drill_across(wh, ["year", "quarter", "month", "product_key"]),
    drill_across_sql(["year", "quarter", "month", "product_key"]),
)
on_star(
    "drill_across_city_of_a_year",
    lambda wh: nav.drill_across(wh, ["state", "city"], {"year": 2000}),
    drill_across_sql(["state", "city"], "year = 2000"),
)


def _values(cube: str, dimension: str, search: str | None, page: int):
    return lambda wh: nav.dimension_values(wh, cube, dimension, search, page, 20)


on_star(
    "dimension_values_customer",
    _values("sales", "customer_key", "7", 2),
    "SELECT DISTINCT customer_key FROM sold WHERE CAST(customer_key AS VARCHAR) LIKE '%7%' "
    "ORDER BY customer_key LIMIT 20 OFFSET 20",
)
on_star(
    "dimension_values_city",
    _values("inventory", "city", None, 1),
    "SELECT DISTINCT city FROM kept ORDER BY city LIMIT 20",
)
on_star(
    "dimension_value_counts",
    lambda wh: nav.dimension_value_counts(wh, "sales", "product_key", "9", 20),
    "SELECT COUNT(DISTINCT product_key) AS total_rows, CAST(CEIL(COUNT(DISTINCT product_key) / 20) AS BIGINT) AS total_pages "
    "FROM sales WHERE CAST(product_key AS VARCHAR) LIKE '%9%'",
)

# --- reports from the facts -------------------------------------------------

on_star(
    "report_product_revenue",
    lambda wh: adhoc.product_revenue(wh, 199701, 199712),
    "SELECT product_key, CAST(SUM(amount) AS DOUBLE) AS revenue FROM sales "
    "WHERE time_key BETWEEN 199701 AND 199712 GROUP BY product_key",
)
on_star(
    "report_year_by_month",
    lambda wh: adhoc.year_by_month(wh, 1998),
    "SELECT year, quarter, month, CAST(SUM(amount) AS DOUBLE) AS revenue FROM sales JOIN months USING (time_key) "
    "WHERE year = 1998 GROUP BY ALL",
)
on_star(
    "report_state_by_city",
    lambda wh: adhoc.state_by_city(wh, "AMERICA"),
    "SELECT state, city, CAST(SUM(amount) AS DOUBLE) AS revenue FROM sold WHERE state = 'AMERICA' GROUP BY ALL",
)
on_star(
    "report_customers_by_type",
    lambda wh: adhoc.customers_by_type(wh, ["Tourist", "Both"], 1999),
    "SELECT customer_type, year, quarter, COUNT(DISTINCT customer_key) AS num_customers, "
    "CAST(SUM(amount) AS DOUBLE) AS revenue FROM sales JOIN months USING (time_key) JOIN buyer USING (customer_key) "
    "WHERE customer_type IN ('Tourist', 'Both') AND year = 1999 GROUP BY ALL",
)

on_star(
    "raw_sales_deep_page",
    lambda wh: nav.drill_through(wh, "sales", {"time_key": "All"}, page=31, page_size=1000),
    "SELECT time_key, product_key, customer_key, CAST(quantity AS BIGINT) AS quantity_ordered, "
    "CAST(amount AS DOUBLE) AS total_amount FROM sales "
    "ORDER BY time_key, product_key, customer_key LIMIT 1000 OFFSET 30000",
)


# --- pages far from the start, and the page after a row ------------------------

LINE_ORDER = (*sort_keys(["product_key"]), *sort_keys(["total_amount"], descending=True), *sort_keys(["customer_key", "time_key"]))
DEEP_PAGE, DEEP_SIZE = 150, 100
AFTER = (50, 20_000, 0, 0)


def sales_line_page(wh: Warehouse, rows: DataFrame) -> DataFrame:
    return rows.select("product_key", "total_amount", "customer_key", "time_key", "quantity_ordered")


_LINES_SORTED = (
    "SELECT product_key, CAST(amount AS DOUBLE) AS total_amount, customer_key, time_key, CAST(quantity AS BIGINT) AS quantity_ordered "
    "FROM sales {} ORDER BY product_key, amount DESC, customer_key, time_key LIMIT 100{}"
)
on_star(
    "page_deep_of_sales_lines",
    lambda wh: sales_line_page(wh, page_of(wh.table("fact_sales"), LINE_ORDER, DEEP_PAGE, DEEP_SIZE)),
    _LINES_SORTED.format("", f" OFFSET {(DEEP_PAGE - 1) * DEEP_SIZE}"),
)
on_star(
    "page_after_a_sales_line",
    lambda wh: sales_line_page(wh, page_after(wh.table("fact_sales"), LINE_ORDER, AFTER, DEEP_SIZE)),
    _LINES_SORTED.format(
        "WHERE product_key > 50 OR (product_key = 50 AND (amount < 20000 OR (amount = 20000 AND (customer_key > 0 "
        "OR (customer_key = 0 AND time_key > 0)))))",
        "",
    ),
)
