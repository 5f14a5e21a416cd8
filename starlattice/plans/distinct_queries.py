"""Distinct counts from stored bitmaps, checked against COUNT(DISTINCT) over the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starlattice.operators.distinct import count_distinct
from starlattice.plans.registry import on_star
from starlattice.sources.warehouse import Warehouse

on_star(
    "distinct_customers_by_type_and_quarter",
    lambda wh: count_distinct(wh, "customer", ["customer_type", "year", "quarter"]),
    "SELECT customer_type, year, quarter, COUNT(DISTINCT customer_key) AS distinct_customers "
    "FROM sales JOIN months USING (time_key) JOIN buyer USING (customer_key) GROUP BY 1, 2, 3",
)
on_star(
    "distinct_customers_by_state_and_year",
    lambda wh: count_distinct(wh, "customer", ["state", "year"]),
    "SELECT state, year, COUNT(DISTINCT customer_key) AS distinct_customers FROM sold GROUP BY 1, 2",
)
on_star(
    "distinct_customers_of_all_time_by_type",
    lambda wh: count_distinct(wh, "customer", ["customer_type"], name="customers"),
    "SELECT customer_type, COUNT(DISTINCT customer_key) AS customers FROM sales JOIN buyer USING (customer_key) GROUP BY 1",
)


def stores_and_products(wh: Warehouse) -> DataFrame:
    """Stores and products with stock of one state in one year, as the filtered overview counts them."""
    filters = {"year": 1997, "state": "EUROPE"}
    stores = count_distinct(wh, "store", filters=filters, name="total_stores")
    products = count_distinct(wh, "product", filters=filters, name="total_products")
    return stores.select("total_stores", products.scalar().alias("total_products"))


on_star(
    "distinct_stores_and_products_of_filtered_overview",
    stores_and_products,
    "SELECT COUNT(DISTINCT store_key) AS total_stores, COUNT(DISTINCT product_key) AS total_products "
    "FROM kept WHERE year = 1997 AND state = 'EUROPE'",
)
on_star(
    "distinct_products_by_city_and_quarter",
    lambda wh: count_distinct(wh, "product", ["state", "city", "year", "quarter"]),
    "SELECT state, city, year, quarter, COUNT(DISTINCT product_key) AS distinct_products FROM kept GROUP BY 1, 2, 3, 4",
)
