"""Value lists and searches for filter panels.

A cuboid holds each value of its own columns once, so most lists need no
`distinct`. A search with `by_grams` reads the stored grams of the keys; a text of fewer
than three characters between wildcards has none and scans the cuboid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.functions.paging import page_counts, page_of, sort_keys
from starlattice.functions.predicates import all_of, equals_all, is_active, key_contains, key_contains_nocase
from starlattice.operators import grams
from starlattice.operators.sales import product_name
from starlattice.sources.warehouse import Warehouse


def years(wh: Warehouse) -> DataFrame:
    """Years with sales, newest first."""
    return wh.cuboid("olap_sales_by_time").select("year").distinct().orderBy(F.col("year").desc())


def states(wh: Warehouse) -> DataFrame:
    places = wh.cuboid("olap_sales_by_city")
    return places.select("state").where(F.col("state").isNotNull()).distinct().orderBy("state")


def cities(wh: Warehouse, state: str | None = None) -> DataFrame:
    """Cities of one state, or of every state, sorted."""
    known = F.col("state").isNotNull() & F.col("city").isNotNull()
    places = wh.cuboid("olap_sales_by_city").where(known & equals_all({"state": state}))
    return places.select("state", "city").orderBy("state", "city")


def customer_types(wh: Warehouse) -> DataFrame:
    types = wh.cuboid("olap_sales_by_customer_type").select("customer_type")
    return types.where(F.col("customer_type").isNotNull()).orderBy("customer_type")


def cascading_periods(wh: Warehouse, year: int | None = None, quarter: int | None = None) -> DataFrame:
    """One row: the quarters (at most 4) and months (at most 12) that have sales under the choice."""
    chosen = wh.cuboid("olap_sales_by_time").where(equals_all({"year": year, "quarter": quarter}))
    return chosen.agg(
        F.sort_array(F.collect_set("quarter")).alias("quarters"),
        F.sort_array(F.collect_set("month")).alias("months"),
    )


def _searched(wh: Warehouse, searched: str, text: str, by_grams: bool) -> DataFrame:
    """The rows that a search looks at: those of a gram of the text, or where it has none all keys of the cuboid."""
    near = grams.keys_near(wh, searched, text) if by_grams else None
    return wh.cuboid(grams.CUBOIDS[searched]) if near is None else near


def search_products(wh: Warehouse, query: str, limit: int = 10, *, by_grams: bool = False) -> DataFrame:
    """Products whose key contains the text."""
    found = _searched(wh, "product", query, by_grams).where(key_contains("product_key", query))
    return _named_products(found).orderBy("product_key").limit(limit)


def _named_products(rows: DataFrame) -> DataFrame:
    return rows.select("product_key", product_name().alias("product_name"))


def _search_limit(limit: int) -> int:
    if limit < 1:
        raise ValueError("limit starts at 1")
    return limit


def search_customers(
    wh: Warehouse,
    q: str = "",
    state: str | None = None,
    city: str | None = None,
    customer_type: str | None = None,
    limit: int = 20,
    *,
    by_grams: bool = False,
) -> DataFrame:
    """Customers with sales by key text, place and type."""
    conditions = [F.col("customer_key").isNotNull(), equals_all({"state": state, "city": city})]
    if q.strip():
        conditions.append(key_contains_nocase("customer_key", q.strip()))
    found = _searched(wh, "customer", q, by_grams).where(all_of(conditions))
    if is_active(customer_type) and "customer_type" in found.columns:
        found = found.where(F.col("customer_type") == customer_type)
    elif is_active(customer_type):
        typed = wh.table("dim_customer").where(F.col("customer_type") == customer_type)
        found = found.join(typed.select("customer_key"), "customer_key", "left_semi")
    return found.select("customer_key").orderBy("customer_key").limit(_search_limit(limit))


def search_stores(
    wh: Warehouse,
    q: str = "",
    state: str | None = None,
    city: str | None = None,
    limit: int = 20,
    *,
    by_grams: bool = False,
) -> DataFrame:
    """Stores with stock by key text and place."""
    conditions = [F.col("store_key").isNotNull(), equals_all({"state": state, "city": city})]
    if q.strip():
        conditions.append(key_contains_nocase("store_key", q.strip()))
    found = _searched(wh, "store", q, by_grams).where(all_of(conditions))
    return found.select("store_key").orderBy("store_key").limit(_search_limit(limit))


def products(wh: Warehouse, page: int = 1, page_size: int = 100) -> DataFrame:
    """A page of products with sales."""
    rows = _named_products(wh.cuboid("olap_sales_by_product"))
    return page_of(rows, sort_keys(["product_key"]), page, page_size)


def product_page_counts(wh: Warehouse, page_size: int = 100) -> DataFrame:
    return page_counts(_named_products(wh.cuboid("olap_sales_by_product")), page_size)
