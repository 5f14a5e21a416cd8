"""Sales dashboard: totals, trend, rankings, segments, customer drill-through."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from starlattice.functions.paging import page_counts, page_of, sort_columns, sort_keys
from starlattice.functions.periods import ALL_TIME_COLUMNS, period_label
from starlattice.functions.predicates import active_filters, equals_all
from starlattice.operators.cuboids import with_time
from starlattice.operators.navigate import answer
from starlattice.schemas import AMOUNT_TOTAL, QUANTITY_TOTAL
from starlattice.sources.warehouse import Warehouse

Filters = Mapping[str, Any] | None

# A ranking of up to this many customers is broadcast to their names: a key and two sums each.
BROADCAST_CUSTOMERS = 100_000


def ratio(top: Column, bottom: Column, decimals: int | None = None) -> Column:
    """A quotient, 0 where there is nothing to divide by; unrounded unless asked."""
    quotient = top.cast("double") / F.when(bottom > 0, bottom.cast("double"))
    quotient = F.coalesce(quotient, F.lit(0.0))
    return quotient if decimals is None else F.round(quotient, decimals)


def overview(wh: Warehouse, filters: Filters = None, decimals: int | None = 2) -> DataFrame:
    """Revenue, quantity and average selling price."""
    totals = answer(wh, "sales", (), filters).select(
        F.coalesce("sum_amount", F.lit(0)).cast(AMOUNT_TOTAL).alias("total_revenue"),
        F.coalesce("total_quantity", F.lit(0)).cast(QUANTITY_TOTAL).alias("total_quantity"),
    )
    price = ratio(F.col("total_revenue"), F.col("total_quantity"), decimals)
    return totals.withColumn("average_price", price)


def trend_columns(level: str, filters: Filters) -> tuple[str, ...]:
    """Time columns of a trend; parents that no filter fixes are added."""
    active = active_filters(filters)
    if level == "year":
        return ("year",)
    if level == "quarter":
        return ("quarter",) if "year" in active else ("year", "quarter")
    if level == "month":
        if "quarter" in active:
            return ("month",)
        return ("quarter", "month") if "year" in active else ("year", "quarter", "month")
    raise ValueError(f"unknown trend level: {level}")


def trend_label(columns: tuple[str, ...]) -> Column:
    text = {c: F.col(c).cast("string") for c in columns}
    if columns == ("year",):
        return text["year"]
    if columns == ("quarter",):
        return F.concat(F.lit("Q"), text["quarter"])
    if columns == ("year", "quarter"):
        return F.concat(text["year"], F.lit("-Q"), text["quarter"])
    if columns == ("month",):
        return F.concat(F.lit("M"), text["month"])
    return F.concat(F.lit("Q"), text["quarter"], F.lit("-M"), text["month"])


def trend(wh: Warehouse, level: str, filters: Filters = None) -> DataFrame:
    """Revenue and quantity per period, in time order, with a display label."""
    columns = trend_columns(level, filters)
    return (
        answer(wh, "sales", columns, filters)
        .select(
            *columns,
            trend_label(columns).alias("label"),
            F.col("sum_amount").alias("value"),
            F.col("total_quantity").alias("quantity"),
        )
        .orderBy(*columns)
    )


def _nothing(df: DataFrame) -> DataFrame:
    return df.where(F.lit(False))


def product_name(key: str = "product_key") -> Column:
    return F.concat(F.lit("Product "), F.col(key).cast("string"))


def ranked_products(wh: Warehouse, filters: Filters = None, *, best: bool = True, n: int = 5) -> DataFrame:
    """The n products with the most (or least) revenue; none when one product is selected."""
    active = active_filters(filters)
    chosen = active.pop("product_key", None)
    ranked = answer(wh, "sales", ["product_key"], active).select(
        "product_key", product_name().alias("product_name"), "sum_amount", "total_quantity"
    )
    if chosen is not None:
        ranked = _nothing(ranked)
    return ranked.orderBy(*sort_columns(["sum_amount"], descending=best), "product_key").limit(n)


def customer_segments(wh: Warehouse, filters: Filters = None, decimals: int | None = 2) -> DataFrame:
    """Revenue and percent share per customer type; none when the filter already fixes customers."""
    active = active_filters(filters)
    fixed = {"customer_type", "customer_key", "state", "city"} & set(active)
    for name in fixed:
        del active[name]
    segments = answer(wh, "sales", ["customer_type"], active, ["sum_amount"])
    # At most four customer types reach this window.
    everything = F.sum("sum_amount").over(Window.partitionBy())
    share = F.when(everything > 0, F.col("sum_amount").cast("double") / everything.cast("double") * 100)
    share = F.coalesce(share, F.lit(0.0))
    result = segments.select(
        "customer_type",
        "sum_amount",
        (share if decimals is None else F.round(share, decimals)).alias("percentage"),
    )
    result = _nothing(result) if fixed else result
    return result.orderBy(F.col("sum_amount").desc(), "customer_type")


def top_customers(wh: Warehouse, filters: Filters = None, n: int = 5) -> DataFrame:
    """The n customers with the most revenue, with their names; a product filter is ignored.

    Order count and average order value are placeholders, 0 and the total.
    """
    active = active_filters(filters)
    active.pop("product_key", None)
    wanted_type = active.pop("customer_type", None)
    per_customer = answer(wh, "sales", ["customer_key"], active)
    people = wh.table("dim_customer").select("customer_key", "customer_name", "customer_type")
    order = [F.col("sum_amount").desc(), F.col("customer_key")]
    if wanted_type is None:
        # The cuboid holds known customers only, so the ranking can go first and n rows are joined.
        first = per_customer.orderBy(*order).limit(n)
        ranked = (F.broadcast(first) if n <= BROADCAST_CUSTOMERS else first).join(people, "customer_key")
    else:
        ranked = per_customer.join(people.where(F.col("customer_type") == wanted_type), "customer_key")
    return (
        ranked.select(
            "customer_key",
            "customer_name",
            "customer_type",
            "sum_amount",
            "total_quantity",
            F.lit(0).alias("order_count"),
            F.col("sum_amount").alias("avg_order_value"),
        )
        .orderBy(*order)
        .limit(n)
    )


# --- customer drill-through -------------------------------------------------


def _placed_customers(wh: Warehouse) -> DataFrame:
    """Customers with their place; a customer without a known location keeps NULLs."""
    places = wh.table("dim_location").select("location_key", "city", "state")
    if wh.is_small("dim_location"):
        places = F.broadcast(places)
    return wh.table("dim_customer").join(places, "location_key", "left")


def customer_cards(wh: Warehouse, customer_key: int | None = None) -> DataFrame:
    """Name, type, first order and place of one customer, or of all."""
    cards = _placed_customers(wh).where(equals_all({"customer_key": customer_key}))
    return cards.select(
        "customer_key",
        "customer_name",
        "customer_type",
        F.col("first_order_date").cast("string").alias("first_order_date"),
        "city",
        "state",
        F.concat("city", F.lit(", "), "state").alias("location"),
    )


def customer_lines(wh: Warehouse, filters: Filters) -> DataFrame:
    """Fact rows of the selected customers with their calendar columns."""
    active = active_filters(filters)
    about_customer = {k: v for k, v in active.items() if k in ("customer_key", "customer_type", "state", "city")}
    about_time = {k: v for k, v in active.items() if k in ALL_TIME_COLUMNS}
    needs_place = {"state", "city"} & set(about_customer)
    customers = _placed_customers(wh) if needs_place else wh.table("dim_customer")
    customers = customers.where(equals_all(about_customer)).select("customer_key")
    sales = wh.table("fact_sales").where(equals_all({"customer_key": active.get("customer_key")}))
    if wh.is_small("dim_customer"):
        customers = F.broadcast(customers)
    return (
        with_time(sales, wh, ALL_TIME_COLUMNS)
        .where(equals_all(about_time))
        .join(customers, "customer_key", "left_semi")
    )


def customer_summary(wh: Warehouse, filters: Filters = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Revenue, quantity, row count, mean amount and last period of the selected rows."""
    summary = (
        customer_lines(wh, filters)
        .groupBy(*by)
        .agg(
            F.sum("total_amount").cast(AMOUNT_TOTAL).alias("revenue"),
            F.sum("quantity_ordered").cast(QUANTITY_TOTAL).alias("quantity"),
            F.count(F.lit(1)).alias("order_count"),
            F.max(period_label()).alias("last_order_date"),
        )
    )
    return summary.select(
        *by,
        F.coalesce("revenue", F.lit(0)).cast(AMOUNT_TOTAL).alias("total_revenue"),
        F.coalesce("quantity", F.lit(0)).cast(QUANTITY_TOTAL).alias("total_quantity"),
        "order_count",
        ratio(F.col("revenue"), F.col("order_count")).alias("avg_amount_per_order"),
        F.coalesce("last_order_date", F.lit("N/A")).alias("last_order_date"),
    )


def customer_transactions(
    wh: Warehouse, filters: Filters = None, page: int = 1, page_size: int = 5
) -> DataFrame:
    """A page of sales lines, newest period first, then by product name.

    The page is cut before names are shown but after the join to products,
    because the names take part in the order.
    """
    products = wh.table("dim_product").select("product_key", F.col("description").alias("product_name"))
    if wh.is_small("dim_product"):
        products = F.broadcast(products)
    lines = customer_lines(wh, filters).join(products, "product_key")
    order = [("time_key", True), *sort_keys(["product_name", "product_key", "customer_key"])]
    return page_of(lines, order, page, page_size).select(
        period_label().alias("period"),
        "product_key",
        "customer_key",
        "product_name",
        F.col("quantity_ordered").cast(T.LongType()).alias("quantity_ordered"),
        "total_amount",
    )


def customer_transaction_counts(wh: Warehouse, filters: Filters = None, page_size: int = 5) -> DataFrame:
    return page_counts(customer_lines(wh, filters), page_size)
