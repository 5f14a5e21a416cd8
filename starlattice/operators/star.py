"""Dimension and fact builders over the conformed tables."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.functions.periods import time_key
from starlattice.functions.predicates import changed_since
from starlattice.operators.conform import NEVER_LOADED
from starlattice.schemas import AMOUNT


def calendar_months(keys: DataFrame) -> DataFrame:
    """One dim_time row per YYYYMM key; a calendar has few months whatever the data size."""
    month = F.col("time_key") % 100
    return keys.select("time_key").distinct().select(
        F.col("time_key").cast("int"),
        month.cast("int").alias("month"),
        F.ceil(month / 3).cast("int").alias("quarter"),
        F.floor(F.col("time_key") / 100).cast("int").alias("year"),
    )


def dim_time(orders: DataFrame, as_of: date, since: date | str = NEVER_LOADED) -> DataFrame:
    """Months that have orders, and always the month of `as_of`."""
    months = orders.where(changed_since("order_date", since, inclusive=False)).select(
        time_key(F.col("order_date")).alias("time_key")
    )
    current = orders.sparkSession.range(1).select(F.lit(as_of.year * 100 + as_of.month).alias("time_key"))
    return calendar_months(months.distinct().union(current))


def dim_location(offices: DataFrame, since: date | str = NEVER_LOADED) -> DataFrame:
    return offices.where(changed_since("last_updated_time", since, inclusive=False)).select(
        F.col("city_id").alias("location_key"), F.col("city_name").alias("city"), "state", "office_address"
    )


def dim_product(products: DataFrame, since: date | str = NEVER_LOADED) -> DataFrame:
    return products.where(changed_since("last_updated_time", since, inclusive=False)).select(
        F.col("product_id").alias("product_key"), "description", "size", "weight"
    )


def dim_store(stores: DataFrame, offices: DataFrame, since: date | str = NEVER_LOADED) -> DataFrame:
    """Stores whose city has an office."""
    return (
        stores.where(changed_since("last_updated_time", since, inclusive=False))
        .join(offices.select("city_id"), "city_id", "left_semi")
        .select(F.col("store_id").alias("store_key"), "phone_number", F.col("city_id").alias("location_key"))
    )


def customer_type(is_tourist: Column, is_mail_order: Column) -> Column:
    return (
        F.when(is_tourist & is_mail_order, "Both")
        .when(is_tourist, "Tourist")
        .when(is_mail_order, "MailOrder")
        .otherwise("Unknown")
    )


def dim_customer(
    customers: DataFrame, tourists: DataFrame, mail_orders: DataFrame, since: date | str = NEVER_LOADED
) -> DataFrame:
    """Customers typed by membership of the two subtype tables.

    A customer counts as changed when its own row or either subtype row is
    newer than `since`, so a subtype that arrives late still sets the type.
    """
    tourist = tourists.select("customer_id", F.col("last_updated_time").alias("tourist_since"))
    mail = mail_orders.select("customer_id", F.col("last_updated_time").alias("mail_since"))
    return (
        customers.join(tourist, "customer_id", "left")
        .join(mail, "customer_id", "left")
        .where(
            changed_since("first_order_date", since, inclusive=False)
            | changed_since("tourist_since", since, inclusive=False)
            | changed_since("mail_since", since, inclusive=False)
        )
        .select(
            F.col("customer_id").alias("customer_key"),
            "customer_name",
            customer_type(F.col("tourist_since").isNotNull(), F.col("mail_since").isNotNull()).alias("customer_type"),
            "first_order_date",
            F.col("city_id").alias("location_key"),
        )
    )


def line_amount(lines: DataFrame) -> Column:
    """The amount of an order line: stored, or quantity times unit price."""
    if "line_amount" in lines.columns:
        return F.col("line_amount")
    return F.col("ordered_quantity") * F.col("ordered_price")


# Rows of one month that one task sums, sorts and writes; a month of more goes to several.
SLOT_ROWS = 1_000_000
SLOT = "slot"


def month_sizes(days: DataFrame, day: str, times: float = 1.0) -> dict[int | None, int]:
    """About how many rows each month has; a calendar has few months whatever the data size."""
    months = days.groupBy(time_key(F.col(day)).alias("time_key")).count()
    return {r["time_key"]: math.ceil(r["count"] * times) for r in months.collect()}


def slots_of(sizes: Mapping[int | None, int], parallelism: int) -> dict[int | None, tuple[int, int]]:
    """First slot and number of slots of each month: small months share one, large ones have several."""
    rows = min(SLOT_ROWS, max(SLOT_ROWS // 20, sum(sizes.values()) // max(parallelism, 1)))
    found: dict[int | None, tuple[int, int]] = {}
    last, filled = 0, 0
    for month in sorted(sizes, key=lambda m: (m is None, m)):
        width = max(1, math.ceil(sizes[month] / rows))
        if filled and (width > 1 or filled + sizes[month] > rows):
            last, filled = last + 1, 0
        found[month] = (last, width)
        if width > 1:
            last += width
        else:
            filled += sizes[month]
    return found


def dealt(rows: DataFrame, keys: Iterable[str], sizes: Mapping[int | None, int]) -> DataFrame:
    """Rows shuffled to the slot of their month and keys, in the column `slot`.

    An aggregation by slot, month and keys, and a write by month, need no further
    shuffle, and neither a large month nor a large table makes a task larger.
    """
    slots = slots_of(sizes, rows.sparkSession.sparkContext.defaultParallelism)
    count = max((first + width for first, width in slots.values()), default=1)

    def of_month(place: int, otherwise: int) -> Column:
        numbers = [F.lit(n) for month, pair in slots.items() if month is not None for n in (month, pair[place])]
        known = F.try_element_at(F.create_map(*numbers), F.col("time_key")) if numbers else F.lit(None)
        return F.coalesce(known, F.lit(slots.get(None, (0, otherwise))[place]))

    slot = of_month(0, 1) + F.pmod(F.hash(*keys), of_month(1, 1))
    return rows.withColumn(SLOT, slot.cast("int")).repartitionById(count, SLOT)


def fact_sales(
    lines: DataFrame,
    orders: DataFrame,
    since: date | str = NEVER_LOADED,
    sizes: Mapping[int | None, int] | None = None,
) -> DataFrame:
    """Monthly sales per product and customer.

    Lines shuffle once on the order and once, after partial sums, on the
    month, product and customer. An order with very many lines is split by
    adaptive skew-join handling, since nothing above the join needs its
    partitioning. With the `sizes` of the months, for a table that is written by
    month, the second shuffle is the one of the write, and rows are summed behind it.
    """
    sold = lines.where(changed_since("last_updated_time", since, inclusive=False)).select(
        "order_id", "product_id", "ordered_quantity", line_amount(lines).alias("amount")
    )
    placed = orders.select("order_id", "customer_id", time_key(F.col("order_date")).alias("time_key"))
    placed_lines = sold.join(placed, "order_id").select(
        "time_key",
        F.col("product_id").alias("product_key"),
        F.col("customer_id").alias("customer_key"),
        "ordered_quantity",
        "amount",
    )
    keys = ["product_key", "customer_key"]
    rows = placed_lines if sizes is None else dealt(placed_lines, keys, sizes)
    summed = rows.groupBy(*([] if sizes is None else [SLOT]), "time_key", *keys).agg(
        F.sum("ordered_quantity").alias("quantity_ordered"),
        F.sum("amount").cast(AMOUNT).alias("total_amount"),
    )
    return summed.drop(SLOT)


def sold_months(lines: DataFrame, orders: DataFrame, since: date | str = NEVER_LOADED) -> DataFrame:
    """The months of `fact_sales`, without making it.

    The first and last order of each month are looked for among the lines; only for
    months where neither has any are all orders joined.
    """
    sold = lines.where(changed_since("last_updated_time", since, inclusive=False)).select("order_id")
    placed = orders.select("order_id", time_key(F.col("order_date")).alias("time_key"))
    ends = placed.groupBy("time_key").agg(F.array(F.min("order_id"), F.max("order_id")).alias("ends"))
    tried = ends.select("time_key", F.explode("ends").alias("order_id")).where(F.col("order_id").isNotNull())
    every = {r["time_key"] for r in ends.select("time_key").collect()}
    seen = {r["time_key"] for r in sold.join(F.broadcast(tried), "order_id").select("time_key").distinct().collect()}
    if every > seen:
        left = placed.where(~F.coalesce(F.col("time_key").isin(sorted(seen - {None})), F.lit(False)))
        seen |= {r["time_key"] for r in left.join(sold, "order_id", "left_semi").select("time_key").distinct().collect()}
    return lines.sparkSession.createDataFrame([(m,) for m in seen], "time_key int")


def fact_inventory(stock: DataFrame) -> DataFrame:
    """Every stock row, stamped with the month of the newest stock change."""
    newest = stock.agg(time_key(F.max("last_updated_time"))).scalar()
    return stock.select(
        newest.alias("time_key"),
        F.col("store_id").alias("store_key"),
        F.col("product_id").alias("product_key"),
        F.col("stock_quantity").alias("quantity_on_hand"),
    )


def fact_inventory_by_month(movements: DataFrame, sizes: Mapping[int | None, int] | None = None) -> DataFrame:
    """One snapshot per month, store and product from dated stock rows; `sizes` as in `fact_sales`."""
    dated = movements.select(
        time_key(F.col("last_updated_time")).alias("time_key"),
        F.col("store_id").alias("store_key"),
        F.col("product_id").alias("product_key"),
        "stock_quantity",
    )
    keys = ["store_key", "product_key"]
    rows = dated if sizes is None else dealt(dated, keys, sizes)
    summed = rows.groupBy(*([] if sizes is None else [SLOT]), "time_key", *keys).agg(
        F.sum("stock_quantity").alias("quantity_on_hand")
    )
    return summed.drop(SLOT)
