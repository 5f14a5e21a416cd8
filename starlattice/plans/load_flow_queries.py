"""Loads through all layers in two batches, with rows that come late, against one load of everything."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlattice.operators import star
from starlattice.plans import arrivals, loads
from starlattice.plans.load_queries import EXTRACT_SQL, LINES_SQL
from starlattice.plans.registry import on_star, on_tables
from starlattice.sources import given_tables
from starlattice.sources.warehouse import AS_OF, conformed, shared_folder

AT = datetime(2002, 1, 1)

# What reaches the sources before the first load. A third of the orders' lines comes later, dated like the
# others; a quarter of the orders later than their lines; half of the offices later than their stores.
FIRST_BATCH: Mapping[str, Callable[[], Column]] = {
    "order_product": lambda: F.col("order_id") % 3 != 0,
    "order": lambda: F.col("order_id") % 4 != 0,
    "representative_office": lambda: F.col("city_id") % 2 == 0,
    "tourist_customer": lambda: F.col("customer_id") % 2 == 0,
    "stocked_product": lambda: F.col("time") < F.lit("2000-01-01").cast("date"),
}


def new_store(spark: SparkSession, keys_a_range: int = loads.KEYS_A_RANGE) -> loads.LoadStore:
    shared = shared_folder(spark)
    if shared is None:
        raise ValueError("loads need the shared folder that spark.checkpoint.dir names")
    return loads.LoadStore(spark, f"{shared}/starlattice/loads/{uuid.uuid4().hex[:12]}", keys_a_range)


def loaded_twice(
    spark: SparkSession, folder: str, sources: tuple[str, ...], table: str, *, rebuild: bool = False
) -> DataFrame:
    """The star table after both loads, in a new store of the shared folder."""
    store = new_store(spark)
    whole = {t: given_tables.SOURCES[t](spark, folder) for t in sources}
    first = {t: rows.where(FIRST_BATCH[t]()) if t in FIRST_BATCH else rows for t, rows in whole.items()}
    loads.load_sources(store, first, AT, sources)
    loads.load_star(store, AS_OF, AT, [table])
    loads.load_sources(store, whole, AT, sources, everything=True)
    loads.load_star(store, AS_OF, AT, [table], rebuild=rebuild)
    return store.table("star", table)


def _flow(name: str, sources: tuple[str, ...], table: str, check: str, *, rebuild: bool = False) -> None:
    on_tables(name, lambda spark, folder: loaded_twice(spark, folder, sources, table, rebuild=rebuild), check)


_SALES_SQL = (
    "SELECT CAST(YEAR(o_orderdate) * 100 + MONTH(o_orderdate) AS INTEGER) AS time_key, product_id AS product_key, "
    "o_custkey AS customer_key, CAST(SUM(ordered_quantity) AS BIGINT) AS quantity_ordered, "
    "CAST(SUM(CAST(line_amount AS DECIMAL(15,2))) AS DOUBLE) AS total_amount "
    f"FROM (SELECT * FROM ({LINES_SQL}) QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, product_id "
    "ORDER BY last_updated_time, ordered_quantity, line_amount) = 1) JOIN orders ON o_orderkey = order_id GROUP BY 1, 2, 3"
)
_flow("load_two_batches_fact_sales", ("order", "order_product"), "fact_sales", _SALES_SQL)
_flow("load_rebuild_fact_sales", ("order", "order_product"), "fact_sales", _SALES_SQL, rebuild=True)


def _stamped(where: str) -> str:
    stock = (
        "SELECT l_suppkey, l_partkey, SUM(CAST(l_quantity AS INTEGER)) AS held, MAX(CAST(l_shipdate AS DATE)) AS changed "
        f"FROM lineitem GROUP BY 1, 2 HAVING MAX(CAST(l_shipdate AS DATE)) {where}"
    )
    return (
        "SELECT CAST(MAX(YEAR(changed) * 100 + MONTH(changed)) OVER () AS INTEGER) AS time_key, l_suppkey AS store_key, "
        f"l_partkey AS product_key, CAST(held AS INTEGER) AS quantity_on_hand FROM ({stock})"
    )


# The first snapshot stays under its month; the second, of everything, comes under a later one.
_flow(
    "load_two_batches_fact_inventory",
    ("stocked_product",),
    "fact_inventory",
    f"SELECT * FROM ({_stamped('< DATE ' + repr('2000-01-01'))}) UNION ALL SELECT * FROM ({_stamped('IS NOT NULL')})",
)
on_star(
    "load_two_batches_dim_store",
    lambda wh: loaded_twice(wh.spark, wh.folder, ("representative_office", "store"), "dim_store"),
    "SELECT store_key, phone_number, location_key FROM store",
)
on_star(
    "load_two_batches_dim_customer",
    lambda wh: loaded_twice(
        wh.spark, wh.folder, ("customer", "tourist_customer", "mail_order_customer"), "dim_customer"
    ),
    "SELECT customer_key, customer_name, customer_type, first_order_date, location_key FROM buyer "
    "WHERE first_order_date IS NOT NULL",
)

# --- loads by key range -------------------------------------------------------

# Numbers of orders and products that share a partition in these loads.
KEYS_A_RANGE = 1 << 13


def third_batch_order_product(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines in three loads: by date, the rest again with all, and a third that meets only the last ranges."""
    store = new_store(spark, KEYS_A_RANGE)
    lines = given_tables.SOURCES["order_product"](spark, folder)
    top = lines.agg(F.max("order_id")).first()[0] or 0
    third = F.col("order_id") > top - KEYS_A_RANGE
    batches = [lines.where(~third & (F.col("order_id") % 3 != 0)), lines.where(~third), lines.where(third | (F.col("order_id") % 97 == 0))]
    for batch in batches:
        loads.load_sources(store, {"order_product": batch}, AT, ["order_product"], everything=True)
    return store.table("conformed", "order_product")


on_tables(
    "load_third_batch_order_product",
    third_batch_order_product,
    f"SELECT * FROM ({LINES_SQL}) QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, product_id "
    "ORDER BY last_updated_time, ordered_quantity, line_amount) = 1",
)


def three_batches_pending_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines reach the star before their orders; the orders come in three loads, the last of them never whole."""
    store = new_store(spark, KEYS_A_RANGE)
    lines, orders = (given_tables.SOURCES[t](spark, folder) for t in ("order_product", "order"))
    for known in (F.col("order_id") % 4 == 0, F.col("order_id") % 4 < 2, F.col("order_id") % 4 < 3):
        loads.load_sources(
            store, {"order": orders.where(known), "order_product": lines}, AT, ("order", "order_product"), everything=True
        )
        loads.load_star(store, AS_OF, AT, ["fact_sales"])
    waiting = store.stored("star", "fact_sales", "star/fact_sales-pending")
    sold = store.table("star", "fact_sales").groupBy("time_key").agg(
        F.sum("quantity_ordered").cast("bigint").alias("quantity"), F.sum("total_amount").alias("amount"), F.lit(0).cast("bigint").alias("waiting")
    )
    left = waiting.groupBy((F.year("last_updated_time") * 100 + F.month("last_updated_time")).alias("time_key")).agg(
        F.sum("ordered_quantity").cast("bigint").alias("quantity"), F.sum("line_amount").alias("amount"), F.count(F.lit(1)).alias("waiting")
    )
    return sold.unionByName(left)


_FIRST_LINES = (
    f"SELECT * FROM ({LINES_SQL}) QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, product_id "
    "ORDER BY last_updated_time, ordered_quantity, line_amount) = 1"
)
_MONTHLY = (
    "SELECT CAST(YEAR({day}) * 100 + MONTH({day}) AS INTEGER) AS time_key, CAST(SUM(ordered_quantity) AS BIGINT) AS quantity, "
    "CAST(SUM(CAST(line_amount AS DECIMAL(15,2))) AS DOUBLE) AS amount, {waiting} AS waiting FROM lines "
)
on_tables(
    "load_three_batches_pending_lines",
    three_batches_pending_lines,
    f"WITH lines AS ({_FIRST_LINES}) "
    + _MONTHLY.format(day="o_orderdate", waiting="CAST(0 AS BIGINT)")
    + "JOIN orders ON o_orderkey = order_id WHERE order_id % 4 < 3 GROUP BY 1 UNION ALL "
    + _MONTHLY.format(day="last_updated_time", waiting="COUNT(*)")
    + "WHERE order_id % 4 = 3 GROUP BY 1",
)


def two_batches_dim_product(spark: SparkSession, folder: str) -> DataFrame:
    """Products in two loads and new prices in a third that meets a tenth of the key ranges, with their star rows."""
    store = new_store(spark, 100)
    products = given_tables.SOURCES["product"](spark, folder)
    repriced = products.where(F.expr("product_id div 100") % 10 == 0).withColumns(
        {"price": F.col("price") + 1, "description": F.lit("not taken"), "time": F.lit(date(2002, 1, 1))}
    )
    for batch in (products.where(F.col("product_id") % 7 != 0), products.where(F.col("product_id") % 7 == 0), repriced):
        loads.load_sources(store, {"product": batch}, AT, ["product"], everything=True)
        loads.load_star(store, AS_OF, AT, ["dim_product"])
    prices = store.table("conformed", "product").select(F.col("product_id").alias("product_key"), "price", "last_updated_time")
    return store.table("star", "dim_product").join(prices, "product_key", "full")


on_tables(
    "load_two_batches_dim_product",
    two_batches_dim_product,
    "SELECT p_partkey AS product_key, TRIM(p_name) AS description, UPPER(p_type) AS size, CAST(p_size AS DOUBLE) AS weight, "
    "CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_partkey // 100 % 10 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS price, "
    "CASE WHEN p_partkey // 100 % 10 = 0 THEN DATE '2002-01-01' ELSE DATE '1995-01-01' END AS last_updated_time FROM part",
)

# --- files that arrive --------------------------------------------------------


def arriving_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose files come in two drops, the second with old dates and rows that came before."""
    store = new_store(spark, KEYS_A_RANGE)
    orders = given_tables.SOURCES["order"](spark, folder)
    landing, schema = f"{store.root}/landing/order", ", ".join(f"`{c}` {kind}" for c, kind in orders.dtypes)
    late = F.col("order_id") % 3 == 0
    for drop in (orders.where(~late), orders.where(late | (F.col("order_id") % 97 == 0))):
        drop.write.mode("append").parquet(landing)
        arrivals.load_arriving(store, "order", landing, AT, kind="parquet", schema=schema)
    return store.table("conformed", "order")


on_tables("load_arriving_files_order", arriving_orders, EXTRACT_SQL["order"])

# --- facts from unit prices and from a mark ----------------------------------


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the unit price of their product instead of an amount."""
    prices = conformed(spark, folder, "product").select("product_id", F.col("price").alias("ordered_price"))
    return conformed(spark, folder, "order_product").drop("line_amount").join(prices, "product_id")


on_tables(
    "fact_sales_from_unit_price",
    lambda spark, folder: star.fact_sales(priced_lines(spark, folder), conformed(spark, folder, "order")),
    "SELECT CAST(YEAR(o_orderdate) * 100 + MONTH(o_orderdate) AS INTEGER) AS time_key, l_partkey AS product_key, "
    "o_custkey AS customer_key, CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity_ordered, "
    "CAST(SUM(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2))) AS DOUBLE) AS total_amount "
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3",
)
MARK = date(1999, 1, 1)
on_tables(
    "fact_sales_after_mark",
    lambda spark, folder: star.fact_sales(conformed(spark, folder, "order_product"), conformed(spark, folder, "order"), MARK),
    "SELECT CAST(YEAR(o_orderdate) * 100 + MONTH(o_orderdate) AS INTEGER) AS time_key, l_partkey AS product_key, "
    "o_custkey AS customer_key, CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity_ordered, "
    "CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS total_amount "
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE CAST(l_shipdate AS DATE) > DATE '1999-01-01' GROUP BY 1, 2, 3",
)
