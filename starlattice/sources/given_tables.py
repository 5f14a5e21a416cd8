"""The given Parquet tables seen as the retail source tables.

Stand-ins: suppliers are stores, nations are cities, regions are states,
market segments decide who is a tourist or mail-order customer, and monthly
shipped quantities per supplier and part are the stock snapshots. Master
tables have no change date and get the first day of the data.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlattice.schemas import AMOUNT

FIRST_DAY = date(1995, 1, 1)
TOURIST_SEGMENTS = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD")
MAIL_ORDER_SEGMENTS = ("HOUSEHOLD", "FURNITURE")


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def representative_office(spark: SparkSession, folder: str) -> DataFrame:
    nation = given(spark, folder, "nation")
    region = given(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.concat_ws(", ", "n_name", "r_name").alias("office_address"),
        F.col("r_name").alias("state"),
        F.lit(FIRST_DAY).alias("time"),
    )


def store(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("phone_number"),
        F.lit(FIRST_DAY).alias("time"),
        F.col("s_nationkey").alias("city_id"),
    )


def product(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("size"),
        F.col("p_size").cast("decimal(10,2)").alias("weight"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.lit(FIRST_DAY).alias("time"),
    )


def order(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def order_product(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines; the given lines carry the amount, not a unit price."""
    return given(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("ordered_quantity"),
        F.col("l_extendedprice").cast(AMOUNT).alias("line_amount"),
        F.col("l_shipdate").cast("date").alias("time"),
    )


def monthly_stock(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in stock movements, one row per line, dated by shipment."""
    return given(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("stock_quantity"),
        F.col("l_shipdate").cast("date").alias("time"),
    )


def stocked_product(spark: SparkSession, folder: str) -> DataFrame:
    """One stock row per store and product, dated by its last movement."""
    return (
        monthly_stock(spark, folder)
        .groupBy("store_id", "product_id")
        .agg(
            F.sum("stock_quantity").cast("int").alias("stock_quantity"),
            F.max("time").alias("time"),
        )
    )


def customer(spark: SparkSession, folder: str) -> DataFrame:
    first_orders = (
        order(spark, folder)
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("first_order_date"))
    )
    return (
        given(spark, folder, "customer")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").alias("city_id"),
        )
        .join(first_orders, "customer_id", "left")
    )


def _members(spark: SparkSession, folder: str, segments: tuple[str, ...], note: Column) -> DataFrame:
    return (
        given(spark, folder, "customer")
        .where(F.col("c_mktsegment").isin(*segments))
        .select(
            F.col("c_custkey").alias("customer_id"),
            note,
            F.lit(FIRST_DAY).alias("time"),
        )
    )


def tourist_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _members(spark, folder, TOURIST_SEGMENTS, F.col("c_name").alias("tour_guide"))


def mail_order_customer(spark: SparkSession, folder: str) -> DataFrame:
    address = F.concat_ws(", ", "c_name", "c_mktsegment").alias("postal_address")
    return _members(spark, folder, MAIL_ORDER_SEGMENTS, address)


SOURCES = {
    "representative_office": representative_office,
    "store": store,
    "product": product,
    "order": order,
    "order_product": order_product,
    "stocked_product": stocked_product,
    "customer": customer,
    "tourist_customer": tourist_customer,
    "mail_order_customer": mail_order_customer,
}
