"""Common star-join reports straight from the facts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.operators.cuboids import sales_rollup, with_time
from starlattice.schemas import AMOUNT_TOTAL
from starlattice.sources.warehouse import Warehouse


def product_revenue(wh: Warehouse, first_key: int, last_key: int) -> DataFrame:
    """Revenue per product between two months, largest first; months outside are not read."""
    return (
        wh.table("fact_sales")
        .where(F.col("time_key").between(first_key, last_key))
        .groupBy("product_key")
        .agg(F.sum("total_amount").cast(AMOUNT_TOTAL).alias("revenue"))
        .orderBy(F.col("revenue").desc(), "product_key")
    )


def year_by_month(wh: Warehouse, year: int) -> DataFrame:
    """Revenue of a year down to quarters and months."""
    columns = ["year", "quarter", "month"]
    rows = sales_rollup(wh, columns).where(F.col("year") == year)
    return rows.select(*columns, F.col("sum_amount").alias("revenue")).orderBy(*columns)


def state_by_city(wh: Warehouse, state: str) -> DataFrame:
    """Revenue of the cities of a state, largest first."""
    rows = sales_rollup(wh, ["state", "city"]).where(F.col("state") == state)
    return rows.select("state", "city", F.col("sum_amount").alias("revenue")).orderBy(
        F.col("revenue").desc(), "city"
    )


def customers_by_type(wh: Warehouse, types: Iterable[str], year: int) -> DataFrame:
    """Distinct customers and revenue by type and quarter.

    Sales are summed per customer and quarter first, so counting customers is
    counting rows and no customer's lines are gathered anywhere.
    """
    wanted = wh.table("dim_customer").where(F.col("customer_type").isin(*types))
    wanted = wanted.select("customer_key", "customer_type")
    if wh.is_small("dim_customer"):
        wanted = F.broadcast(wanted)
    per_customer = (
        with_time(wh.table("fact_sales"), wh, ["year", "quarter"])
        .where(F.col("year") == year)
        .groupBy("year", "quarter", "customer_key")
        .agg(F.sum("total_amount").alias("amount"))
    )
    return (
        per_customer.join(wanted, "customer_key")
        .groupBy("customer_type", "year", "quarter")
        .agg(
            F.count(F.lit(1)).alias("num_customers"),
            F.sum("amount").cast(AMOUNT_TOTAL).alias("revenue"),
        )
        .orderBy("quarter", "customer_type")
    )
