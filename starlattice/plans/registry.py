"""How a query is registered: a function over the warehouse and its check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlattice.plans.star_sql import STAR
from starlattice.sources.warehouse import Warehouse, open_warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the way results leave the warehouse."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("double") for name in decimals}) if decimals else df


def add(name: str, run: Query, check: str | None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = lambda spark, folder: plain_numbers(run(spark, folder))
    if check is not None:
        CHECKS[name] = check


def on_tables(name: str, run: Query, check: str | None) -> None:
    """A query over the given tables."""
    add(name, run, check)


def on_star(name: str, run: Callable[[Warehouse], DataFrame], check: str | None) -> None:
    """A query over the warehouse; its check SQL follows the star's table expressions."""
    add(name, lambda spark, folder: run(open_warehouse(spark, folder)), STAR + check if check else None)
