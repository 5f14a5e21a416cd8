"""Inventory dashboard: stock against sales, coverage, risk status, rankings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlattice.functions.paging import page_of, sort_columns, sort_keys
from starlattice.functions.periods import TIME_COLUMNS, next_period, quarter_of
from starlattice.functions.predicates import active_filters
from starlattice.operators.navigate import answer, latest_in_filter
from starlattice.operators.sales import product_name, ratio
from starlattice.schemas import MEASURES, QUANTITY_TOTAL
from starlattice.sources.warehouse import Warehouse

Filters = Mapping[str, Any] | None
# Statuses, their factors and the coverage of products without sales.
STATUSES = ("optimal", "overstock", "understock")
OVERSTOCK_FACTOR = 1.2
UNDERSTOCK_FACTOR = 0.8
NO_SALES_COVERAGE = 999.0
# Ratios are summed as decimals of this type: the sum does not depend on task order,
# and the twelve places are finer than any score that is shown.
SCORE = "decimal(38,12)"


def _without_store(filters: Filters) -> dict[str, Any]:
    """Sales have no store, so a store filter only restricts stock."""
    return {k: v for k, v in active_filters(filters).items() if k != "store_key"}


def _by_period(wh: Warehouse, cube: str, level: str, filters: Filters, by: Iterable[str]) -> DataFrame:
    return answer(wh, cube, [*by, *TIME_COLUMNS[level]], filters)


def sales_by_period(wh: Warehouse, level: str, filters: Filters = None, by: Iterable[str] = ()) -> DataFrame:
    return _by_period(wh, "sales", level, _without_store(filters), by)


def stock_by_period(wh: Warehouse, level: str, filters: Filters = None, by: Iterable[str] = ()) -> DataFrame:
    return _by_period(wh, "inventory", level, filters, by)


def merge_measures(sales: DataFrame, stock: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Sales and stock per key, 0 where one side has none: a full outer join as one aggregation."""
    both = sales.unionByName(stock, allowMissingColumns=True)
    kinds = {**MEASURES["sales"], **MEASURES["inventory"]}
    return both.groupBy(*keys).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast(t).alias(m) for m, t in kinds.items()]
    )


def with_coverage(merged: DataFrame, level: str, by: Iterable[str] = (), decimals: int | None = 2) -> DataFrame:
    """Stock against the sales of the following period, whose figures replace the period's own.

    The last period, and one followed by no sales, has coverage 0. A window
    holds the periods of one `by` group: at most the months of the calendar.
    """
    following = Window.partitionBy(*by).orderBy(*TIME_COLUMNS[level])
    return (
        merged.withColumn("next_quantity", F.coalesce(F.lead("total_quantity").over(following), F.lit(0)))
        .withColumn("next_amount", F.coalesce(F.lead("sum_amount").over(following), F.lit(0)))
        .select(
            *by,
            *TIME_COLUMNS[level],
            F.concat_ws("-", *TIME_COLUMNS[level]).alias("time_key"),
            F.col("next_quantity").cast(QUANTITY_TOTAL).alias("total_quantity"),
            F.col("next_amount").cast(MEASURES["sales"]["sum_amount"]).alias("sum_amount"),
            "total_quantity_on_hand",
            ratio(F.col("total_quantity_on_hand"), F.col("next_quantity"), decimals).alias("coverage_ratio"),
        )
    )


def forward_coverage(
    wh: Warehouse,
    level: str = "month",
    filters: Filters = None,
    by: Iterable[str] = (),
    decimals: int | None = 2,
) -> DataFrame:
    """Coverage per period, in time order, or per `by` group and period, from both cubes."""
    by = tuple(by)
    keys = [*by, *TIME_COLUMNS[level]]
    merged = merge_measures(
        sales_by_period(wh, level, filters, by), stock_by_period(wh, level, filters, by), keys
    )
    covered = with_coverage(merged, level, by, decimals)
    return covered if by else covered.orderBy(*keys)


def _single_period(level: str, active: Mapping[str, Any]) -> bool:
    return "year" in active and (level == "year" or level in active)


def product_analysis(
    wh: Warehouse,
    product_key: int | None,
    level: str = "month",
    filters: Filters = None,
    decimals: int | None = 2,
) -> DataFrame:
    """Stock and next-period sales of a product, or of everything when it is None.

    When the filter fixes one period, that period's stock is set against the
    sales of the period after it; otherwise the whole trend is returned.
    """
    active = {**active_filters(filters), **active_filters({"product_key": product_key})}
    if not _single_period(level, active):
        return forward_coverage(wh, level, active, decimals=decimals)

    parts = [p for p in ("year", "quarter", "month") if p in TIME_COLUMNS[level]]
    now = {p: active.get(p) for p in parts}
    if level == "month" and now["quarter"] is None:
        now["quarter"] = quarter_of(now["month"])
    shifted = next_period(**{p: active[p] for p in parts if p in active})
    others = {k: v for k, v in active.items() if k not in ("year", "quarter", "month")}
    finer = {k: v for k, v in active.items() if k in ("quarter", "month") and k not in parts}
    sales = answer(wh, "sales", (), {**_without_store(others), **finer, **shifted})
    stock = answer(wh, "inventory", (), active)
    # Both sides are one row of totals.
    merged = merge_measures(sales, stock, [])
    label = "-".join(str(now[p]) for p in parts)
    return merged.select(
        *[F.lit(now[p]).cast("int").alias(p) for p in parts],
        F.lit(label).alias("time_key"),
        "total_quantity",
        "sum_amount",
        "total_quantity_on_hand",
        ratio(F.col("total_quantity_on_hand"), F.col("total_quantity"), decimals).alias("coverage_ratio"),
    )


def overview(wh: Warehouse, filters: Filters = None, decimals: int | None = 2) -> DataFrame:
    """Total stock, how many stores and products hold it, and stock per store."""
    if active_filters(filters):
        counted = latest_in_filter(wh, (), filters).agg(
            F.coalesce(F.sum("total_quantity_on_hand"), F.lit(0)).cast(QUANTITY_TOTAL).alias("total_inventory"),
            F.count_distinct("store_key").alias("total_stores"),
            F.count_distinct("product_key").alias("total_products"),
        )
    else:
        # Cuboids by store and by product have one row per key: counting rows counts keys. Made after
        # the snapshots by product and store, they are summed from these.
        wh.cuboid("olap_inv_product_store")
        stores = wh.cuboid("olap_inv_by_store").agg(F.count("store_key")).scalar()
        products = wh.cuboid("olap_inv_by_product").agg(F.count("product_key")).scalar()
        counted = wh.cuboid("olap_inv_all").select(
            F.coalesce("total_quantity_on_hand", F.lit(0)).alias("total_inventory"),
            stores.alias("total_stores"),
            products.alias("total_products"),
        )
    per_store = ratio(F.col("total_inventory"), F.col("total_stores"), decimals)
    return counted.withColumn("avg_inventory_per_store", per_store)


def stock_status(stock: Column, sales: Column) -> Column:
    """More than 1.2 times the sales is overstock, less than 0.8 times understock."""
    stock, sales = stock.cast("double"), sales.cast("double")
    return (
        F.when(stock > sales * F.lit(OVERSTOCK_FACTOR), "overstock")
        .when(stock < sales * F.lit(UNDERSTOCK_FACTOR), "understock")
        .otherwise("optimal")
    )


def product_scatter(wh: Warehouse, filters: Filters = None, decimals: int | None = 2) -> DataFrame:
    """Stock, sales, coverage and status per product.

    With a time filter the sales are those of the period after it. Products
    with stock but no sales have coverage 999.
    """
    active = active_filters(filters)
    time = {k: v for k, v in active.items() if k in ("year", "quarter", "month")}
    sales_filter = {**_without_store(active), **(_shifted(time) if time else {})}
    merged = merge_measures(
        answer(wh, "sales", ["product_key"], sales_filter),
        answer(wh, "inventory", ["product_key"], active),
        ["product_key"],
    )
    sales, stock = F.col("total_quantity"), F.col("total_quantity_on_hand")
    coverage = F.when(sales > 0, ratio(stock, sales, decimals)).otherwise(
        F.when(stock > 0, F.lit(NO_SALES_COVERAGE)).otherwise(F.lit(0.0))
    )
    return merged.select(
        "product_key",
        product_name().alias("product_name"),
        sales.alias("sales"),
        stock.alias("inventory"),
        coverage.alias("coverage_ratio"),
        stock_status(stock, sales).alias("status"),
    )


def _shifted(time: Mapping[str, int]) -> dict[str, int]:
    """The following period, restricted to the parts the filter names."""
    following = next_period(**time)
    return {k: v for k, v in following.items() if k in time and v is not None}


def status_counts(scatter: DataFrame) -> DataFrame:
    """Products per status, 0 for a status no product has."""
    return scatter.agg(
        *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES]
    )


def most_over_ordered(scatter: DataFrame, n: int = 5) -> DataFrame:
    return scatter.orderBy(F.col("inventory").desc(), F.col("sales"), F.col("product_key")).limit(n)


def most_short(scatter: DataFrame, n: int = 5) -> DataFrame:
    return scatter.orderBy(F.col("inventory"), F.col("sales").desc(), F.col("product_key")).limit(n)


def city_risk(wh: Warehouse, filters: Filters = None, decimals: int | None = 2) -> DataFrame:
    """Per city: how many products are over- and understocked, and how badly on average.

    The score of an overstocked product is stock per sale, of an understocked
    one sales per unit of stock; a missing divisor counts as 1.
    """
    keys = ["city", "state", "product_key"]
    merged = merge_measures(
        answer(wh, "sales", keys, filters), answer(wh, "inventory", keys, filters), keys
    )
    sales, stock = F.col("total_quantity"), F.col("total_quantity_on_hand")
    status = stock_status(stock, sales)
    rated = merged.select(
        "city",
        "state",
        sales.alias("sales"),
        stock.alias("inventory"),
        F.when(status == "overstock", _per(stock, sales)).alias("over"),
        F.when(status == "understock", _per(sales, stock)).alias("under"),
    )
    per_city = rated.groupBy("city", "state").agg(
        F.count("over").alias("overstock_count"),
        F.sum("over").alias("over_sum"),
        F.count("under").alias("understock_count"),
        F.sum("under").alias("under_sum"),
        F.sum("inventory").alias("stock_sum"),
        F.count(F.lit(1)).alias("products"),
        F.sum("sales").cast(QUANTITY_TOTAL).alias("total_sales"),
    )
    return per_city.select(
        "city",
        "state",
        "overstock_count",
        ratio(F.col("over_sum"), F.col("overstock_count"), decimals).alias("overstock_score"),
        "understock_count",
        ratio(F.col("under_sum"), F.col("understock_count"), decimals).alias("understock_score"),
        ratio(F.col("stock_sum"), F.col("products"), decimals).alias("avg_inventory"),
        "total_sales",
    )


def _per(top: Column, bottom: Column) -> Column:
    divisor = F.when(bottom > 0, bottom).otherwise(F.lit(1))
    return (top.cast("double") / divisor.cast("double")).cast(SCORE)


def riskiest_cities(cities: DataFrame, kind: str, n: int = 3) -> DataFrame:
    """The n cities with the highest overstock or understock score."""
    if kind not in ("overstock", "understock"):
        raise ValueError(f"unknown kind of risk: {kind}")
    return (
        cities.where(F.col(f"{kind}_count") > 0)
        .orderBy(F.col(f"{kind}_score").desc(), *sort_columns(["city", "state"]))
        .limit(n)
    )


def stocked_products(wh: Warehouse, page: int = 1, page_size: int = 50) -> DataFrame:
    """A page of products with their stock."""
    products = answer(wh, "inventory", ["product_key"]).select(
        "product_key",
        product_name().alias("product_name"),
        F.col("total_quantity_on_hand").alias("total_inventory"),
    )
    return page_of(products, sort_keys(["product_key"]), page, page_size)


def stocked_stores(wh: Warehouse) -> DataFrame:
    """Every store with its stock."""
    return (
        answer(wh, "inventory", ["store_key"])
        .select(
            "store_key",
            F.concat(F.lit("Store "), F.col("store_key").cast("string")).alias("store_name"),
            F.col("total_quantity_on_hand").alias("total_inventory"),
        )
        .orderBy("store_key")
    )
