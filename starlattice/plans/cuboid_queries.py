"""Every cuboid from its fact, the extra groupings, and the full refresh."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.operators.cuboids import CUBOIDS, LATTICES, Cuboid, build, sales_rollup
from starlattice.plans.registry import on_star
from starlattice.plans.star_sql import sales_by, stock_by
from starlattice.schemas import MEASURES
from starlattice.sources.warehouse import Warehouse


def cuboid_sql(cuboid: Cuboid) -> str:
    return sales_by(cuboid.dimensions) if cuboid.cube == "sales" else stock_by(cuboid.dimensions)


def _register_cuboid(cuboid: Cuboid) -> None:
    on_star(f"cuboid_{cuboid.name}", lambda wh: build(wh, cuboid), cuboid_sql(cuboid))


for _cuboid in CUBOIDS.values():
    _register_cuboid(_cuboid)

# Groupings that have customer type and place together.
TYPE_AND_PLACE = {
    "cuboid_type_and_place": ("customer_type", "customer_key", "state", "city"),
    "cuboid_product_type_and_place": ("product_key", "customer_type", "customer_key", "state", "city"),
    "cuboid_time_type_and_place": ("year", "quarter", "month", "customer_type", "customer_key", "state", "city"),
    "cuboid_base_type_and_place": (
        "year", "quarter", "month", "product_key", "customer_type", "customer_key", "state", "city",
    ),
}


def _register_grouping(name: str, columns: tuple[str, ...]) -> None:
    on_star(name, lambda wh: sales_rollup(wh, columns), sales_by(columns))


for _name, _columns in TYPE_AND_PLACE.items():
    _register_grouping(_name, _columns)


def refreshed(wh: Warehouse, cube: str, *, one_scan: bool = False) -> DataFrame:
    """Rebuild all cuboids of a cube; the rows and the first measure's sum of each, counted as they were written."""
    written = [(w.name, w.row_count, w.measure_sum) for w in wh.refresh_cuboids(cube, one_scan=one_scan)]
    return wh.spark.createDataFrame(written, "cuboid string, row_count bigint, measure_sum bigint")


def refresh_sql(cube: str) -> str:
    measure = next(iter(MEASURES[cube]))
    lines = [
        f"SELECT '{c.name}' AS cuboid, COUNT(*) AS row_count, CAST(SUM({measure}) AS BIGINT) AS measure_sum "
        f"FROM ({cuboid_sql(c)})"
        for c in LATTICES[cube].values()
    ]
    return " UNION ALL ".join(lines)


on_star("refresh_sales_cuboids", lambda wh: refreshed(wh, "sales"), refresh_sql("sales"))
on_star("refresh_sales_from_one_scan", lambda wh: refreshed(wh, "sales", one_scan=True), refresh_sql("sales"))
on_star("refresh_inventory_cuboids", lambda wh: refreshed(wh, "inventory"), refresh_sql("inventory"))


# --- a refresh after a second load, of the years it changed -------------------

FACT_OF = {"sales": "fact_sales", "inventory": "fact_inventory"}
SECOND_LOAD_FROM, CORRECTED_YEAR = 2000, 1997


def refreshed_after_second_load(wh: Warehouse, cube: str) -> DataFrame:
    """Refresh, then a load that brings the years from 2000 on and a fifth of 1997's products, then those years again."""
    if wh.root is None:
        raise ValueError("a refresh needs a shared folder")
    late = (F.col("time_key") >= SECOND_LOAD_FROM * 100) | (
        F.col("time_key").between(CORRECTED_YEAR * 100, CORRECTED_YEAR * 100 + 99) & (F.col("product_key") % 5 == 0)
    )
    names = ("dim_time", "dim_location", "dim_product", "dim_store", "dim_customer", "fact_sales", "fact_inventory")
    loaded = {"version": "first"}

    def table(name: str) -> DataFrame:
        whole = wh.table(name)
        return whole.where(~late) if name == FACT_OF[cube] and loaded["version"] == "first" else whole

    def changed(_cube: str, _before: str) -> list[int]:
        years = wh.table(FACT_OF[cube]).where(late).select(F.expr("time_key div 100").cast("int").alias("year")).distinct()
        return [r["year"] for r in years.collect()]

    growing = Warehouse(
        wh.spark,
        {n: (lambda _, n=n: table(n)) for n in names},
        f"{wh.root}/second-load/{uuid.uuid4().hex[:12]}",
        views=frozenset(names),
        version=lambda: loaded["version"],
        changed_years=changed,
        view_rows=wh.row_count,
    )
    growing.refresh_cuboids(cube)
    loaded["version"] = "second"
    written = [(w.name, w.row_count, w.measure_sum) for w in growing.refresh_changed(cube)]
    return wh.spark.createDataFrame(written, "cuboid string, row_count bigint, measure_sum bigint")


on_star("refresh_after_second_load_sales", lambda wh: refreshed_after_second_load(wh, "sales"), refresh_sql("sales"))
on_star("refresh_after_second_load_stock", lambda wh: refreshed_after_second_load(wh, "inventory"), refresh_sql("inventory"))
