"""Answering from the smallest covering cuboid, pivots, paging and drill operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.functions.paging import SortKey, page_counts, page_of, sort_columns, sort_keys
from starlattice.functions.periods import ALL_TIME_COLUMNS, TIME_COLUMNS
from starlattice.functions.predicates import active_filters, equals_all, key_contains
from starlattice.operators.cuboids import (
    CUBOIDS,
    LATTICES,
    Cuboid,
    latest_stock,
    sales_rollup,
    sums,
)
from starlattice.schemas import MEASURES, total
from starlattice.sources.warehouse import Warehouse

ROW_TOTAL = "__row_total__"
BASE_TABLE = {"sales": "olap_sales_base_loc", "inventory": "olap_inv_base"}

# Fields a pivot may use.
FIELDS = {
    "sales": frozenset({*ALL_TIME_COLUMNS, "product_key", "customer_key", "customer_type", "state", "city"}),
    "inventory": frozenset({*ALL_TIME_COLUMNS, "product_key", "store_key", "state", "city"}),
}


def choose(cube: str, needed: Iterable[str], filters: Mapping[str, Any] | None = None) -> Cuboid | None:
    """The cuboid with the fewest columns that has every needed and filtered column.

    Each level of a dimension has one smallest cover, so at most one cuboid
    has the fewest columns; None when no cuboid covers the request.
    """
    wanted = {*needed, *active_filters(filters)}
    covering = [c for c in LATTICES[cube].values() if wanted <= set(c.dimensions)]
    return min(covering, key=lambda c: (len(c.dimensions), c.name), default=None)


def check_fields(cube: str, fields: Iterable[str], measures: Iterable[str]) -> None:
    unknown = sorted(set(fields) - FIELDS[cube])
    if unknown:
        raise ValueError(f"unknown fields of the {cube} cube: {unknown}")
    unknown = sorted(set(measures) - set(MEASURES[cube]))
    if unknown:
        raise ValueError(f"unknown measures of the {cube} cube: {unknown}")


def _fixed_columns(group: Iterable[str], filters: Mapping[str, Any]) -> set[str]:
    """Columns with one value per result group: grouped, filtered, or implied by those."""
    fixed = {*group, *filters}
    if "month" in fixed:
        fixed.add("quarter")
    if "store_key" in fixed:
        fixed |= {"state", "city"}
    if "customer_key" in fixed:
        fixed |= {"state", "city", "customer_type"}
    return fixed


def _finish(
    rows: DataFrame, cuboid: Cuboid, group: tuple[str, ...], filters: Mapping[str, Any], measures: tuple[str, ...]
) -> DataFrame:
    """Sum again only when several cuboid rows fall into one result row."""
    if group and set(cuboid.dimensions) <= _fixed_columns(group, filters):
        return rows.select(*group, *measures)
    return sums(rows, group, measures)


def answer(
    wh: Warehouse,
    cube: str,
    group: Iterable[str] = (),
    filters: Mapping[str, Any] | None = None,
    measures: Iterable[str] | None = None,
) -> DataFrame:
    """Measures by `group` under equality filters, from the smallest covering cuboid."""
    group = tuple(group)
    measures = tuple(measures or MEASURES[cube])
    filters = active_filters(filters)
    check_fields(cube, [*group, *filters], measures)
    if cube == "inventory":
        return _stock_answer(wh, group, filters, measures)
    cuboid = choose(cube, group, filters)
    if cuboid is None:
        # Customer type together with a place: no cuboid has both.
        columns = [c for c in _ordered(cube) if c in {*group, *filters}]
        rows = sales_rollup(wh, columns)
        if set(columns) == set(group):
            return rows.where(equals_all(filters)).select(*group, *measures)
        return sums(rows.where(equals_all(filters)), group, measures)
    return _finish(wh.cuboid(cuboid.name).where(equals_all(filters)), cuboid, group, filters, measures)


def _ordered(cube: str) -> list[str]:
    return [*ALL_TIME_COLUMNS, "product_key", "customer_key", "store_key", "customer_type", "state", "city"]


def _stock_answer(
    wh: Warehouse, group: tuple[str, ...], filters: Mapping[str, Any], measures: tuple[str, ...]
) -> DataFrame:
    """Stock counts the latest snapshot inside each result group.

    A cuboid already holds that when each of its time columns is fixed in the
    group. Otherwise several of its snapshots would be added up, so the latest
    one is taken again from the monthly product-and-store cuboid.
    """
    cuboid = choose("inventory", group, filters)
    if cuboid is not None and set(TIME_COLUMNS[cuboid.time]) <= _fixed_columns(group, filters):
        rows = wh.cuboid(cuboid.name).where(equals_all(filters))
        return _finish(rows, cuboid, group, filters, measures)
    return sums(latest_in_filter(wh, group, filters), group, measures)


def latest_in_filter(wh: Warehouse, group: Iterable[str], filters: Mapping[str, Any] | None) -> DataFrame:
    """The newest stock per product and store among the filtered months, kept apart by `group`."""
    group = tuple(group)
    months = wh.cuboid("olap_inv_base").where(equals_all(filters))
    months = months.withColumn("period", F.col("year") * 100 + F.col("month"))
    time = [c for c in ALL_TIME_COLUMNS if c in group]
    place = [c for c in ("city", "state") if c in group]
    return latest_stock(months, time, "total_quantity_on_hand", "period", place, wh.row_count("fact_inventory"))


# Row groups of a page that is broadcast: a few short values each.
BROADCAST_PAGE = 500

# --- pivot ------------------------------------------------------------------


@dataclass(frozen=True)
class Pivot:
    """A pivot request; `page` None means every row."""

    rows: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    measures: tuple[str, ...] = ("sum_amount",)
    filters: Mapping[str, Any] = field(default_factory=dict)
    cube: str = "sales"
    page: int | None = 1
    page_size: int = 50
    sort_column: str | None = None
    sort_order: str = "asc"

    def __post_init__(self):
        # The stock cube has one measure; a request for others gets that one.
        if self.cube == "inventory":
            stock = tuple(m for m in self.measures if m in MEASURES["inventory"])
            known = all(m in MEASURES["sales"] or m in stock for m in self.measures)
            if known:
                object.__setattr__(self, "measures", stock or tuple(MEASURES["inventory"]))

    @property
    def descending(self) -> bool:
        return self.sort_order.lower() == "desc"


def swap_axes(spec: Pivot) -> Pivot:
    return replace(spec, rows=spec.columns, columns=spec.rows)


def drill_down(spec: Pivot, new_field: str) -> Pivot:
    return replace(spec, rows=(*spec.rows, new_field))


def roll_up(spec: Pivot) -> Pivot:
    return replace(spec, rows=spec.rows[:-1])


def cells(wh: Warehouse, spec: Pivot) -> DataFrame:
    """One row per row-and-column group with its measures."""
    return answer(wh, spec.cube, [*spec.rows, *spec.columns], spec.filters, spec.measures)


def row_totals(wh: Warehouse, spec: Pivot) -> DataFrame:
    """The first measure per row group, over all its cells."""
    main = spec.measures[0]
    return cells(wh, spec).groupBy(*spec.rows).agg(total(main, ROW_TOTAL, of=MEASURES[spec.cube][main]))


def row_order(spec: Pivot) -> list[SortKey]:
    """Order of the row groups, made unique by the row columns."""
    if spec.sort_column == ROW_TOTAL:
        return sort_keys([ROW_TOTAL], spec.descending) + sort_keys(spec.rows)
    if spec.sort_column in spec.rows:
        return sort_keys([spec.sort_column], spec.descending) + sort_keys(spec.rows)
    return sort_keys(spec.rows)


def result_order(spec: Pivot) -> list[Column]:
    tie_break = sort_columns([*spec.rows, *spec.columns])
    if spec.sort_column in {ROW_TOTAL, *spec.rows, *spec.columns, *spec.measures}:
        return sort_columns([spec.sort_column], spec.descending) + tie_break
    return tie_break


def pivot(wh: Warehouse, spec: Pivot) -> DataFrame:
    """Cells with the total of their row, for one page of row groups, sorted.

    Row totals are summed with partial aggregation and joined back to the
    cells, so a row group with very many cells never sits in one task. A page of
    up to `BROADCAST_PAGE` row groups is broadcast to the cells.
    """
    check_fields(spec.cube, [*spec.rows, *spec.columns, *active_filters(spec.filters)], spec.measures)
    grid = cells(wh, spec)
    if not spec.rows:
        main = spec.measures[0]
        grand = grid.agg(total(main, ROW_TOTAL, of=MEASURES[spec.cube][main])).scalar()
        with_total = grid.withColumn(ROW_TOTAL, grand)
        return with_total.orderBy(*result_order(spec)) if spec.columns else with_total
    totals = row_totals(wh, spec)
    if spec.page is not None:
        totals = page_of(totals, row_order(spec), spec.page, spec.page_size)
        if spec.page_size <= BROADCAST_PAGE:
            totals = F.broadcast(totals)
    joined = grid.join(totals, list(spec.rows))
    return joined.select(*spec.rows, *spec.columns, *spec.measures, ROW_TOTAL).orderBy(*result_order(spec))


def pivot_page_counts(wh: Warehouse, spec: Pivot) -> DataFrame:
    """How many row groups there are, and on how many pages (at least one)."""
    if not spec.rows:
        return page_counts(wh.spark.range(1), spec.page_size, at_least_one=True)
    groups = answer(wh, spec.cube, spec.rows, spec.filters, spec.measures)
    return page_counts(groups, spec.page_size, at_least_one=True)


# The column that holds what lies in none of the listed column groups.
REMAINDER = "other"


def _column_label(spec: Pivot) -> Column:
    return F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("N/A")) for c in spec.columns])


def crosstab(
    wh: Warehouse, spec: Pivot, column_values: Iterable[str] | None = None, at_most: int = 10_000
) -> DataFrame:
    """Two-dimensional table of the first measure: one column per column-group value.

    Column groups are labelled by their values joined with " | ", missing
    values as "N/A". Empty cells are 0 and the total of all cells closes each row.
    The columns are those of the data, refused beyond `at_most`; with
    `column_values` they are the listed ones and a last one, `REMAINDER`, for the rest.
    """
    main = spec.measures[0]
    kind = MEASURES[spec.cube][main]
    listed = column_values is not None
    values = list(column_values) if listed else column_labels(wh, spec, at_most)
    clash = {*spec.rows, ROW_TOTAL, *([REMAINDER] if listed else [])} & set(values)
    if clash:
        raise ValueError(f"column groups named like another column: {', '.join(sorted(clash))}")
    label = _column_label(spec)
    shown = [*values, REMAINDER] if listed else values
    labelled = cells(wh, spec).withColumn(
        "column_label", F.when(label.isin(values), label).otherwise(REMAINDER) if listed else label
    )
    table = labelled.groupBy(*spec.rows).pivot("column_label", shown).agg(total(main)) if shown else (
        labelled.select(*spec.rows).distinct()
    )
    filled = [F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast(kind) for v in shown]
    every = sum(filled, F.lit(0)).cast(kind)
    return table.select(*spec.rows, *[c.alias(v) for c, v in zip(filled, shown)], every.alias(ROW_TOTAL))


def column_labels(wh: Warehouse, spec: Pivot, at_most: int = 10_000) -> list[str]:
    """The column-group labels present, numbers in number order; refuses more than `at_most`."""
    groups = answer(wh, spec.cube, spec.columns, spec.filters, spec.measures)
    found = groups.select(_column_label(spec).alias("label"), *spec.columns).orderBy(*sort_columns(spec.columns))
    rows = found.limit(at_most + 1).collect()
    if len(rows) > at_most:
        raise ValueError(f"more than {at_most} column groups")
    return list(dict.fromkeys(r["label"] for r in rows))


def top_cells(wh: Warehouse, spec: Pivot, n: int = 100) -> DataFrame:
    """The cells with the largest first measure."""
    order = sort_columns([spec.measures[0]], descending=True) + sort_columns([*spec.rows, *spec.columns])
    return cells(wh, spec).orderBy(*order).limit(n)


# --- raw rows, group-by, drill-through, drill-across, values ----------------


def raw_rows(
    wh: Warehouse,
    cube: str,
    columns: Iterable[str] = (),
    filters: Mapping[str, Any] | None = None,
    page: int = 1,
    page_size: int = 100,
) -> DataFrame:
    """A page of the finest cuboid, largest measure first."""
    base = CUBOIDS[BASE_TABLE[cube]]
    main = {"sales": "sum_amount", "inventory": "total_quantity_on_hand"}[cube]
    rows = wh.cuboid(base.name).where(equals_all(filters))
    order = sort_keys([main], descending=True) + sort_keys(base.dimensions)
    found = page_of(rows, order, page, page_size)
    return found.select(*columns) if columns else found


def raw_row_counts(
    wh: Warehouse, cube: str, filters: Mapping[str, Any] | None = None, page_size: int = 100
) -> DataFrame:
    return page_counts(wh.cuboid(BASE_TABLE[cube]).where(equals_all(filters)), page_size)


def inventory_query(
    wh: Warehouse,
    columns: Iterable[str] = (),
    filters: Mapping[str, Any] | None = None,
    group_by: Iterable[str] = (),
) -> DataFrame:
    """Stock by `group_by`, or the chosen columns of the covering cuboid."""
    group_by, columns = tuple(group_by), tuple(columns)
    if group_by:
        return answer(wh, "inventory", group_by, filters).orderBy(*sort_columns(group_by))
    cuboid = choose("inventory", [c for c in columns if c not in MEASURES["inventory"]], filters)
    if cuboid is None:
        raise ValueError(f"no cuboid has the columns {columns}")
    rows = wh.cuboid(cuboid.name).where(equals_all(filters))
    return rows.select(*columns) if columns else rows


FACT_KEYS = {
    "fact_sales": ("time_key", "product_key", "customer_key"),
    "fact_inventory": ("time_key", "store_key", "product_key"),
}


def drill_through(
    wh: Warehouse,
    cube: str,
    filters: Mapping[str, Any],
    columns: Iterable[str] = (),
    page: int = 1,
    page_size: int = 100,
) -> DataFrame:
    """A page of the fact rows behind a selection."""
    if not filters:
        raise ValueError("drill-through needs filters")
    fact = {"sales": "fact_sales", "inventory": "fact_inventory"}[cube]
    rows = wh.table(fact).where(equals_all(filters))
    found = page_of(rows, sort_keys(FACT_KEYS[fact]), page, page_size)
    return found.select(*columns) if columns else found


def drill_across(
    wh: Warehouse,
    dimensions: Iterable[str],
    filters: Mapping[str, Any] | None = None,
    measures_sales: Iterable[str] = ("sum_amount",),
    measures_inventory: Iterable[str] = ("total_quantity_on_hand",),
) -> DataFrame:
    """Sales and stock side by side on shared dimensions; a side without rows is NULL.

    Both sides are aggregated first, padded to the same columns and grouped
    together: a full outer join on all dimensions in one shuffle.
    """
    dimensions = tuple(dimensions)
    if not dimensions:
        raise ValueError("drill-across needs dimensions")
    measures_sales, measures_inventory = tuple(measures_sales), tuple(measures_inventory)
    sales = answer(wh, "sales", dimensions, filters, measures_sales).withColumnsRenamed(
        {m: f"sales_{m}" for m in measures_sales}
    )
    stock = answer(wh, "inventory", dimensions, filters, measures_inventory).withColumnsRenamed(
        {m: f"inventory_{m}" for m in measures_inventory}
    )
    return side_by_side(sales, stock, dimensions)


def side_by_side(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Full outer join of two tables that have at most one row per key."""
    keys = tuple(keys)
    both = left.unionByName(right, allowMissingColumns=True)
    values = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def dimension_values(
    wh: Warehouse,
    cube: str,
    dimension: str,
    search: str | None = None,
    page: int = 1,
    page_size: int = 100,
) -> DataFrame:
    """A page of the distinct non-null values of a dimension."""
    return page_of(
        _dimension_values(wh, cube, dimension, search), sort_keys([dimension]), page, page_size
    )


def dimension_value_counts(
    wh: Warehouse, cube: str, dimension: str, search: str | None = None, page_size: int = 100
) -> DataFrame:
    return page_counts(_dimension_values(wh, cube, dimension, search), page_size)


def _dimension_values(wh: Warehouse, cube: str, dimension: str, search: str | None) -> DataFrame:
    check_fields(cube, [dimension], [])
    values = answer(wh, cube, [dimension]).select(dimension).where(F.col(dimension).isNotNull())
    return values.where(key_contains(dimension, search)) if search else values
