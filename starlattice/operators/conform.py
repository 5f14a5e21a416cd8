"""Incremental extracts: a high-water-mark filter and a mapping-driven projection."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.functions.predicates import changed_since

NEVER_LOADED = date(1970, 1, 1)

RULES = {
    "keep": lambda c: c,
    "trim": F.trim,
    "upper": F.upper,
    "round2": lambda c: F.round(c, 2),
}


@dataclass(frozen=True)
class Extract:
    """Which rows count as changed, and how each source column is conformed."""

    change_column: str
    columns: tuple[tuple[str, str, str], ...]  # (source column, conformed column, rule)


# Column mappings of the nine extracts.
EXTRACTS = {
    "representative_office": Extract("time", (
        ("city_id", "city_id", "keep"),
        ("city_name", "city_name", "trim"),
        ("office_address", "office_address", "keep"),
        ("state", "state", "keep"),
        ("time", "last_updated_time", "keep"),
    )),
    "store": Extract("time", (
        ("store_id", "store_id", "keep"),
        ("phone_number", "phone_number", "keep"),
        ("time", "last_updated_time", "keep"),
        ("city_id", "city_id", "keep"),
    )),
    "product": Extract("time", (
        ("product_id", "product_id", "keep"),
        ("description", "description", "trim"),
        ("size", "size", "upper"),
        ("weight", "weight", "round2"),
        ("price", "price", "round2"),
        ("time", "last_updated_time", "keep"),
    )),
    "order": Extract("order_date", (
        ("order_id", "order_id", "keep"),
        ("customer_id", "customer_id", "keep"),
        ("order_date", "order_date", "keep"),
    )),
    "order_product": Extract("time", (
        ("order_id", "order_id", "keep"),
        ("product_id", "product_id", "keep"),
        ("ordered_quantity", "ordered_quantity", "keep"),
        ("ordered_price", "ordered_price", "keep"),
        ("line_amount", "line_amount", "keep"),
        ("time", "last_updated_time", "keep"),
    )),
    "stocked_product": Extract("time", (
        ("store_id", "store_id", "keep"),
        ("product_id", "product_id", "keep"),
        ("stock_quantity", "stock_quantity", "keep"),
        ("time", "last_updated_time", "keep"),
    )),
    "customer": Extract("first_order_date", (
        ("customer_id", "customer_id", "keep"),
        ("customer_name", "customer_name", "keep"),
        ("city_id", "city_id", "keep"),
        ("first_order_date", "first_order_date", "keep"),
    )),
    "tourist_customer": Extract("time", (
        ("customer_id", "customer_id", "keep"),
        ("tour_guide", "tour_guide", "trim"),
        ("time", "last_updated_time", "keep"),
    )),
    "mail_order_customer": Extract("time", (
        ("customer_id", "customer_id", "keep"),
        ("postal_address", "postal_address", "trim"),
        ("time", "last_updated_time", "keep"),
    )),
}


# An order line has either a unit price or a line amount.
EITHER = {"order_product": {"ordered_price", "line_amount"}}


def conform(source: DataFrame, table: str, since: date | str = NEVER_LOADED) -> DataFrame:
    """Rows changed on or after `since`, renamed and cleaned.

    A mapped column that the source lacks is an error, but for one of an order
    line's price and amount.
    """
    extract = EXTRACTS[table]
    either = EITHER.get(table, set())
    lacking = {name for name, _, _ in extract.columns if name not in source.columns}
    if (lacking - either) or (either and either <= lacking):
        raise ValueError(f"source of {table} lacks {', '.join(sorted(lacking))}")
    projected: list[Column] = [
        RULES[rule](F.col(name)).alias(target) for name, target, rule in extract.columns if name not in lacking
    ]
    return source.where(changed_since(extract.change_column, since, inclusive=True)).select(*projected)
