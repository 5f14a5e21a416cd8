"""Column types of the source tables, the star tables and the measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums are wider than the stored amounts so that totals over very large facts fit.
AMOUNT = "decimal(15,2)"
AMOUNT_TOTAL = "decimal(24,2)"
QUANTITY_TOTAL = "bigint"

# Source table columns as DDL strings, in file order.
SOURCE_SCHEMAS = {
    "representative_office": "city_id int, city_name string, office_address string, state string, time date",
    "store": "store_id int, phone_number string, time date, city_id int",
    "product": "product_id int, description string, size string, weight decimal(10,2), price decimal(10,2), time date",
    "order": "order_id int, customer_id int, order_date date",
    "order_product": "order_id int, product_id int, ordered_quantity int, ordered_price decimal(15,2), time date",
    "stocked_product": "store_id int, product_id int, stock_quantity int, time date",
    "customer": "customer_id int, customer_name string, city_id int, first_order_date date",
    "tourist_customer": "customer_id int, tour_guide string, time date",
    "mail_order_customer": "customer_id int, postal_address string, time date",
}

# Primary keys of the source tables, the star tables and the facts.
PRIMARY_KEYS = {
    "representative_office": ("city_id",),
    "store": ("store_id",),
    "product": ("product_id",),
    "order": ("order_id",),
    "order_product": ("order_id", "product_id"),
    "stocked_product": ("store_id", "product_id"),
    "customer": ("customer_id",),
    "tourist_customer": ("customer_id",),
    "mail_order_customer": ("customer_id",),
    "dim_time": ("time_key",),
    "dim_location": ("location_key",),
    "dim_store": ("store_key",),
    "dim_customer": ("customer_key",),
    "dim_product": ("product_key",),
    "fact_sales": ("time_key", "product_key", "customer_key"),
    "fact_inventory": ("time_key", "store_key", "product_key"),
}

# Measures of each cube and the type of their sums.
MEASURES = {
    "sales": {"total_quantity": QUANTITY_TOTAL, "sum_amount": AMOUNT_TOTAL},
    "inventory": {"total_quantity_on_hand": QUANTITY_TOTAL},
}


def total(column: str, alias: str | None = None, *, of: str | None = None) -> Column:
    """Sum of a measure column in the type of that measure's totals."""
    alias = alias or column
    kind = of or next(types[alias] for types in MEASURES.values() if alias in types)
    return F.sum(column).cast(kind).alias(alias)
