"""Exact distinct counts that roll up: bitmaps of keys by month and place, united instead of counted anew.

A count of distinct customers of a quarter is no sum of the counts of its months. Of a
bitmap of the customers it is the union, so one table of bitmaps at the finest levels
answers every coarser count without the fact. A bitmap holds 32,768 neighbouring keys;
keys beyond them are in further rows of the same group.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.functions.periods import ALL_TIME_COLUMNS
from starlattice.functions.predicates import active_filters, all_of, equals_all
from starlattice.operators.cuboids import Star, located, spread

# The table of each counted key, its fact, and the columns a count may be grouped and filtered by.
TABLES = {"customer": "distinct_customers", "store": "distinct_stores", "product": "distinct_products"}
FACTS = {"customer": "fact_sales", "store": "fact_inventory", "product": "fact_inventory"}
COLUMNS = {
    "customer": (*ALL_TIME_COLUMNS, "customer_type", "state", "city"),
    "store": (*ALL_TIME_COLUMNS, "state", "city"),
    "product": (*ALL_TIME_COLUMNS, "state", "city"),
}
BUCKET, MEMBERS = "key_bucket", "members"
# Bitmaps, of 4 KB each, that one task sorts and unites.
BITMAPS_A_TASK = 16_384


def _placed(star: Star, people: str, key: str, columns: Iterable[str]) -> DataFrame:
    """Customers or stores with their place, which may be unknown."""
    return star.table(people).join(located(star), "location_key", "left").select(key, *columns)


def members(star: Star, counted: str) -> DataFrame:
    """Bitmaps of the counted keys in each month and place (and customer type); what is unknown of a customer is null.

    Keys are first made distinct by month, which folds a hot customer or store before anything is joined.
    They, not bitmaps, are shuffled: made in the tasks before, each task would have a bitmap of nearly every group.
    """
    fact = star.table(FACTS[counted])
    carrier = "customer_key" if counted == "customer" else "store_key"
    key = f"{counted}_key"
    keys = fact.select("time_key", *dict.fromkeys([carrier, key]))
    if carrier == key:
        keys = keys.distinct()
    months = star.table("dim_time").select("time_key", *ALL_TIME_COLUMNS)
    people = "dim_customer" if carrier == "customer_key" else "dim_store"
    attributes = [c for c in COLUMNS[counted] if c not in ALL_TIME_COLUMNS]
    known = _placed(star, people, carrier, attributes)
    if star.is_small(people):
        known = F.broadcast(known)
    # Stock of unknown months, stores or places is in no count, as in the stock cuboids.
    how = "left" if counted == "customer" else "inner"
    placed = keys.join(F.broadcast(months), "time_key", how).join(known, carrier, how)
    if how == "inner":
        placed = placed.where("state is not null")
    number = F.col(key).cast("bigint")
    bucketed = placed.withColumn(BUCKET, F.bitmap_bucket_number(number))
    # Also the parts of the write by year.
    parts = spread(bucketed, ("year", BUCKET), star.row_count(FACTS[counted]))
    return parts.groupBy(*COLUMNS[counted], BUCKET).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(MEMBERS)
    )


def count_distinct(
    wh: Star, counted: str, by: Iterable[str] = (), filters: Mapping[str, Any] | None = None, *, name: str | None = None
) -> DataFrame:
    """How many customers, stores or products the fact has in each group, exactly, from the stored bitmaps.

    Only rows whose group and filter columns are known count, as in a join of the
    fact with those dimensions; stock counts only with month, store and place known. Without `by` there is one row, zero where nothing fits.
    """
    by, filters = list(by), active_filters(filters)
    unknown = {*by, *filters} - set(COLUMNS[counted])
    if unknown:
        raise ValueError(f"distinct counts of {counted} keys know nothing of {', '.join(sorted(unknown))}")
    alias = name or f"distinct_{counted}s"
    inside: list[Column] = [F.col(c).isNotNull() for c in dict.fromkeys([*by, *filters])]
    rows = wh.table(TABLES[counted]).where(equals_all(filters) & all_of(inside))
    stored = wh.row_count(TABLES[counted])
    if stored is not None and stored > BITMAPS_A_TASK:
        rows = rows.repartition(math.ceil(stored / BITMAPS_A_TASK), *by, BUCKET)
    united = rows.groupBy(*by, BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(MEMBERS)).alias("held"))
    return united.groupBy(*by).agg(F.coalesce(F.sum("held"), F.lit(0)).cast("bigint").alias(alias))


BUILDERS = {table: (lambda star, c=counted: members(star, c)) for counted, table in TABLES.items()}
OF_CUBE = {"sales": ("distinct_customers",), "inventory": ("distinct_stores", "distinct_products")}
