"""The lattice of materialised aggregates over the two facts.

Sales sums are additive. Stock is a periodic snapshot: within the chosen time
grain only the latest month of each product and store counts, and those
quantities are summed over the rest.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.functions.periods import ALL_TIME_COLUMNS, TIME_COLUMNS
from starlattice.schemas import MEASURES, QUANTITY_TOTAL, total


class Star(Protocol):
    """What the builders need: the star tables, which dimensions are small, and how many rows a stored table has."""

    def table(self, name: str) -> DataFrame: ...

    def is_small(self, name: str) -> bool: ...

    def row_count(self, name: str) -> int | None: ...


# Columns of each customer level and each store level.
CUSTOMER_LEVELS = {
    "none": (),
    "customer_info": ("customer_key", "customer_type"),
    "customer_loc": ("customer_key", "state", "city"),
    "customer_type": ("customer_type",),
    "city": ("state", "city"),
    "state": ("state",),
}
STORE_LEVELS = {
    "none": (),
    "store": ("store_key", "city", "state"),
    "city": ("state", "city"),
    "state": ("state",),
}
TIME_LEVELS = ("none", "month", "quarter", "year")


@dataclass(frozen=True)
class Cuboid:
    """One aggregate: a time level, with or without product, and a customer or store level."""

    cube: str
    time: str
    product: bool
    place: str

    @property
    def dimensions(self) -> tuple[str, ...]:
        places = CUSTOMER_LEVELS if self.cube == "sales" else STORE_LEVELS
        product = ("product_key",) if self.product else ()
        return TIME_COLUMNS[self.time] + product + places[self.place]

    @property
    def measures(self) -> tuple[str, ...]:
        return tuple(MEASURES[self.cube])

    @property
    def name(self) -> str:
        prefix = "olap_sales" if self.cube == "sales" else "olap_inv"
        has_key = self.place in ("customer_info", "customer_loc", "store")
        if not self.dimensions:
            return f"{prefix}_all"
        if has_key and self.product and self.time == "month":
            return f"{prefix}_base" + self.place.removeprefix("customer").removeprefix("store")
        if has_key and self.product and self.time == "none" and self.cube == "sales":
            return f"{prefix}_customer_product_{self.place.removeprefix('customer_')}"
        # Month-level tables without a coarse place level are named "time".
        month = "time" if has_key or self.place == "none" else "month"
        parts = [month if self.time == "month" else self.time] if self.time != "none" else []
        parts += ["product"] if self.product else []
        parts += [self.place] if self.place != "none" else []
        return f"{prefix}_by_{parts[0]}" if len(parts) == 1 else f"{prefix}_{'_'.join(parts)}"

    @property
    def dimension_tables(self) -> frozenset[str]:
        """Which dimensions the aggregate joins; rows without a match are left out."""
        if self.cube == "inventory":
            return frozenset({"dim_time", "dim_store", "dim_location"})
        joined = {"dim_time"} if self.time != "none" else set()
        if self.place != "none":
            joined.add("dim_customer")
        if {"state", "city"} & set(self.dimensions):
            joined.add("dim_location")
        return frozenset(joined)

    @property
    def is_detail(self) -> bool:
        """True for the large aggregates, keyed by product and by customer or store."""
        return self.product and bool({"customer_key", "store_key"} & set(self.dimensions))


def lattice(cube: str) -> dict[str, Cuboid]:
    places = CUSTOMER_LEVELS if cube == "sales" else STORE_LEVELS
    cuboids = [
        Cuboid(cube, time, product, place)
        for time in TIME_LEVELS
        for product in (False, True)
        for place in places
    ]
    return {c.name: c for c in cuboids}


LATTICES = {"sales": lattice("sales"), "inventory": lattice("inventory")}
CUBOIDS = {**LATTICES["sales"], **LATTICES["inventory"]}


# --- shared steps -----------------------------------------------------------

# Rows that one task sums where nearly every row is a group of its own.
PART_ROWS = 1_000_000


def spread(rows: DataFrame, keys: Iterable[str], count: int | None) -> DataFrame:
    """Rows shuffled by `keys`; of a table that is known to be large, so that no task gets more than its part."""
    if count is None or count <= PART_ROWS:
        return rows.repartition(*keys)
    return rows.repartition(math.ceil(count / PART_ROWS), *keys)


def sums(df: DataFrame, group: Iterable[str], measures: Iterable[str]) -> DataFrame:
    return df.groupBy(*group).agg(*[total(m) for m in measures])


def with_time(fact: DataFrame, star: Star, columns: Iterable[str]) -> DataFrame:
    """Attach time columns; dim_time has one row per calendar month, so broadcasting it is bounded."""
    months = star.table("dim_time").select("time_key", *columns)
    return fact.join(F.broadcast(months), "time_key")


def customer_attributes(star: Star, attributes: Iterable[str]) -> DataFrame:
    attributes = tuple(attributes)
    customers = star.table("dim_customer")
    if {"state", "city"} & set(attributes):
        customers = customers.join(located(star), "location_key")
    return customers.select("customer_key", *attributes)


def store_attributes(star: Star, attributes: Iterable[str]) -> DataFrame:
    """Stores that have a location, with some of its columns."""
    return star.table("dim_store").join(located(star), "location_key").select("store_key", *attributes)


def located(star: Star) -> DataFrame:
    """Locations, broadcast when they were counted and are few."""
    locations = star.table("dim_location").select("location_key", "city", "state")
    return F.broadcast(locations) if star.is_small("dim_location") else locations


# --- sales ------------------------------------------------------------------


def sales_rollup(star: Star, columns: Iterable[str]) -> DataFrame:
    """Sales summed by any set of time, product and customer columns.

    With few customers their attributes are broadcast onto the fact and one
    aggregation finishes the job. Otherwise the fact is summed per customer
    key first, so that the shuffle to the customer table carries one row per
    group and a customer with very many sales is already folded together.
    By product that folds next to nothing: then the fact itself meets the
    customers, whose hot keys adaptive skew handling splits, or, where product
    and customer stay, is summed behind its shuffle, because a task that sums
    its part of the files before would hold a row for each of theirs.
    """
    columns = tuple(columns)
    measures = tuple(MEASURES["sales"])
    time = [c for c in ALL_TIME_COLUMNS if c in columns]
    attributes = [c for c in ("customer_type", "state", "city") if c in columns]

    sales = star.table("fact_sales").withColumnsRenamed(
        {"quantity_ordered": "total_quantity", "total_amount": "sum_amount"}
    )
    if time:
        sales = with_time(sales, star, time)
    if not attributes:
        return sums(sales, columns, measures)

    customers = customer_attributes(star, attributes)
    one_row_per_group = {*ALL_TIME_COLUMNS, "product_key", "customer_key"} <= set(columns)
    keys = [c for c in columns if c not in attributes and c != "customer_key"] + ["customer_key"]
    if star.is_small("dim_customer"):
        joined = sales.join(F.broadcast(customers), "customer_key")
    else:
        if one_row_per_group or ("product_key" in columns and "customer_key" not in columns):
            per_customer = sales
        elif "product_key" in columns:
            per_customer = sums(spread(sales, ("product_key", "customer_key"), star.row_count("fact_sales")), keys, measures)
        else:
            per_customer = sums(sales, keys, measures)
        joined = per_customer.join(customers, "customer_key")
        if "customer_key" in columns:
            one_row_per_group = True
    if one_row_per_group:
        return joined.select(*columns, *[F.col(m).cast(t).alias(m) for m, t in MEASURES["sales"].items()])
    return sums(joined, columns, measures)


# --- inventory --------------------------------------------------------------


def latest_stock(
    stock: DataFrame,
    time: Iterable[str],
    quantity: str,
    order: str,
    place: Iterable[str] = (),
    count: int | None = None,
    *,
    in_place: bool = False,
) -> DataFrame:
    """The newest quantity of each product and store inside each time group.

    Rows are shuffled by product and store first: a pair has at most a row a month,
    and a task that folded its part of the files before would hold a row for nearly
    each of theirs. `place` columns depend on the store and only ride along; `count` is the most rows there are.
    Rows `in_place` already lie together by product.
    """
    rows = stock if in_place else spread(stock, ("product_key", "store_key"), count)
    return rows.groupBy("product_key", "store_key", *place, *time).agg(
        F.max_by(quantity, order).cast(QUANTITY_TOTAL).alias("total_quantity_on_hand")
    )


def inventory_rollup(star: Star, columns: Iterable[str]) -> DataFrame:
    """Latest stock summed by any set of time, product and store columns.

    The snapshot is taken on keys alone and the place of each store is looked
    up afterwards. With too many stores to broadcast, quantities are summed
    per store first where that shrinks them; a store that still holds very
    many rows is split by adaptive skew-join handling.
    """
    columns = tuple(columns)
    measures = tuple(MEASURES["inventory"])
    time = [c for c in ALL_TIME_COLUMNS if c in columns]
    place = [c for c in ("city", "state") if c in columns]

    stock = with_time(star.table("fact_inventory"), star, time)
    if set(time) == set(ALL_TIME_COLUMNS):
        # The fact has one row per month, store and product: every row is the latest of its month.
        latest = stock.withColumn("total_quantity_on_hand", F.col("quantity_on_hand").cast(QUANTITY_TOTAL))
    else:
        latest = latest_stock(stock, time, "quantity_on_hand", "time_key", count=star.row_count("fact_inventory"))

    stores = store_attributes(star, place)
    one_row_per_group = {"product_key", "store_key"} <= set(columns)
    if star.is_small("dim_store"):
        stores = F.broadcast(stores)
    elif "product_key" not in columns:
        latest = sums(latest, [c for c in columns if c not in (*place, "store_key")] + ["store_key"], measures)
        one_row_per_group = "store_key" in columns
    # Without place columns the join only leaves out stock of unknown stores.
    known = latest.join(stores, "store_key", "inner" if place else "left_semi")
    return known.select(*columns, *measures) if one_row_per_group else sums(known, columns, measures)


def build(star: Star, cuboid: Cuboid) -> DataFrame:
    """One cuboid from the fact."""
    rollup = sales_rollup if cuboid.cube == "sales" else inventory_rollup
    return rollup(star, cuboid.dimensions)


# --- the sales cuboids without a parent, from one scan ------------------------

FACT_KEYS = ("time_key", "product_key", "customer_key")


def sales_roots() -> list[Cuboid]:
    """The sales cuboids that no other can be summed into; together they use four groupings of the fact's keys."""
    return [c for c in LATTICES["sales"].values() if not parents(c)]


def _fact_keys(cuboid: Cuboid) -> tuple[str, ...]:
    kept = (cuboid.time != "none", cuboid.product, cuboid.place != "none")
    return tuple(key for key, wanted in zip(FACT_KEYS, kept) if wanted)


def sales_roots_from_one_scan(star: Star) -> DataFrame:
    """The rows of all `sales_roots`, the name of each in the column `cuboid`; the fact is read once.

    Grouping sets sum the fact by its own keys, so the shuffle carries no attributes.
    These are looked up once the rows are summed, and a row goes to the cuboids of its
    grouping whose dimensions know it. Columns that a cuboid lacks are null.
    """
    measures = tuple(MEASURES["sales"])
    roots = sales_roots()
    sales = star.table("fact_sales").withColumnsRenamed(
        {"quantity_ordered": "total_quantity", "total_amount": "sum_amount"}
    )
    groupings = [[F.col(key) for key in keys] for keys in sorted({_fact_keys(c) for c in roots})]
    summed = sales.groupingSets(groupings, *FACT_KEYS).agg(
        *[total(m) for m in measures], F.grouping_id().alias("left_out")
    )
    there = F.lit(True)
    months = star.table("dim_time").select("time_key", *ALL_TIME_COLUMNS, there.alias("in_dim_time"))
    people = (
        star.table("dim_customer")
        .select(F.col("customer_key").alias("known_customer"), "customer_type", "location_key", there.alias("in_dim_customer"))
        .join(located(star).withColumn("in_dim_location", there), "location_key", "left")
    )
    # Rows summed over customers, and those without one, look for none; by a number of their own they are not one hot key.
    spread = F.coalesce("customer_key", F.xxhash64("time_key", "product_key"))
    same = (spread == F.col("known_customer")) & F.col("customer_key").isNotNull()
    people = F.broadcast(people) if star.is_small("dim_customer") else people
    known = summed.join(F.broadcast(months), "time_key", "left").join(people, same, "left")

    def belongs(cuboid: Cuboid) -> Column:
        keys = _fact_keys(cuboid)
        left_out = sum(1 << place for place, key in enumerate(reversed(FACT_KEYS)) if key not in keys)
        tests = [F.col("left_out") == left_out]
        tests += [F.col(f"in_{table}").isNotNull() for table in sorted(cuboid.dimension_tables)]
        return reduce(Column.__and__, tests)

    names = F.array_compact(F.array(*[F.when(belongs(c), F.lit(c.name)) for c in roots]))
    sent = known.select(*ALL_TIME_COLUMNS, "product_key", "customer_key", "customer_type", "state", "city", *measures, F.explode(names).alias("cuboid"))
    # Looking up brings more attributes than a cuboid has.
    extra = {
        column: F.when(F.col("cuboid").isin([c.name for c in roots if column in c.dimensions]), F.col(column))
        for column in ("customer_type", "state", "city")
    }
    return sent.withColumns(extra)


# --- buckets of a refresh -----------------------------------------------------

# Columns by which the rows of all sales are known to the dimensions.
KNOWN = {"dim_time": "in_dim_time", "dim_customer": "in_dim_customer", "dim_location": "in_dim_location"}
OF_CUSTOMER = ("customer_type", "state", "city", KNOWN["dim_customer"], KNOWN["dim_location"])


# What rides along in the buckets of a cuboid by customer and type: a customer has one of each.
RIDING = ("state", "city", KNOWN["dim_location"])

# Stock by store without product is small.
CUBE_BUCKETS = {"sales": ("customer_key", "product_key"), "inventory": ("product_key",)}

# Read from the fact: in its files, which have few months each, the products of a store fold before the shuffle; a bucket has few of them.
FROM_MONTHS = "olap_inv_time_store"

# The latest stock of all time is the latest of these.
ALL_TIME_STOCK, YEARLY_STOCK = "olap_inv_product_store", "olap_inv_year_product_store"


def bucket_key(cuboid: Cuboid) -> str | None:
    """The column by which a large cuboid lies in buckets, so that the next is summed from it without a shuffle."""
    if "customer_key" in cuboid.dimensions:
        return "customer_key"
    return "product_key" if cuboid.product else None


def twin(cuboid: Cuboid) -> Cuboid | None:
    """For a cuboid by customer and place the one by customer and type: it has the same groups and those without a place."""
    if cuboid.place != "customer_loc":
        return None
    return Cuboid(cuboid.cube, cuboid.time, cuboid.product, "customer_info")


def riding(cuboid: Cuboid, rows: DataFrame) -> tuple[str, ...]:
    """The columns of `rows` that ride along in the buckets of `cuboid`."""
    return RIDING if cuboid.place == "customer_info" and set(RIDING) <= set(rows.columns) else ()


def bucket_count(count: int | None, parallelism: int) -> int:
    """Buckets of at most about `PART_ROWS` rows; of fewer where there would be less buckets than cores."""
    rows = min(PART_ROWS, max(PART_ROWS // 20, (count or 0) // max(parallelism, 1)))
    return max(1, math.ceil((count or 0) / rows))


def dividing(buckets: int, parts: int) -> int:
    """As many buckets, or up to twice as many so that they divide the larger number of parts a shuffle may take.

    A part then has rows of one bucket, because both are the hash of the key modulo their number.
    """
    return next((n for n in range(buckets, min(parts, 2 * buckets) + 1) if parts % n == 0), buckets)


def sales_with_attributes(star: Star, buckets: int) -> DataFrame:
    """All sales with what the dimensions know of their customers, in one shuffle by customer.

    Only for dimensions whose keys are unique: then any sales cuboid is a filter and a sum of these rows.
    """
    sales = star.table("fact_sales").withColumnsRenamed(
        {"quantity_ordered": "total_quantity", "total_amount": "sum_amount"}
    )
    there = F.lit(True)
    people = (
        star.table("dim_customer")
        .select("customer_key", "customer_type", "location_key", there.alias(KNOWN["dim_customer"]))
        .join(located(star).withColumn(KNOWN["dim_location"], there), "location_key", "left")
    )
    # Cut like the facts, so that the join adds no shuffle; it may take more parts (`dividing`).
    people = F.broadcast(people) if star.is_small("dim_customer") else people.repartition(buckets, "customer_key")
    placed = sales.repartition(buckets, "customer_key").join(people, "customer_key", "left")
    return placed.select(*FACT_KEYS, *OF_CUSTOMER, *MEASURES["sales"])


def stock_by_product(star: Star, buckets: int) -> DataFrame:
    """The finest stock cuboid, in one shuffle by product.

    What is few enough to broadcast is attached behind it: then stock moves by its keys alone, and
    where stores are many with the key of their location.
    """
    cuboid = CUBOIDS["olap_inv_base"]
    stock = star.table("fact_inventory").select("time_key", "product_key", "store_key", "quantity_on_hand")
    few_places = star.is_small("dim_location")
    if few_places and star.is_small("dim_store"):
        moved = stock.repartition(buckets, "product_key")
        placed = moved.join(F.broadcast(store_attributes(star, ("city", "state"))), "store_key")
    elif few_places:
        stores = star.table("dim_store").select("store_key", "location_key")
        placed = stock.join(stores, "store_key").repartition(buckets, "product_key").join(located(star), "location_key")
    else:
        stores = store_attributes(star, ("city", "state"))
        placed = stock.join(stores, "store_key").repartition(buckets, "product_key")
    rows = with_time(placed, star, ALL_TIME_COLUMNS)
    held = F.col("quantity_on_hand").cast(QUANTITY_TOTAL).alias("total_quantity_on_hand")
    return rows.select(*cuboid.dimensions, held)


def stock_by_store(star: Star) -> DataFrame:
    """Stock by month and store, from the fact; a store that stands twice in its dimension is one row of both."""
    cuboid = CUBOIDS[FROM_MONTHS]
    return sums(build(star, cuboid), cuboid.dimensions, cuboid.measures)


def sales_by_product(star: Star, sales: DataFrame, buckets: int) -> DataFrame:
    """Rows of `sales_with_attributes` with their months, summed over customers, in one shuffle by product."""
    measures = tuple(MEASURES["sales"])
    moved = sales.select("time_key", "product_key", *OF_CUSTOMER, *measures).repartition(buckets, "product_key")
    months = star.table("dim_time").select("time_key", *ALL_TIME_COLUMNS, F.lit(True).alias(KNOWN["dim_time"]))
    rows = moved.join(F.broadcast(months), "time_key", "left")
    return sums(rows, (*ALL_TIME_COLUMNS, KNOWN["dim_time"], "product_key", *OF_CUSTOMER), measures)


def of_years(rows: DataFrame, years: Iterable[int]) -> DataFrame:
    """The rows of some years, by their year or else their month's key."""
    year = F.col("year") if "year" in rows.columns else F.expr("time_key div 100")
    return rows.where(year.isin(list(years)))


def known_sums(star: Star, rows: DataFrame, cuboid: Cuboid) -> DataFrame:
    """A sales cuboid from all sales, by customer or by product: of those that its dimensions know.

    The fact has one row per month, product and customer, so with these there is nothing to sum.
    """
    known = {table for table in cuboid.dimension_tables if KNOWN[table] in rows.columns}
    for table in sorted(known):
        rows = rows.where(KNOWN[table])
    if "dim_time" in cuboid.dimension_tables - known:
        rows = with_time(rows, star, TIME_COLUMNS[cuboid.time])
    columns = (*cuboid.dimensions, *riding(cuboid, rows))
    if {*ALL_TIME_COLUMNS, "product_key", "customer_key"} <= set(columns):
        return rows.select(*columns, *[F.col(m).cast(t).alias(m) for m, t in MEASURES["sales"].items()])
    return sums(rows, columns, cuboid.measures)


# --- building one cuboid from another ---------------------------------------


def parents(cuboid: Cuboid) -> list[Cuboid]:
    """Finer cuboids this one can be summed from, smallest first.

    A parent must join the same dimensions, because facts without a match are
    left out per cuboid. A stock parent must also have the same time grain;
    the product-and-store cuboid of each grain comes from the monthly one.
    """
    wanted = set(cuboid.dimensions)
    finer = [
        c
        for c in LATTICES[cuboid.cube].values()
        if wanted < set(c.dimensions) and c.dimension_tables == cuboid.dimension_tables
    ]
    if cuboid.cube == "inventory":
        finer = [c for c in finer if c.time == cuboid.time]
        if not finer and cuboid.time != "month":
            finer = [CUBOIDS["olap_inv_base"]]
    return sorted(finer, key=lambda c: (len(c.dimensions), c.name))


def build_from(
    parent: Cuboid, rows: DataFrame, cuboid: Cuboid, count: int | None = None, *, in_buckets: bool = False
) -> DataFrame:
    """`cuboid` from the rows, at most `count`, of one of its parents; rows that lie in buckets are not shuffled.

    From its twin in buckets a cuboid is a selection of rows and columns.
    """
    if cuboid.cube == "inventory" and cuboid.time != parent.time:
        period = rows.withColumn("period", F.col("year") * 100 + F.col("month"))
        time = TIME_COLUMNS[cuboid.time]
        rows = latest_stock(
            period, time, "total_quantity_on_hand", "period", ("city", "state"), count, in_place=in_buckets
        )
        return rows.select(*cuboid.dimensions, *cuboid.measures)
    if parent == twin(cuboid):
        return rows.where(KNOWN["dim_location"]).select(*cuboid.dimensions, *cuboid.measures)
    return sums(rows, (*cuboid.dimensions, *riding(cuboid, rows)), cuboid.measures)


def smallest_parents(cuboid: Cuboid) -> list[Cuboid]:
    """Its parents with the fewest columns; which has the fewest rows is known once they are written."""
    found = parents(cuboid)
    return [p for p in found if len(p.dimensions) == len(found[0].dimensions)]


def bucket_parents(cuboid: Cuboid) -> list[Cuboid]:
    """Its twin, or its parents with the fewest columns among those that lie in the same buckets; of a small cuboid, among all.

    Without any, it is read from the fact.
    """
    key, other = bucket_key(cuboid), twin(cuboid)
    if other is not None:
        return [other]
    if cuboid.name == FROM_MONTHS:
        return []
    found = [p for p in parents(cuboid) if key is None or bucket_key(p) == key]
    return [p for p in found if len(p.dimensions) == len(found[0].dimensions)]


def year_parents(cuboid: Cuboid) -> list[Cuboid]:
    """As `bucket_parents` where only some years are summed: then stock of all time comes from the yearly snapshots of all."""
    return [CUBOIDS[YEARLY_STOCK]] if cuboid.name == ALL_TIME_STOCK else bucket_parents(cuboid)


def refresh_order(cube: str, of: Callable[[Cuboid], list[Cuboid]] = smallest_parents) -> list[Cuboid]:
    """The cuboids of a cube, each after the parents it may be summed from."""
    waiting = list(LATTICES[cube].values())
    done: set[str] = set()
    order: list[Cuboid] = []
    while waiting:
        ready = [c for c in waiting if all(p.name in done for p in of(c))]
        order += sorted(ready, key=lambda c: (-len(c.dimensions), c.name))
        done |= {c.name for c in ready}
        waiting = [c for c in waiting if c.name not in done]
    return order


def refresh_levels(cube: str) -> list[list[Cuboid]]:
    """The cuboids of a cube in levels; every parent of a cuboid, and the yearly snapshot, is in an earlier one."""
    needed = {c.name: {p.name for p in parents(c)} for c in LATTICES[cube].values()}
    if cube == "inventory":
        needed[ALL_TIME_STOCK].add(YEARLY_STOCK)
    done: set[str] = set()
    levels = []
    while len(done) < len(needed):
        level = [c for c in LATTICES[cube].values() if c.name not in done and needed[c.name] <= done]
        levels.append(level)
        done |= {c.name for c in level}
    return levels
