"""Conforming, dimension and fact builders, calendar arithmetic and predicates."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starlattice.functions.periods import next_period
from starlattice.functions.predicates import active_filters, equals_all, key_contains, key_contains_nocase
from starlattice.operators import star
from starlattice.operators.conform import conform
from starlattice.schemas import SOURCE_SCHEMAS

DAY = dt.date(2024, 3, 1)


def test_conform_cleans_renames_and_filters(spark):
    rows = [
        (1, "  Blue chair ", "xl", Decimal("1.25"), Decimal("9.99"), DAY),
        (2, "Red chair", "Freesize", Decimal("2.00"), Decimal("5.00"), dt.date(2024, 2, 28)),
    ]
    products = spark.createDataFrame(rows, SOURCE_SCHEMAS["product"])
    everything = conform(products, "product").orderBy("product_id").collect()
    assert everything[0] == (1, "Blue chair", "XL", Decimal("1.25"), Decimal("9.99"), DAY)
    assert everything[1]["size"] == "FREESIZE"
    # The mark itself counts as changed.
    assert [r["product_id"] for r in conform(products, "product", DAY).collect()] == [1]
    assert "last_updated_time" in conform(products, "product").columns


def test_customer_types(spark):
    customers = spark.createDataFrame(
        [(i, f"P{i}", 1, DAY) for i in range(4)], "customer_id int, customer_name string, city_id int, first_order_date date"
    )
    def members(ids, day=DAY):
        return spark.createDataFrame([(i, day) for i in ids], "customer_id int, last_updated_time date")
    built = star.dim_customer(customers, members([0, 2]), members([1, 2])).orderBy("customer_key")
    assert [r["customer_type"] for r in built.collect()] == ["Tourist", "MailOrder", "Both", "Unknown"]
    # Only rows newer than the mark; a late subtype row brings its customer back.
    late = star.dim_customer(customers, members([0]), members([3], dt.date(2024, 5, 1)), DAY)
    assert [(r["customer_key"], r["customer_type"]) for r in late.collect()] == [(3, "MailOrder")]


def test_dim_time_always_has_the_current_month(spark):
    orders = spark.createDataFrame(
        [(1, 1, dt.date(2024, 1, 5)), (2, 1, dt.date(2024, 1, 9)), (3, 2, dt.date(2023, 12, 31))],
        SOURCE_SCHEMAS["order"],
    )
    months = star.dim_time(orders, dt.date(2024, 6, 15)).orderBy("time_key").collect()
    assert [tuple(m) for m in months] == [(202312, 12, 4, 2023), (202401, 1, 1, 2024), (202406, 6, 2, 2024)]
    newer = star.dim_time(orders, dt.date(2024, 1, 15), dt.date(2024, 1, 9))
    assert [m["time_key"] for m in newer.collect()] == [202401]


def test_stores_without_an_office_are_left_out(spark):
    stores = spark.createDataFrame([(1, "5", DAY, 1), (2, "6", DAY, 7)], "store_id int, phone_number string, last_updated_time date, city_id int")
    offices = spark.createDataFrame([(1, "A", "B", "C", DAY)], "city_id int, city_name string, office_address string, state string, last_updated_time date")
    assert star.dim_store(stores, offices).collect() == [(1, "5", 1)]
    assert star.dim_location(offices).collect() == [(1, "A", "C", "B")]


def test_fact_sales_multiplies_and_sums(spark):
    orders = spark.createDataFrame(
        [(1, 7, dt.date(2024, 1, 5)), (2, 7, dt.date(2024, 1, 30)), (3, 8, dt.date(2024, 2, 1))], SOURCE_SCHEMAS["order"]
    )
    lines = spark.createDataFrame(
        [(1, 5, 2, Decimal("10.50"), DAY), (2, 5, 3, Decimal("10.00"), DAY), (3, 5, 1, Decimal("1.00"), DAY), (9, 5, 1, Decimal("1.00"), DAY)],
        SOURCE_SCHEMAS["order_product"].replace("time date", "last_updated_time date"),
    )
    rows = {tuple(r[:3]): tuple(r[3:]) for r in star.fact_sales(lines, orders).collect()}
    assert rows == {(202401, 5, 7): (5, Decimal("51.00")), (202402, 5, 8): (1, Decimal("1.00"))}


def test_fact_inventory_has_one_month(spark):
    stock = spark.createDataFrame(
        [(1, 1, 5, dt.date(2024, 1, 31)), (1, 2, 6, dt.date(2024, 3, 1)), (2, 1, 7, dt.date(2023, 2, 1))],
        "store_id int, product_id int, stock_quantity int, last_updated_time date",
    )
    assert {tuple(r) for r in star.fact_inventory(stock).collect()} == {
        (202403, 1, 1, 5), (202403, 1, 2, 6), (202403, 2, 1, 7),
    }


@pytest.mark.parametrize(
    "now, following",
    [
        ((2024, 4, 12), (2025, 1, 1)),
        ((2024, 1, 3), (2024, 2, 4)),
        ((2024, 4, None), (2025, 1, None)),
        ((2024, 2, None), (2024, 3, None)),
        ((2024, None, None), (2025, None, None)),
        ((None, 1, 3), (None, 2, 4)),
        ((None, 4, 12), (None, 1, 1)),
        ((None, 4, None), (None, 1, None)),
    ],
)
def test_next_period(now, following):
    assert tuple(next_period(*now).values()) == following


def test_filters_skip_only_what_means_nothing(spark):
    filters = {"year": "2024", "state": "All", "city": "", "product_key": 0, "customer_type": None}
    assert active_filters(filters) == {"year": 2024, "product_key": 0}
    rows = spark.createDataFrame([(2024, 0), (2024, 1), (2023, 0)], "year int, product_key int")
    assert rows.where(equals_all(filters)).collect() == [(2024, 0)]
    assert rows.where(equals_all({})).count() == 3


def test_key_search_keeps_like_wildcards(spark):
    keys = spark.createDataFrame([(1,), (12,), (212,), (102,)], "k int")
    assert {r.k for r in keys.where(key_contains("k", "12")).collect()} == {12, 212}
    assert {r.k for r in keys.where(key_contains("k", "1_2")).collect()} == {102}
    assert {r.k for r in keys.where(key_contains_nocase("k", "%")).collect()} == {1, 12, 212, 102}
    text = spark.createDataFrame([("aB",), ("c",)], "k string")
    assert [r.k for r in text.where(key_contains_nocase("k", "Ab")).collect()] == ["aB"]


def test_time_parts_of_a_key(spark):
    keys = spark.range(1, 13).select((F.lit(202400) + F.col("id")).cast("int").alias("time_key"))
    rows = star.calendar_months(keys.union(keys)).orderBy("time_key").collect()
    assert [r["quarter"] for r in rows] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]


def test_large_months_have_slots_of_their_own():
    sizes = {202401: 10, 202402: 20, 202403: star.SLOT_ROWS * 5 // 2, 202404: 7, None: 1}
    assert star.slots_of(sizes, 1) == {202401: (0, 1), 202402: (0, 1), 202403: (1, 3), 202404: (4, 1), None: (4, 1)}


@pytest.mark.parametrize("sizes", [{}, {202401: 1}, {202401: 4 * star.SLOT_ROWS, 202402: 3, None: 2}])
def test_facts_in_slots_are_the_same_facts(spark, sizes):
    """A month of several slots, one that was not foreseen, and rows without a month."""
    lines = spark.range(400).selectExpr(
        "id % 90 order_id", "id % 7 product_id", "cast(id % 5 as int) ordered_quantity",
        "cast(id as decimal(15,2)) line_amount", "date'2024-01-05' last_updated_time",
    )
    orders = spark.range(80).selectExpr("id order_id", "id % 6 customer_id", "add_months(date'2024-01-02', cast(id % 3 as int)) order_date")
    rows = star.fact_sales(lines, orders, sizes=sizes)
    assert sorted(map(str, rows.collect())) == sorted(map(str, star.fact_sales(lines, orders).collect()))
    stock = spark.range(500).selectExpr(
        "id % 4 store_id", "id % 9 product_id", "cast(id % 5 as int) stock_quantity",
        "if(id % 50 = 0, null, add_months(date'2024-01-02', cast(id % 3 as int))) last_updated_time",
    )
    rows = star.fact_inventory_by_month(stock, sizes)
    assert sorted(map(str, rows.collect())) == sorted(map(str, star.fact_inventory_by_month(stock).collect()))


def test_facts_in_slots_shuffle_once_behind_the_join(spark):
    stock = spark.range(10).selectExpr("id store_id", "id product_id", "1 stock_quantity", "date'2024-01-02' last_updated_time")
    rows = star.fact_inventory_by_month(stock, {202401: 3 * star.SLOT_ROWS})
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_months_of_sales_without_the_fact(spark):
    """The first and last order of February have no lines, another one has; no order of March has any."""
    days = ["2024-01-01", "2024-02-01", "2024-02-02", "2024-02-03", "2024-03-01"]
    orders = spark.createDataFrame([(i, i, dt.date.fromisoformat(d)) for i, d in enumerate(days)], "order_id long, customer_id long, order_date date")
    lines = spark.createDataFrame([(0, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1))], "order_id long, last_updated_time date")
    assert sorted(r["time_key"] for r in star.sold_months(lines, orders).collect()) == [202401, 202402]
    assert star.sold_months(lines.limit(0), orders).count() == 0
