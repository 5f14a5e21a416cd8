from __future__ import annotations

import datetime as dt
import os
import random
import sys
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starlattice.sources.warehouse import Warehouse  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='starlattice-tests-')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class MiniStar:
    """A small star with hot keys, gaps and facts whose dimension rows are missing."""

    SCHEMAS = {
        "dim_time": "time_key int, month int, quarter int, year int",
        "dim_location": "location_key int, city string, state string, office_address string",
        "dim_store": "store_key bigint, phone_number string, location_key int",
        "dim_customer": "customer_key bigint, customer_name string, customer_type string, "
        "first_order_date date, location_key int",
        "dim_product": "product_key bigint, description string, size string, weight decimal(10,2)",
        "fact_sales": "time_key int, product_key bigint, customer_key bigint, quantity_ordered bigint, "
        "total_amount decimal(15,2)",
        "fact_inventory": "time_key int, store_key bigint, product_key bigint, quantity_on_hand bigint",
    }

    def __init__(self, seed: int = 5):
        pick = random.Random(seed)
        months = [(y, m) for y in (2023, 2024) for m in range(1, 13)]
        keys = [y * 100 + m for y, m in months]
        # The last month has facts but no calendar row.
        self.dim_time = [(y * 100 + m, m, (m + 2) // 3, y) for y, m in months[:-1]]
        # The same city name in two states.
        places = [("Springfield", "Ohio"), ("Springfield", "Texas"), ("Austin", "Texas"), ("Salem", "Oregon")]
        self.dim_location = [(i, city, state, f"{i} Main St") for i, (city, state) in enumerate(places)]
        self.dim_store = [(s, f"555-{s}", s % 6 if s % 6 < 4 else 9) for s in range(8)]
        kinds = ("Tourist", "MailOrder", "Both", "Unknown")
        self.dim_customer = [
            (c, f"Person {c}", kinds[c % 4], dt.date(2023, 1 + c % 12, 1), c % 5 if c % 5 < 4 else 9)
            for c in range(12)
        ]
        self.dim_product = [(p, f"Thing {chr(110 - p)}", "M", Decimal("1.50")) for p in range(10)]
        sales, stock = {}, {}
        for _ in range(900):
            # Customer 3 and store 2 hold a third of all rows; 12-13 and 8 are unknown.
            customer = 3 if pick.random() < 0.34 else pick.randrange(14)
            store = 2 if pick.random() < 0.34 else pick.randrange(9)
            key = (pick.choice(keys), pick.randrange(10), customer)
            sales[key] = (pick.randrange(1, 9), Decimal(pick.randrange(100, 99999)) / 100)
            key = (pick.choice(keys), store, pick.randrange(10))
            stock[key] = pick.randrange(0, 60)
        self.fact_sales = [(*k, *v) for k, v in sorted(sales.items())]
        self.fact_inventory = [(*k, v) for k, v in sorted(stock.items())]

    def builders(self, spark):
        def rows(name):
            return lambda _: spark.createDataFrame(getattr(self, name), self.SCHEMAS[name])

        return {name: rows(name) for name in self.SCHEMAS}

    def joined_sales(self):
        """Sales rows as dictionaries with every attribute, None where a dimension row is missing."""
        times = {t[0]: t for t in self.dim_time}
        people = {c[0]: c for c in self.dim_customer}
        places = {p[0]: p for p in self.dim_location}
        for time_key, product, customer, quantity, amount in self.fact_sales:
            time, person = times.get(time_key), people.get(customer)
            place = places.get(person[4]) if person else None
            yield {
                "time_key": time_key,
                "year": time and time[3],
                "quarter": time and time[2],
                "month": time and time[1],
                "product_key": product,
                "customer_key": customer,
                "customer_type": person and person[2],
                "state": place and place[2],
                "city": place and place[1],
                "known": {"dim_time": bool(time), "dim_customer": bool(person), "dim_location": bool(place)},
                "quantity": quantity,
                "amount": amount,
            }

    def joined_stock(self):
        """Stock rows whose month, store and location all exist."""
        times = {t[0]: t for t in self.dim_time}
        stores = {s[0]: s for s in self.dim_store}
        places = {p[0]: p for p in self.dim_location}
        for time_key, store, product, held in self.fact_inventory:
            if time_key not in times or store not in stores or stores[store][2] not in places:
                continue
            time, place = times[time_key], places[stores[store][2]]
            yield {
                "time_key": time_key,
                "year": time[3],
                "quarter": time[2],
                "month": time[1],
                "product_key": product,
                "store_key": store,
                "state": place[2],
                "city": place[1],
                "held": held,
            }


@pytest.fixture(scope="session")
def mini():
    return MiniStar()


@pytest.fixture(scope="session")
def wh(spark, mini, tmp_path_factory):
    """The small star, stored, with dimensions that count as small."""
    root = str(tmp_path_factory.mktemp("small"))
    return Warehouse(spark, mini.builders(spark), root, partition_by={"fact_sales": "time_key"})


@pytest.fixture(scope="session")
def wide_wh(spark, mini, tmp_path_factory):
    """The same star with every dimension counted as too large to broadcast."""
    root = str(tmp_path_factory.mktemp("wide"))
    return Warehouse(spark, mini.builders(spark), root, broadcast_rows=0)
