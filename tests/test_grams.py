"""Searches by grams against plain matching, and what they read."""

from __future__ import annotations

import random
import re
from decimal import Decimal

import pytest

from conftest import MiniStar
from starlattice.operators import filters, grams
from starlattice.sources.warehouse import Warehouse


class LongKeys(MiniStar):
    """The small star with keys of one to nine digits, some of one repeated digit, one negative."""

    def __init__(self):
        super().__init__()
        pick = random.Random(8)
        keys = [pick.randrange(10 ** pick.randint(1, 9)) for _ in range(300)] + [111, 1111111, 101010101, -4321]
        self.customers, self.stores, self.products = sorted({*keys}), sorted({k + 7 for k in keys}), sorted({k * 3 for k in keys})
        kinds = ("Tourist", "MailOrder")
        self.dim_customer = [(c, None, kinds[i % 2], None, i % 5 if i % 5 < 4 else 9) for i, c in enumerate(self.customers)]
        self.dim_store = [(s, None, i % 4) for i, s in enumerate(self.stores)]
        month = self.dim_time[0][0]
        people = [*self.customers, None, 5_555_555_555]
        self.fact_sales = [(month, pick.choice(self.products), c, 1, Decimal(1)) for c in people]
        self.fact_sales += [(month, p, self.customers[0], 1, Decimal(1)) for p in self.products]
        self.fact_inventory = [(month, s, 1, 1) for s in self.stores]


@pytest.fixture(scope="module", params=[True, False])
def long_wh(request, spark, tmp_path_factory):
    star = LongKeys()
    bound = 100_000 if request.param else 0
    return star, Warehouse(spark, star.builders(spark), str(tmp_path_factory.mktemp("grams")), broadcast_rows=bound)


TEXTS = ("111", "1111", "101", "0101", "432", "-43", "1%101", "12%3", "999_", "x12", "12", "", "%", "1\\%1", "٣٣٣")


def like(text: str):
    pattern = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in text)
    return re.compile(f".*{pattern}.*", re.DOTALL)


@pytest.mark.parametrize("text", TEXTS)
def test_found_keys(long_wh, text):
    star, wh = long_wh
    found = [r.product_key for r in filters.search_products(wh, text, 10_000, by_grams=True).collect()]
    if "\\" not in text:
        assert found == [p for p in star.products if like(text).fullmatch(str(p))]
    assert found == [r.product_key for r in filters.search_products(wh, text, 10_000).collect()]
    for options in ({"limit": 3}, {"city": "Springfield", "customer_type": "MailOrder", "limit": 10_000}):
        slow, fast = (filters.search_customers(wh, text, by_grams=g, **options).collect() for g in (False, True))
        assert slow == fast
    slow, fast = (filters.search_stores(wh, text, "Texas", limit=10_000, by_grams=g).collect() for g in (False, True))
    assert slow == fast


def test_only_the_rows_of_a_gram_are_read(long_wh):
    star, wh = long_wh
    searches = {
        "product": filters.search_products(wh, "1010", by_grams=True),
        "customer": filters.search_customers(wh, "1010", "Texas", customer_type="Tourist", by_grams=True),
        "store": filters.search_stores(wh, "1010", "Texas", by_grams=True),
    }
    for searched, found in searches.items():
        plan = found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert plan.count("Scan parquet") == 2 and grams.TABLES[searched] in plan
        assert re.search(r"PartitionFilters: \[[^\n]*lead[^\n]* = 1\)", plan) and "EqualTo(gram,101)" in plan
        assert "Exchange hash" not in plan and "Join" not in plan


def test_every_key_stands_once_under_each_of_its_grams(long_wh):
    star, wh = long_wh
    held = sorted((r.store_key, r.gram) for r in wh.table("store_key_grams").collect())
    assert held == sorted((s, g) for s in star.stores for g in {str(s)[i : i + 3] for i in range(len(str(s)) - 2)})


@pytest.mark.parametrize("text, gram", [("17", None), ("1_7%9", None), ("%170_1", "170"), ("12%4567", "456"), (" ABC ", "abc"), ("\\%123", None)])
def test_a_gram_lies_between_wildcards(text, gram):
    assert grams.gram_of(text) == gram


def test_grams_follow_a_refresh(spark, tmp_path):
    star = MiniStar()
    star.dim_customer = [(c + 1000, *rest) for c, *rest in star.dim_customer]
    star.fact_sales = [(t, p, c + 1000, *rest) for t, p, c, *rest in star.fact_sales]
    wh = Warehouse(spark, star.builders(spark), str(tmp_path))
    assert filters.search_customers(wh, "999", by_grams=True).count() == 0
    star.dim_customer.append((9999, None, "Both", None, 1))
    star.fact_sales.append((star.dim_time[0][0], 1, 9999, 1, Decimal(1)))
    fresh = Warehouse(spark, star.builders(spark), str(tmp_path))
    fresh.refresh_cuboids("sales")
    assert [r.customer_key for r in filters.search_customers(fresh, "999", by_grams=True).collect()] == [9999]
