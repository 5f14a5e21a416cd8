"""Distinct counts from bitmaps against sets, with rows of unknown dimensions and keys beyond one bitmap."""

from __future__ import annotations

import itertools

import pytest

from starlattice.operators.distinct import count_distinct, members
from starlattice.sources.warehouse import Warehouse


@pytest.mark.parametrize("by", [(), ("customer_type",), ("customer_type", "year", "quarter"), ("state", "year"), ("state", "city"), ("year", "month")])
def test_customers(wh, wide_wh, mini, by):
    groups = {}
    for row in mini.joined_sales():
        if all(row[c] is not None for c in by):
            groups.setdefault(tuple(row[c] for c in by), set()).add(row["customer_key"])
    for star in (wh, wide_wh):
        got = {tuple(r[c] for c in by): r.distinct_customers for r in count_distinct(star, "customer", by).collect()}
        assert got == {k: len(v) for k, v in groups.items()}


@pytest.mark.parametrize("counted, filters", itertools.product(("store", "product"), ({"year": 2023}, {"state": "Texas", "quarter": 2}, {"city": "nowhere"})))
def test_filtered_stock(wh, mini, counted, filters):
    keys = {r[f"{counted}_key"] for r in mini.joined_stock() if all(r[k] == v for k, v in filters.items())}
    found = count_distinct(wh, counted, filters=filters, name="n")
    assert found.first()["n"] == len(keys)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "time_key" not in plan and "bitmap_or_agg" in plan


def test_unknown_columns(wh):
    with pytest.raises(ValueError):
        count_distinct(wh, "store", ["customer_type"])


def test_keys_of_many_bitmaps(spark, mini, tmp_path):
    builders = mini.builders(spark)
    rows = [(202301, 1, k, 1, None) for k in (0, 1, 32_768, 32_769, 65_536, 10**12)] * 2
    schema = mini.SCHEMAS["fact_sales"]
    star = Warehouse(spark, {**builders, "fact_sales": lambda _: spark.createDataFrame(rows, schema)}, str(tmp_path))
    assert count_distinct(star, "customer").first()[0] == 6
    assert count_distinct(star, "customer", ["year"]).collect()[0]["distinct_customers"] == 6


def test_keys_are_shuffled_and_not_bitmaps(wide_wh):
    """All sums of a bitmap lie behind the last shuffle, and products, a row each in the fact, take no other one for themselves."""
    for counted in ("customer", "store", "product"):
        plan = members(wide_wh, counted)._jdf.queryExecution().sparkPlan().toString()
        executed = members(wide_wh, counted)._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_construct_agg" in plan
        assert executed.rindex("bitmap_construct_agg") < executed.index("Exchange")
