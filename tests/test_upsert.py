"""Upsert rules, load counts, marks and reports."""

import datetime as dt
from decimal import Decimal

import pytest

from starlattice.operators import upsert
from starlattice.schemas import PRIMARY_KEYS

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_if_absent(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "b", 1), (2, "d", 3), (2, "c", 2)], "k int, v string, at int")
    merged = upsert.insert_if_absent(old, batch, ["k"], ["at"])
    assert rows_of(merged.select("k", "v")) == [(1, "a"), (2, "c")]
    counts = upsert.load_counts(old, batch, ["k"], updates=False).first()
    assert (counts["rows_inserted"], counts["rows_updated"]) == (1, 0)


def test_update_named_columns(spark):
    schema = "product_id int, size string, price decimal(10,2), last_updated_time date"
    old = spark.createDataFrame([(1, "S", Decimal(1), D1), (9, "L", Decimal(9), D1)], schema)
    batch = spark.createDataFrame(
        [(1, "M", Decimal(2), D2), (2, "X", Decimal(5), D2), (2, "Y", Decimal(6), D3)], schema
    )
    merged = upsert.upsert(old, batch, "product", PRIMARY_KEYS["product"], ["last_updated_time"])
    assert rows_of(merged) == [
        (1, "S", Decimal("2.00"), D2),  # only price and time change
        (2, "X", Decimal("6.00"), D3),  # first row inserts, second one updates
        (9, "L", Decimal("9.00"), D1),
    ]
    counts = upsert.load_counts(old, batch, ["product_id"], updates=True).first()
    assert (counts["rows_inserted"], counts["rows_updated"]) == (1, 2)


def test_a_named_column_may_become_null(spark):
    old = spark.createDataFrame([(1, "Austin", "Texas", "x")], "location_key int, city string, state string, office_address string")
    batch = spark.createDataFrame([(1, None, "Ohio", "y")], old.schema)
    assert rows_of(upsert.upsert(old, batch, "dim_location", ["location_key"])) == [(1, None, "Texas", "x")]


FACT = "time_key int, product_key int, customer_key int, quantity_ordered bigint, total_amount decimal(15,2)"


def test_additive_upsert(spark):
    old = spark.createDataFrame([(202401, 1, 1, 5, Decimal(50))], FACT)
    batch = spark.createDataFrame([(202401, 1, 1, 2, Decimal(20)), (202401, 1, 1, 1, Decimal(10)), (202402, 1, 1, 4, Decimal(4))], FACT)
    merged = upsert.upsert(old, batch, "fact_sales", PRIMARY_KEYS["fact_sales"])
    assert rows_of(merged) == [(202401, 1, 1, 8, Decimal("80.00")), (202402, 1, 1, 4, Decimal("4.00"))]
    assert merged.schema["total_amount"].dataType == old.schema["total_amount"].dataType
    counts = upsert.load_counts(old, batch, PRIMARY_KEYS["fact_sales"], updates=True).first()
    assert (counts["rows_inserted"], counts["rows_updated"]) == (1, 2)


def test_empty_batch_changes_nothing(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    empty = spark.createDataFrame([], "k int, v string")
    assert rows_of(upsert.insert_if_absent(old, empty, ["k"])) == [(1, "a")]
    assert rows_of(upsert.update_named(old, empty, ["k"], ["v"])) == [(1, "a")]
    assert upsert.load_counts(old, empty, ["k"], updates=True).first()[:] == (0, 0)


def test_a_hot_key_is_folded_before_it_is_shuffled(spark):
    batch = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) AS k", "cast(id as string) AS v", "id AS at")
    first = upsert.first_per_key(batch, ["k"], ["at"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert first.where("k = 7").first()["at"] in (0, 7)
    assert first.count() == batch.select("k").distinct().count()


def test_a_missing_key_fails(spark):
    old = spark.createDataFrame([(1, 7)], "order_id int, customer_id int")
    bad = spark.createDataFrame([(None, 8)], old.schema)
    with pytest.raises(Exception, match="missing primary key value"):
        upsert.insert_if_absent(old, bad, ["order_id"]).collect()


def test_two_disjoint_additive_loads_equal_a_rebuild(spark):
    from starlattice.operators.star import fact_sales

    orders = spark.createDataFrame([(1, 1, D1), (2, 1, D2), (3, 2, D3)], "order_id int, customer_id int, order_date date")
    lines = spark.createDataFrame(
        [(1, 5, 2, Decimal(3), D1), (2, 5, 1, Decimal(4), D2), (3, 6, 1, Decimal(5), D3)],
        "order_id int, product_id int, ordered_quantity int, ordered_price decimal(15,2), last_updated_time date",
    )
    early = fact_sales(lines.where("last_updated_time <= '2024-02-01'"), orders)
    late = fact_sales(lines, orders, D2)
    merged = upsert.upsert(early, late, "fact_sales", PRIMARY_KEYS["fact_sales"])
    assert rows_of(merged) == rows_of(fact_sales(lines, orders))


def test_freshness_and_profile(spark):
    def table(days):
        return spark.createDataFrame([(d,) for d in days], "d date")
    tables = {"never": (table([]), "d"), "old": (table([D1]), "d"), "new": (table([D1, D3]), "d")}
    report = upsert.freshness(tables, dt.datetime(2024, 3, 2))
    assert {r["data_object"]: r["freshness"] for r in report.collect()} == {
        "never": "never loaded", "old": "stale (>2d)", "new": "fresh",
    }
    profile = upsert.table_profile({n: t for n, (t, _) in tables.items()})
    assert rows_of(profile) == [("never", 0), ("new", 2), ("old", 1)]
    timed = upsert.timed_counts({n: t for n, (t, _) in tables.items()})
    assert [(n, c) for n, c, _ in timed] == [("never", 0), ("old", 1), ("new", 2)]
    assert all(ms >= 0 for _, _, ms in timed)


def test_footers_give_the_counts_without_reading_rows(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 as part").write.partitionBy("part").parquet(str(tmp_path / "a"))
    spark.range(0).write.parquet(str(tmp_path / "b"))
    found = upsert.footer_profile(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})
    assert {r.object_name: r.row_count for r in found.collect()} == {"a": 1000, "b": 0}
    assert "PushedAggregation: [COUNT(*)]" in found._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
