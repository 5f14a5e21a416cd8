"""The physical plans that matter at scale."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from starlattice.operators import cuboids
from starlattice.operators.cuboids import CUBOIDS, build
from starlattice.plans import catalogue
from starlattice.sources.warehouse import Warehouse, open_warehouse


def plan_of(df, mode="formatted"):
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
    return text


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(query(spark, SF_DIR), "simple") for name, query in catalogue.QUERIES.items()}


@pytest.mark.parametrize(
    "operator",
    ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"],
)
def test_no_query_uses_python_or_a_cross_join(plans, operator):
    assert [name for name, plan in plans.items() if operator in plan] == []


def test_window_without_partitions_only_over_a_few_rows(plans):
    allowed = {"sales_segments", "sales_segments_of_a_quarter", "product_analysis_trend"} | {
        f"forward_coverage_{level}" for level in ("year", "quarter", "month")
    }
    found = {n for n, plan in plans.items() if "Exchange SinglePartition" in plan and "Window" in plan}
    assert found <= allowed


def test_filters_and_columns_reach_the_scan(spark):
    wh = open_warehouse(spark, SF_DIR)
    report = wh.table("fact_sales").where(F.col("time_key").between(199701, 199712)).groupBy("product_key").agg(F.sum("total_amount"))
    plan = plan_of(report)
    assert re.search(r"PartitionFilters: \[.*time_key.*>= 199701.*<= 199712", plan)
    assert "ReadSchema: struct<product_key:bigint,total_amount:decimal(15,2)>" in plan


def test_a_calendar_filter_prunes_fact_partitions(spark):
    wh = open_warehouse(spark, SF_DIR)
    rows = cuboids.with_time(wh.table("fact_sales"), wh, ["year"]).where("year = 1997")
    assert "dynamicpruning" in plan_of(rows, "extended").lower()


def test_finest_cuboid_needs_no_shuffle(spark):
    plan = plan_of(build(open_warehouse(spark, SF_DIR), CUBOIDS["olap_sales_base_loc"]), "simple")
    assert "hashpartitioning" not in plan


def test_apex_shuffles_partial_sums_only(spark):
    plan = plan_of(build(open_warehouse(spark, SF_DIR), CUBOIDS["olap_sales_by_city"]), "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan


@contextmanager
def shuffled_joins(spark):
    """No broadcasts, and thresholds small enough that test data counts as skewed."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark):
    """A star whose customer 1 and store 1 hold a third of many rows, dimensions too large to broadcast."""
    rows = spark.range(600_000)
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4000).cast("bigint")
    months = 202401 + F.col("id") % 12
    sales = rows.select(
        months.cast("int").alias("time_key"), F.col("id").alias("product_key"), hot.alias("customer_key"),
        F.lit(1).cast("bigint").alias("quantity_ordered"), F.lit(2).cast("decimal(15,2)").alias("total_amount"),
    )
    stock = rows.select(
        months.cast("int").alias("time_key"), hot.alias("store_key"), F.col("id").alias("product_key"),
        F.lit(1).cast("bigint").alias("quantity_on_hand"),
    )
    people = spark.range(4000)
    place = (F.col("id") % 7).cast("int").alias("location_key")
    builders = {
        "fact_sales": sales,
        "fact_inventory": stock,
        "dim_time": spark.range(1, 13).selectExpr(
            "cast(202400 + id as int) time_key", "cast(id as int) month", "cast(ceil(id / 3) as int) quarter", "2024 year"
        ),
        "dim_location": spark.range(7).selectExpr(
            "cast(id as int) location_key", "concat('c', id) city", "concat('s', id % 2) state", "'' office_address"
        ),
        "dim_customer": people.select(
            F.col("id").alias("customer_key"), F.lit("").alias("customer_name"),
            F.concat(F.lit("t"), F.col("id") % 4).alias("customer_type"), F.lit(None).cast("date").alias("first_order_date"), place,
        ),
        "dim_store": people.select(F.col("id").alias("store_key"), F.lit("").alias("phone_number"), place),
    }
    return Warehouse(spark, {n: (lambda _, d=d: d) for n, d in builders.items()})


@pytest.mark.parametrize(
    "name, hot_total",
    [("olap_sales_product_customer_type", 600_000), ("olap_inv_product_city", 600_000), ("olap_sales_base_loc", 600_000)],
)
def test_a_hot_key_is_split_when_dimensions_are_large(spark, name, hot_total):
    with shuffled_joins(spark):
        cuboid = CUBOIDS[name]
        df = build(skewed(spark), cuboid).agg(F.sum(cuboid.measures[0]).alias("n"), F.max("product_key"))
        plan = final_plan(df)
        assert df.first()["n"] == hot_total
    assert "skew=true" in plan


def test_a_hot_order_is_split(spark):
    """One order holds a third of all lines."""
    from starlattice.operators.star import fact_sales

    order = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).cast("bigint").alias("order_id")
    day = F.lit("2024-01-05").cast("date")
    lines = spark.range(600_000).select(
        order, F.col("id").alias("product_id"), F.lit(1).alias("ordered_quantity"),
        F.lit(2).cast("decimal(15,2)").alias("ordered_price"), day.alias("last_updated_time"),
    )
    orders = spark.range(5000).select(F.col("id").alias("order_id"), (F.col("id") % 9).alias("customer_id"), day.alias("order_date"))
    with shuffled_joins(spark):
        df = fact_sales(lines, orders).agg(F.sum("quantity_ordered").alias("n"), F.max("product_key"))
        plan = final_plan(df)
        assert df.first()["n"] == 600_000
    assert "skew=true" in plan


def test_a_hot_customer_is_folded_before_the_join(spark):
    """Without product in the result, each customer is a few rows before it meets its attributes."""
    df = build(skewed(spark), CUBOIDS["olap_sales_year_customer_type"])
    plan = plan_of(df, "simple")
    # Two measures, summed before and after the join to the customers.
    assert plan.count("partial_sum(") == 4
    assert {r["customer_type"]: r["total_quantity"] for r in df.collect()}["t1"] == 200_000 + sum(
        1 for i in range(600_000) if i % 3 and (i % 4000) % 4 == 1
    )
