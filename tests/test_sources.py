"""Readers, the full-refresh writer and the shared folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from starlattice.operators.conform import conform
from starlattice.plans import load_queries
from starlattice.sources import given_tables, storage, warehouse
from starlattice.sources.files import read_csv, read_database, write_full_refresh


def test_csv_with_quotes(spark, tmp_path):
    path = tmp_path / "mail.csv"
    path.write_text('customer_id,postal_address,time\n1,"12 High St, ""Flat 3""",2024-01-02\n2,Plain,2024-01-03\n')
    rows = read_csv(spark, str(path), "mail_order_customer").orderBy("customer_id").collect()
    assert rows[0] == (1, '12 High St, "Flat 3"', dt.date(2024, 1, 2))
    assert rows[1]["postal_address"] == "Plain"


def test_csv_with_a_broken_value_fails(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,customer_id,order_date\nx,2,2024-01-01\n")
    with pytest.raises(Exception):
        read_csv(spark, str(path), "order").collect()


def test_database_ranges_need_bounds(spark):
    with pytest.raises(ValueError):
        read_database(spark, "jdbc:none", "t", partition_column="id")


def test_full_refresh_replaces_and_empties(spark, tmp_path):
    path = str(tmp_path / "t")
    write_full_refresh(spark.range(5), path)
    write_full_refresh(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    write_full_refresh(spark.range(0), path)
    assert spark.read.parquet(path).count() == 0


def test_hot_partition_value_is_split_over_files(spark, tmp_path):
    path = tmp_path / "t"
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("time_key"), F.rand(1).alias("v")
    )
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        write_full_refresh(rows, str(path), partition_by="time_key")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot = list((path / "time_key=1").glob("*.parquet"))
    cold = list((path / "time_key=2").glob("*.parquet"))
    assert len(hot) > 1 and len(cold) == 1
    assert spark.read.parquet(str(path)).count() == 400_000


class _Session:
    def __init__(self, **conf):
        self.conf = conf


def test_the_shared_folder_comes_from_the_session(tmp_path):
    assert warehouse.shared_folder(_Session(**{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    # A cluster without a shared folder gets no machine-local one.
    assert warehouse.shared_folder(_Session(**{"spark.master": "yarn"})) is None
    assert warehouse.shared_folder(_Session(**{"spark.master": "local[2]"})) is None


def test_csv_queries_say_when_they_have_no_folder(spark, monkeypatch):
    monkeypatch.setattr(load_queries, "open_warehouse", lambda *_: warehouse.Warehouse(spark, {}))
    with pytest.raises(ValueError, match="shared folder"):
        load_queries.through_csv("order")(spark, SF_DIR)


def test_a_source_without_a_mapped_column_is_refused(spark):
    products = given_tables.product(spark, SF_DIR)
    with pytest.raises(ValueError, match="lacks description"):
        conform(products.withColumnRenamed("description", "descriptoin"), "product")
    lines = given_tables.order_product(spark, SF_DIR)
    assert "ordered_price" not in conform(lines, "order_product").columns
    with pytest.raises(ValueError, match="lacks line_amount, ordered_price"):
        conform(lines.drop("line_amount"), "order_product")


def test_a_later_session_finds_the_lattice(spark, mini, tmp_path):
    """The second warehouse stands for another session: it shares nothing but the folder."""
    def open_one(version, builders=None):
        return warehouse.Warehouse(spark, builders or mini.builders(spark), str(tmp_path), version=lambda: version)

    first = open_one("1")
    first.refresh_cuboids("sales")
    files = lambda: sorted(str(p) for p in tmp_path.rglob("*.parquet") if "manifest" not in str(p))
    before = files()

    def never(_):
        raise AssertionError("built again")

    second = open_one("1", {name: never for name in mini.SCHEMAS})
    row = second.cuboid("olap_sales_all").first()
    assert row == first.cuboid("olap_sales_all").first() and files() == before
    # Another version of the input is built anew; readers of older refreshes go on.
    held = second.cuboid("olap_sales_by_year")
    third = open_one("2")
    assert "olap_sales_all" not in third._tables
    third.refresh_cuboids("sales")
    assert held.count() == 2 and open_one("2")._tables.keys() >= {"olap_sales_all"}
    third.refresh_cuboids("sales")
    assert len(list((tmp_path / "refresh").iterdir())) == warehouse.KEPT_REFRESHES


def test_an_unreadable_table_is_not_a_missing_one(spark, tmp_path):
    assert storage.read_if_there(spark, str(tmp_path / "none"), "a int") is None
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        storage.read_if_there(spark, str(bad), "a int").collect()


def test_a_fingerprint_follows_the_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    first = storage.fingerprint(spark, [str(tmp_path / "a")])
    assert first == storage.fingerprint(spark, [str(tmp_path / "a")])
    spark.range(4).write.mode("append").parquet(str(tmp_path / "a"))
    assert first != storage.fingerprint(spark, [str(tmp_path / "a")])


def test_without_a_folder_tables_stay_lazy(spark, mini):
    lazy = warehouse.Warehouse(spark, mini.builders(spark))
    assert lazy.is_small("dim_customer") is False
    assert lazy.cuboid("olap_sales_by_year").count() == 2


def test_a_table_is_written_once(spark, mini, tmp_path):
    calls = []
    builders = mini.builders(spark)
    builders["dim_time"] = lambda w: calls.append(1) or mini.builders(spark)["dim_time"](w)
    wh = warehouse.Warehouse(spark, builders, str(tmp_path))
    assert wh.table("dim_time").count() == wh.table("dim_time").count() == 23
    assert calls == [1]
    assert wh.is_small("dim_time") and not warehouse.Warehouse(
        spark, builders, str(tmp_path / "b"), broadcast_rows=22
    ).is_small("dim_time")


def test_a_query_of_one_fact_makes_only_that_fact(spark):
    """The calendar comes from the given tables, so that stock does without sales."""
    given = warehouse.open_warehouse(spark, SF_DIR)
    own = warehouse.Warehouse(spark, warehouse.star_builders(spark, SF_DIR), f"{given.root}/one-fact", dealt=frozenset({"fact_sales", "fact_inventory"}))
    own.cuboid("olap_inv_by_year").count()
    assert "fact_inventory" in own._stored and "fact_sales" not in own._stored
    months = {r["time_key"] for name in ("fact_sales", "fact_inventory") for r in own.table(name).select("time_key").distinct().collect()}
    assert {r["time_key"] for r in own.table("dim_time").collect()} == months | {200112}
    for name in ("fact_sales", "fact_inventory"):
        assert own.table(name).exceptAll(given.table(name)).count() == 0
