"""Two rounds of loads through all layers, and loads that stop half-way."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starlattice.operators import upsert
from starlattice.plans import loads
from starlattice.schemas import SOURCE_SCHEMAS

AT = dt.datetime(2024, 6, 1)
AS_OF = dt.date(2024, 3, 25)


def day(text):
    return dt.date.fromisoformat(text)


def sources(spark, second):
    rows = {
        "representative_office": [(1, " Austin ", "1 Main", "Texas", day("2023-01-01"))],
        "store": [(1, "555", day("2023-01-01"), 1), (2, "556", day("2023-01-01"), 9)],
        "product": [(1, " Chair ", "s", Decimal("1.5"), Decimal("10"), day("2023-01-01"))],
        "order": [(1, 1, day("2024-01-10")), (2, 2, day("2024-02-10"))],
        "order_product": [(1, 1, 2, Decimal("10"), day("2024-01-10")), (2, 1, 1, Decimal("10"), day("2024-02-10"))],
        "stocked_product": [(1, 1, 40, day("2024-02-20"))],
        "customer": [(1, "Ann", 1, day("2024-01-10")), (2, "Bob", 1, day("2024-02-10"))],
        "tourist_customer": [(1, " Guide ", day("2024-01-10"))],
        "mail_order_customer": [(2, " Street ", day("2024-02-10"))],
    }
    if second:
        rows["product"] = [(1, "Stool", "L", Decimal("1.5"), Decimal("12"), day("2024-03-01"))]
        # Order 4 is dated before the mark of the first load: only a load of everything sees it.
        rows["order"] += [(3, 1, day("2024-02-15")), (4, 1, day("2024-01-01"))]
        rows["order_product"] += [(3, 1, 5, Decimal("12"), day("2024-03-05"))]
        rows["stocked_product"] = [(1, 1, 33, day("2024-03-20"))]
        rows["tourist_customer"] += [(2, "Late", day("2024-03-05"))]
    return {t: spark.createDataFrame(r, SOURCE_SCHEMAS[t]) for t, r in rows.items()}


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return loads.LoadStore(spark, str(tmp_path))


def reports(found):
    return {r.table: (r.rows_inserted, r.rows_updated) for r in found}


def test_two_rounds(spark, store, tmp_path):
    first = reports(loads.load_sources(store, sources(spark, False), AT))
    assert first["order_product"] == (2, 0) and first["product"] == (1, 0)
    star_first = reports(loads.load_star(store, AS_OF, AT))
    assert star_first["dim_store"] == (1, 0)  # the store of an unknown city is left out
    assert star_first["fact_sales"] == (2, 0)
    columns = ["time_key", "product_key", "customer_key", "quantity_ordered", "total_amount"]
    assert rows_of(store.table("star", "fact_sales").select(columns)) == [
        (202401, 1, 1, 2, Decimal("20.00")), (202402, 1, 2, 1, Decimal("10.00")),
    ]

    second = reports(loads.load_sources(store, sources(spark, True), AT))
    assert second["order"] == (1, 0)
    assert second["order_product"] == (1, 0) and second["product"] == (0, 1)
    assert rows_of(store.table("conformed", "product").select("description", "size", "price")) == [
        ("Chair", "S", Decimal("12.00")),
    ]
    star_second = reports(loads.load_star(store, AS_OF, AT))
    assert star_second["dim_customer"] == (0, 1)
    assert rows_of(store.table("star", "dim_customer").select("customer_key", "customer_type")) == [(1, "Tourist"), (2, "Both")]
    # Months: stock of February stays, March arrives.
    assert rows_of(store.table("star", "fact_inventory").select("time_key", "quantity_on_hand")) == [(202402, 40), (202403, 33)]
    before = rows_of(store.table("star", "fact_sales").select(columns))
    assert before == [
        (202401, 1, 1, 2, Decimal("20.00")), (202402, 1, 1, 5, Decimal("60.00")), (202402, 1, 2, 1, Decimal("10.00")),
    ]
    again = reports(loads.load_star(store, AS_OF, AT, ["fact_sales"]))
    assert again["fact_sales"] == (0, 0)
    assert rows_of(store.table("star", "fact_sales").select(columns)) == before

    wh = loads.open_loaded(store, str(tmp_path / "cuboids"))
    assert wh.cuboid("olap_sales_all").first()["total_quantity"] == 8
    assert wh.cuboid("olap_inv_all").first()["total_quantity_on_hand"] == 33


# Each kind of target: its layer, and what else must be loaded before.
KINDS = {
    "order": ("conformed", ()),
    "product": ("conformed", ()),
    "dim_customer": ("star", ("customer", "tourist_customer", "mail_order_customer")),
    "fact_sales": ("star", ("order", "order_product")),
}


@pytest.mark.parametrize("table, second", [("order", False), ("order", True), ("product", True), ("dim_customer", True), ("fact_sales", False), ("fact_sales", True)])
def test_a_load_that_stops_before_it_is_published_repeats_nothing(spark, tmp_path, monkeypatch, table, second):
    """Stopped after the write, twice over: then the same rows and counts as without a stop."""
    layer, needed = KINDS[table]

    def load_one(store, rows):
        if layer == "star":
            return reports(loads.load_star(store, AS_OF, AT, [table]))
        return reports(loads.load_sources(store, rows, AT, [table]))

    def prepared(name):
        store = loads.LoadStore(spark, str(tmp_path / name))
        rows = sources(spark, False)
        loads.load_sources(store, rows, AT, needed)
        if second:
            load_one(store, rows)
            rows = sources(spark, True)
            loads.load_sources(store, rows, AT, needed)
        return store, rows

    plain, rows = prepared("plain")
    expected = load_one(plain, rows)
    stopped, rows = prepared("stopped")
    real = loads.LoadStore.record

    def stop(self, *rest):
        raise RuntimeError("stopped")

    monkeypatch.setattr(loads.LoadStore, "record", stop)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            load_one(stopped, rows)
    monkeypatch.setattr(loads.LoadStore, "record", real)
    # Another table is published meanwhile, so the repeated load has a new number.
    loads.load_sources(stopped, rows, AT, ["store"])
    assert load_one(stopped, rows) == expected
    names = sorted(plain.table(layer, table).columns)
    content = lambda store: sorted(map(repr, (tuple(r) for r in store.table(layer, table).select(names).collect())))
    assert content(stopped) == content(plain)


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), SOURCE_SCHEMAS["order_product"])


def test_rows_of_the_same_day_and_lines_before_their_order_reach_the_star(spark, store):
    orders = lambda *r: spark.createDataFrame(list(r), SOURCE_SCHEMAS["order"])
    one, two, three = day("2024-01-10"), day("2024-01-11"), day("2024-01-09")
    first = {"order": orders((1, 1, one)), "order_product": lines(spark, (1, 1, 2, Decimal(10), one), (2, 1, 5, Decimal(10), one))}
    loads.load_sources(store, first, AT, first)
    loads.load_star(store, AS_OF, AT, ["fact_sales"])
    quantity = lambda: store.table("star", "fact_sales").groupBy().sum("quantity_ordered").first()[0]
    assert quantity() == 2  # line 2 waits for its order
    # The same day again, and an order dated before the mark.
    second = {"order": orders((1, 1, one), (2, 2, two)), "order_product": lines(spark, (1, 2, 3, Decimal(10), one))}
    loads.load_sources(store, second, AT, second)
    assert reports(loads.load_star(store, AS_OF, AT, ["fact_sales"]))["fact_sales"] == (2, 0)
    assert quantity() == 10
    late = {"order_product": lines(spark, (2, 7, 100, Decimal(1), three))}
    loads.load_sources(store, late, AT, late)
    assert reports(loads.load_star(store, AS_OF, AT, ["fact_sales"]))["fact_sales"] == (0, 0)
    loads.load_sources(store, late, AT, late, everything=True)
    loads.load_star(store, AS_OF, AT, ["fact_sales"])
    assert quantity() == 110
    assert rows_of(store.table("star", "fact_sales")) == rows_of_rebuilt(store)


def rows_of_rebuilt(store):
    loads.load_star(store, AS_OF, AT, ["fact_sales"], rebuild=True)
    return rows_of(store.table("star", "fact_sales"))


def test_a_store_waits_for_its_office(spark, store):
    first = sources(spark, False)
    loads.load_sources(store, first, AT, ["representative_office", "store"])
    loads.load_star(store, AS_OF, AT, ["dim_store"])
    office = spark.createDataFrame([(9, "Salem", "2 Main", "Oregon", day("2024-05-01"))], SOURCE_SCHEMAS["representative_office"])
    loads.load_sources(store, {"representative_office": office}, AT, ["representative_office"])
    assert reports(loads.load_star(store, AS_OF, AT, ["dim_store"]))["dim_store"] == (1, 0)


def test_load_refresh_load_refresh_in_one_session(spark, store, tmp_path):
    loads.load_sources(store, sources(spark, False), AT)
    loads.load_star(store, AS_OF, AT)
    wh = loads.open_loaded(store, str(tmp_path / "cuboids"))
    wh.refresh_cuboids("sales")
    held = wh.cuboid("olap_sales_by_time")
    before = rows_of(held)
    loads.load_sources(store, sources(spark, True), AT)
    loads.load_star(store, AS_OF, AT)
    wh.refresh_cuboids("sales")
    assert wh.cuboid("olap_sales_all").first()["total_quantity"] == 8
    assert rows_of(held) == before
    assert loads.open_loaded(store, str(tmp_path / "cuboids")).cuboid("olap_sales_all").first()["total_quantity"] == 8


def test_only_touched_months_are_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "months")
    schema = "time_key int, product_key int, customer_key int, quantity_ordered bigint, total_amount decimal(15,2)"
    old = spark.createDataFrame([(202401, 1, 1, 5, Decimal(50)), (202402, 1, 1, 6, Decimal(60))], schema)
    upsert.replace_partitions(old, path, "time_key")
    untouched = sorted((tmp_path / "months" / "time_key=202401").glob("*.parquet"))
    batch = spark.createDataFrame([(202402, 1, 1, 1, Decimal(10)), (202403, 2, 1, 1, Decimal(1))], schema)
    stored = spark.read.schema(schema).parquet(path)
    held = stored.where(F.col("time_key").isin(upsert.touched_values(batch, "time_key")))
    merged = upsert.merge_counted(held, batch, "fact_sales", ["time_key", "product_key", "customer_key"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [time_key" in plan and "202401" not in plan
    assert merged.groupBy().sum("rows_inserted", "rows_updated").first()[:] == (1, 1)
    aside = str(tmp_path / "aside")
    merged.drop("rows_inserted", "rows_updated").write.parquet(aside)
    upsert.replace_partitions(spark.read.parquet(aside), path, "time_key")
    assert sorted((tmp_path / "months" / "time_key=202401").glob("*.parquet")) == untouched
    after = spark.read.schema(schema).parquet(path).select("time_key", "product_key", "quantity_ordered")
    assert rows_of(after) == [(202401, 1, 5), (202402, 1, 7), (202403, 2, 1)]


def orders(spark, *ids, day_=day("2024-01-10")):
    return {"order": spark.createDataFrame([(i, 1, day_) for i in ids], SOURCE_SCHEMAS["order"])}


def files_of(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


@pytest.mark.parametrize("table", ["order", "product"])
def test_untouched_ranges_keep_their_files_and_are_not_read(spark, tmp_path, table):
    store = loads.LoadStore(spark, str(tmp_path), keys_a_range=10)
    made = {
        "order": lambda *ids: orders(spark, *ids),
        "product": lambda *ids: {"product": spark.createDataFrame([(i, "Chair", "s", Decimal(1), Decimal(i), day("2024-01-10")) for i in ids], SOURCE_SCHEMAS["product"])},
    }[table]
    loads.load_sources(store, made(*range(100)), AT, [table])
    folder = tmp_path / "conformed" / table
    before = files_of(folder)
    reads = []
    real = upsert.merge_counted

    def watched(old, *rest, **named):
        reads.append((old._jdf.queryExecution().executedPlan().toString(), old.count()))
        return real(old, *rest, **named)

    loads.upsert.merge_counted = watched
    try:
        counts = reports(loads.load_sources(store, made(41, 42, 205), AT, [table]))
    finally:
        loads.upsert.merge_counted = real
    assert counts[table] == ((1, 0) if table == "order" else (1, 2))
    plan, rows = reads[0]
    assert "PartitionFilters: [key_range" in plan and rows == 10  # of 100: the range of 41 and 42
    after = files_of(folder)
    kept = {f for f in before if after.get(f) == before[f]}
    assert {f for f in before if "key_range=4/" not in f} == kept
    assert {f.split("/")[0] for f in after} == {f"key_range={i}" for i in (*range(10), 20)}


def test_loads_that_bring_nothing_leave_nothing(spark, store, tmp_path):
    for _ in range(4):
        loads.load_sources(store, orders(spark, 1, 2), AT, ["order"])
    assert store.state("conformed", "order").number == 1
    for i in range(5):
        loads.load_sources(store, orders(spark, 10 + i), AT, ["order"])
    assert [p.name for p in (tmp_path / "state").rglob("[!.]*.json")] == ["6-done.json"]
    assert not list((tmp_path / "aside").rglob("*.parquet"))
    assert store.table("conformed", "order").count() == 7
    assert len(list((tmp_path / "conformed" / "order").rglob("*.parquet"))) == 1


@pytest.mark.parametrize("table", ["order", "product", "dim_customer", "fact_sales"])
def test_a_load_that_stops_while_it_replaces_is_finished(spark, tmp_path, monkeypatch, table):
    layer, needed = KINDS[table]
    store = loads.LoadStore(spark, str(tmp_path), keys_a_range=1)
    load_one = lambda rows: loads.load_star(store, AS_OF, AT, [table]) if layer == "star" else loads.load_sources(store, rows, AT, [table])
    for second in (False, True):
        rows = sources(spark, second)
        loads.load_sources(store, rows, AT, needed)
        if second:
            real = upsert.replace_partitions

            def stop(found, target, by):
                values = upsert.touched_values(found, by)
                real(found.where(F.col(by) == values[0]), target, by)
                raise RuntimeError("stopped")

            monkeypatch.setattr(upsert, "replace_partitions", stop)
            with pytest.raises(RuntimeError):
                load_one(rows)
            monkeypatch.setattr(upsert, "replace_partitions", real)
        load_one(rows)
    plain = loads.LoadStore(spark, str(tmp_path / "plain"))
    for second in (False, True):
        rows = sources(spark, second)
        loads.load_sources(plain, rows, AT, needed)
        if layer == "star":
            loads.load_star(plain, AS_OF, AT, [table])
        else:
            loads.load_sources(plain, rows, AT, [table])
    names = sorted(plain.table(layer, table).columns)
    assert rows_of(store.table(layer, table).select(names)) == rows_of(plain.table(layer, table).select(names))


def test_pending_lines_are_met_by_new_orders_alone(spark, tmp_path):
    store = loads.LoadStore(spark, str(tmp_path), keys_a_range=10)
    one = day("2024-01-10")
    first = {**orders(spark, *range(0, 50)), "order_product": lines(spark, *[(i, 1, 1, Decimal(10), one) for i in range(60)])}
    loads.load_sources(store, first, AT, first)
    loads.load_star(store, AS_OF, AT, ["fact_sales"])
    waiting = lambda: sorted(r[0] for r in store.stored("star", "fact_sales", "star/fact_sales-pending").select("order_id").collect())
    assert waiting() == list(range(50, 60))
    loads.load_sources(store, orders(spark, 53, 54), AT, ["order"])
    (batch, _) = loads.star_batch(store, "fact_sales", store.state("star", "fact_sales").number, AS_OF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = batch._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # Of old lines only the pending ones are read, files without a newer load are skipped, orders by range.
    assert any("fact_sales-pending" in f for f in batch.inputFiles())
    assert "GreaterThan(load_number," in plan and re.search(r"PartitionFilters: \[[^\]]*key_range", plan)
    assert reports(loads.load_star(store, AS_OF, AT, ["fact_sales"]))["fact_sales"] == (0, 1)
    assert waiting() == [50, 51, 52, 55, 56, 57, 58, 59]
    loads.load_sources(store, orders(spark, *range(40, 70)), AT, ["order"])
    loads.load_star(store, AS_OF, AT, ["fact_sales"])
    assert waiting() == []
    assert store.table("star", "fact_sales").groupBy().sum("quantity_ordered").first()[0] == 60
    assert rows_of(store.table("star", "fact_sales")) == rows_of_rebuilt(store)


def test_changed_years_are_refreshed_to_a_whole_refresh(spark, store, tmp_path):
    rows = sources(spark, False)
    older = lines(spark, *[(o, p, o, Decimal(3), day("2023-05-01")) for o in (11, 12) for p in (1, 2)])
    rows["order_product"] = rows["order_product"].union(older)
    rows["order"] = rows["order"].union(spark.createDataFrame([(11, 1, day("2022-05-01")), (12, 2, day("2023-05-01"))], SOURCE_SCHEMAS["order"]))
    loads.load_sources(store, rows, AT)
    loads.load_star(store, AS_OF, AT)
    wh = loads.open_loaded(store, str(tmp_path / "cuboids"))
    for cube in ("sales", "inventory"):
        wh.refresh_cuboids(cube)
    before = store.version()
    assert wh.refresh_changed("sales") and loads.changed_years(store, "sales", before) == []
    # Order 3 of 2024, another type for customer 2 of 2023 and 2024, stock of March 2024.
    loads.load_sources(store, sources(spark, True), AT)
    loads.load_star(store, AS_OF, AT)
    assert sorted(loads.changed_years(store, "sales", before)) == [2023, 2024]
    assert loads.changed_years(store, "inventory", before) == [2024]
    for cube in ("sales", "inventory"):
        changed = {w.name: (w.row_count, w.measure_sum) for w in wh.refresh_changed(cube)}
        content = {name: rows_of(wh.cuboid(name).select(sorted(wh.cuboid(name).columns))) for name in changed}
        again = loads.open_loaded(store, str(tmp_path / f"again-{cube}"))
        whole = {w.name: (w.row_count, w.measure_sum) for w in again.refresh_cuboids(cube)}
        assert changed == whole
        assert content == {name: rows_of(again.cuboid(name).select(sorted(again.cuboid(name).columns))) for name in whole}


def test_an_unknown_table_is_reported(store):
    with pytest.raises(ValueError, match="never loaded"):
        store.table("star", "fact_sales")


def test_ranges_stay_few_however_many_keys(spark, tmp_path, monkeypatch):
    """Ranges widen with the keys; a table that has grown to four times as many is cut anew and keeps its rows."""
    monkeypatch.setattr(loads, "MOST_RANGES", 8)
    store = loads.LoadStore(spark, str(tmp_path), keys_a_range=10)
    folder = tmp_path / "conformed" / "order"

    def ranges():
        return sum(f.name.startswith("key_range=") for f in folder.iterdir())

    loads.load_sources(store, orders(spark, *range(200)), AT, ["order"], everything=True)
    assert ranges() == 5  # of 40 keys: 20 ranges of 10 would be too many
    assert store.held_width("conformed", "order", "conformed/order") == 40
    found = reports(loads.load_sources(store, orders(spark, 3, 500), AT, ["order"], everything=True))
    assert found["order"] == (1, 0) and ranges() == 6
    loads.load_sources(store, orders(spark, *range(1000, 2200)), AT, ["order"], everything=True)
    assert ranges() <= 8 and store.held_width("conformed", "order", "conformed/order") == 320
    held = [r["order_id"] for r in store.table("conformed", "order").collect()]
    assert sorted(held) == [*range(200), 500, *range(1000, 2200)]
    near = store.near("conformed", "order", spark.createDataFrame([(7,)], "order_id bigint"))
    assert {3, 7} <= {r["order_id"] for r in near.collect()}
    assert reports(loads.load_sources(store, orders(spark, 4, 2100), AT, ["order"], everything=True))["order"] == (0, 0)
