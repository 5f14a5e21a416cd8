"""The lattice, its builders on small and large dimensions, and the refresh."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starlattice.operators import cuboids
from starlattice.operators.cuboids import CUBOIDS, LATTICES, build, build_from, parents
from starlattice.operators.navigate import choose
from starlattice.sources import warehouse
from starlattice.sources.storage import exists
from starlattice.sources.warehouse import Warehouse

TIME = ("year", "quarter", "month")


def expected(mini, cuboid):
    """Brute force over the joined rows."""
    groups = defaultdict(lambda: [0, 0])
    if cuboid.cube == "sales":
        for row in mini.joined_sales():
            if all(row["known"][table] for table in cuboid.dimension_tables):
                group = groups[tuple(row[c] for c in cuboid.dimensions)]
                group[0] += row["quantity"]
                group[1] += row["amount"]
        return {k: tuple(v) for k, v in groups.items()}
    latest = {}
    for row in mini.joined_stock():
        key = (row["product_key"], row["store_key"], *[row[t] for t in TIME if t in cuboid.dimensions])
        if key not in latest or latest[key]["time_key"] < row["time_key"]:
            latest[key] = row
    for row in latest.values():
        groups[tuple(row[c] for c in cuboid.dimensions)][0] += row["held"]
    return {k: (v[0],) for k, v in groups.items()}


def rows_of(df, cuboid):
    rows = df.select(*cuboid.dimensions, *cuboid.measures).collect()
    found = {tuple(r[: len(cuboid.dimensions)]): tuple(r[len(cuboid.dimensions) :]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_the_lattice_is_a_full_product():
    assert len(LATTICES["sales"]) == 48
    assert len(LATTICES["inventory"]) == 32
    assert len({c.dimensions for c in LATTICES["sales"].values()}) == 48


@pytest.mark.parametrize("name", list(CUBOIDS))
def test_small_dimensions(wh, mini, name):
    assert rows_of(build(wh, CUBOIDS[name]), CUBOIDS[name]) == expected(mini, CUBOIDS[name])


@pytest.mark.parametrize("name", list(CUBOIDS))
def test_large_dimensions(wide_wh, mini, name):
    assert rows_of(build(wide_wh, CUBOIDS[name]), CUBOIDS[name]) == expected(mini, CUBOIDS[name])


@pytest.mark.parametrize("cube", ["sales", "inventory"])
def test_refresh_from_parents(spark, mini, tmp_path, cube):
    wh = Warehouse(spark, mini.builders(spark), str(tmp_path))
    before = wh.cuboid(next(iter(LATTICES[cube])))
    written = wh.refresh_cuboids(cube)
    assert sorted(w.name for w in written) == sorted(LATTICES[cube])
    assert all(w.row_count == wh.cuboid(w.name).count() for w in written[::9])
    for cuboid in LATTICES[cube].values():
        assert rows_of(wh.cuboid(cuboid.name), cuboid) == expected(mini, cuboid)
    assert before.count() == 1  # a reader of the previous cuboids is not disturbed


@pytest.mark.parametrize("star", ["wh", "wide_wh"])
def test_roots_of_one_scan(request, mini, star):
    rows = cuboids.sales_roots_from_one_scan(request.getfixturevalue(star)).cache()
    assert len(cuboids.sales_roots()) == 6
    for cuboid in cuboids.sales_roots():
        own = rows.where(F.col("cuboid") == cuboid.name)
        assert rows_of(own, cuboid) == expected(mini, cuboid)
        others = {"year", "customer_key", "customer_type", "state", "city"} - set(cuboid.dimensions)
        assert all(own.where(F.col(c).isNotNull()).isEmpty() for c in others)


def test_one_scan_reads_the_fact_once(spark, mini, tmp_path):
    wh = Warehouse(spark, mini.builders(spark), str(tmp_path))
    plan = cuboids.sales_roots_from_one_scan(wh)._jdf.queryExecution().optimizedPlan().toString()
    assert len([line for line in plan.splitlines() if "Relation" in line and "quantity_ordered" in line]) == 1


def test_refresh_from_one_scan(spark, mini, tmp_path):
    wh = Warehouse(spark, mini.builders(spark), str(tmp_path))
    written = wh.refresh_cuboids("sales", one_scan=True)
    assert sorted(w.name for w in written) == sorted(LATTICES["sales"])
    totals = {w.name: (w.row_count, w.measure_sum) for w in written}
    assert totals == {w.name: (w.row_count, w.measure_sum) for w in wh.refresh_cuboids("sales")}
    again = wh.refresh_cuboids("sales", one_scan=True)
    for cuboid in LATTICES["sales"].values():
        assert wh.cuboid(cuboid.name).columns == [*cuboid.dimensions, *cuboid.measures]
        assert rows_of(wh.cuboid(cuboid.name), cuboid) == expected(mini, cuboid)
    folders = {w.path.rsplit("/", 1)[0] for w in again if w.name in {c.name for c in cuboids.sales_roots()}}
    assert len(folders) == 1


def test_one_scan_of_an_empty_fact(spark, mini, tmp_path):
    builders = mini.builders(spark) | {"fact_sales": lambda _: spark.createDataFrame([], mini.SCHEMAS["fact_sales"])}
    wh = Warehouse(spark, builders, str(tmp_path))
    written = {w.name: w.row_count for w in wh.refresh_cuboids("sales", one_scan=True)}
    assert all(written[c.name] == 0 and wh.cuboid(c.name).isEmpty() for c in cuboids.sales_roots())


@pytest.mark.parametrize("name", ["olap_sales_year_state", "olap_inv_by_quarter", "olap_inv_quarter_product_store"])
def test_every_parent_gives_the_same_rows(wh, mini, name):
    cuboid = CUBOIDS[name]
    for parent in parents(cuboid):
        rows = build_from(parent, build(wh, parent), cuboid)
        assert rows_of(rows, cuboid) == expected(mini, cuboid)


def test_few_cuboids_read_the_fact():
    assert len([c for c in LATTICES["sales"].values() if not parents(c)]) == 6
    assert [c.name for c in LATTICES["inventory"].values() if not parents(c)] == ["olap_inv_base"]
    for cube, lattice in LATTICES.items():
        order = [c.name for c in cuboids.refresh_order(cube)]
        assert sorted(order) == sorted(lattice)
        for name, cuboid in lattice.items():
            assert all(order.index(p.name) < order.index(name) for p in cuboids.smallest_parents(cuboid))


def test_sales_sums_agree_with_the_apex(wh):
    for time, place in (("month", "none"), ("year", "customer_type"), ("quarter", "state")):
        cuboid = next(
            c for c in LATTICES["sales"].values() if (c.time, c.place, c.product) == (time, place, True)
        )
        without_product = next(
            c for c in LATTICES["sales"].values() if (c.time, c.place, c.product) == (time, place, False)
        )
        sums = [
            build(wh, c).agg(F.sum("total_quantity"), F.sum("sum_amount")).first() for c in (cuboid, without_product)
        ]
        assert sums[0] == sums[1]


def test_apex_of_an_empty_fact_is_one_empty_row(spark, mini):
    builders = mini.builders(spark)
    empty = dict(builders)
    for fact in ("fact_sales", "fact_inventory"):
        empty[fact] = lambda _, name=fact: spark.createDataFrame([], mini.SCHEMAS[name])
    wh = Warehouse(spark, empty)
    assert build(wh, CUBOIDS["olap_sales_all"]).collect() == [(None, None)]
    assert build(wh, CUBOIDS["olap_inv_all"]).collect() == [(None,)]
    assert build(wh, CUBOIDS["olap_sales_by_year"]).count() == 0


# Which cuboid answers which request.
CHOICES = [
    ("sales", (), "olap_sales_all"),
    ("sales", ("year",), "olap_sales_by_year"),
    ("sales", ("quarter",), "olap_sales_by_quarter"),
    ("sales", ("month",), "olap_sales_by_time"),
    ("sales", ("city",), "olap_sales_by_city"),
    ("sales", ("customer_key",), "olap_sales_by_customer_info"),
    ("sales", ("customer_key", "city"), "olap_sales_by_customer_loc"),
    ("sales", ("year", "product_key", "customer_type"), "olap_sales_year_product_customer_type"),
    ("sales", ("month", "product_key", "city"), "olap_sales_month_product_city"),
    ("sales", ("month", "customer_key", "product_key"), "olap_sales_base_info"),
    ("sales", ("state", "customer_type"), None),
    ("inventory", (), "olap_inv_all"),
    ("inventory", ("store_key",), "olap_inv_by_store"),
    ("inventory", ("quarter", "product_key"), "olap_inv_quarter_product"),
    ("inventory", ("month", "store_key"), "olap_inv_time_store"),
    ("inventory", ("month", "product_key", "store_key"), "olap_inv_base"),
]


@pytest.mark.parametrize("cube, needed, name", CHOICES)
def test_choice(cube, needed, name):
    chosen = choose(cube, needed)
    assert (chosen.name if chosen else None) == name
    # A filter needs its column as a grouping does, unless it is inactive.
    as_filter = choose(cube, needed[1:], {"state": "All", needed[0]: 1}) if needed else chosen
    assert as_filter == chosen


@pytest.mark.parametrize("cube", ["sales", "inventory"])
def test_refresh_shuffles_rows_of_products_and_customers_once(spark, mini, tmp_path, monkeypatch, cube):
    plans = {}

    def seen(cuboid, rows):
        plans[cuboid.name] = rows._jdf.queryExecution().executedPlan().toString()
        return rows

    def from_parent(parent, rows, cuboid, *args, **named):
        return seen(cuboid, build_from(parent, rows, cuboid, *args, **named))

    monkeypatch.setattr(cuboids, "build_from", from_parent)
    whole = cuboids.known_sums if cube == "sales" else None
    if whole:
        monkeypatch.setattr(cuboids, "known_sums", lambda star, rows, cuboid: seen(cuboid, whole(star, rows, cuboid)))
    Warehouse(spark, mini.builders(spark), str(tmp_path)).refresh_cuboids(cube)
    large = [c.name for c in LATTICES[cube].values() if cuboids.bucket_key(c) and c.name != "olap_inv_base"]
    assert len(large) == (32 if cube == "sales" else 15)
    assert [name for name in large if "Exchange hashpartitioning" in plans[name]] == []


def test_cuboids_by_customer_and_place_are_not_summed_again(spark, mini, tmp_path, monkeypatch):
    plans = {}

    def seen(cuboid, rows):
        plans[cuboid.name] = rows._jdf.queryExecution().executedPlan().toString()
        return rows

    whole = cuboids.known_sums
    monkeypatch.setattr(cuboids, "build_from", lambda parent, rows, cuboid, *args, **named: seen(cuboid, build_from(parent, rows, cuboid, *args, **named)))
    monkeypatch.setattr(cuboids, "known_sums", lambda star, rows, cuboid: seen(cuboid, whole(star, rows, cuboid)))
    wh = Warehouse(spark, mini.builders(spark), str(tmp_path))
    wh.refresh_cuboids("sales", one_scan=True)
    by_place = [c for c in LATTICES["sales"].values() if c.place == "customer_loc"]
    assert len(by_place) == 8
    assert [c.name for c in (*by_place, CUBOIDS["olap_sales_base_info"]) if "Aggregate" in plans[c.name]] == []
    assert [c.name for c in by_place if "Bucketed: true" not in plans[c.name]] == []
    for cuboid in LATTICES["sales"].values():
        assert rows_of(wh.cuboid(cuboid.name), cuboid) == expected(mini, cuboid)
        assert set(wh.cuboid(cuboid.name).columns) == {*cuboid.dimensions, *cuboid.measures}


@pytest.mark.parametrize("cube", ["sales", "inventory"])
def test_refresh_with_large_dimensions(spark, mini, tmp_path, cube):
    wh = Warehouse(spark, mini.builders(spark), str(tmp_path), broadcast_rows=0)
    wh.refresh_cuboids(cube)
    for cuboid in LATTICES[cube].values():
        assert rows_of(wh.cuboid(cuboid.name), cuboid) == expected(mini, cuboid)


@pytest.mark.parametrize("one_scan", [False, True])
def test_refresh_of_hot_keys_has_no_buckets(spark, mini, tmp_path, monkeypatch, one_scan):
    """Customer 3 has a third of all sales."""
    monkeypatch.setattr(warehouse, "HOT_ROWS", 100)
    wh = Warehouse(spark, mini.builders(spark), str(tmp_path))
    monkeypatch.setattr(wh, "_refresh_in_buckets", None)
    wh.refresh_cuboids("sales", one_scan=one_scan)
    for cuboid in list(LATTICES["sales"].values())[::5]:
        assert rows_of(wh.cuboid(cuboid.name), cuboid) == expected(mini, cuboid)


def test_refresh_where_customers_stand_twice(spark, mini, tmp_path):
    people = spark.createDataFrame(mini.dim_customer * 2, mini.SCHEMAS["dim_customer"])
    wh = Warehouse(spark, mini.builders(spark) | {"dim_customer": lambda _: people}, str(tmp_path))
    written = {w.name: (w.row_count, w.measure_sum) for w in wh.refresh_cuboids("sales")}
    for name in ("olap_sales_base_info", "olap_sales_product_city", "olap_sales_time_product", "olap_sales_by_state"):
        rows = build(wh, CUBOIDS[name])
        assert written[name] == (rows.count(), rows.agg(F.sum("total_quantity")).first()[0])


def test_refresh_with_facts_of_no_customer_product_or_month(spark, mini, tmp_path):
    extra = [(None, 1, 2, 5, 7), (202301, None, 2, 6, 7), (202301, 1, None, 7, 7), (None, None, None, 8, 7)]
    fact = spark.createDataFrame(mini.fact_sales, mini.SCHEMAS["fact_sales"]).union(
        spark.createDataFrame(extra, "a int, b bigint, c bigint, d bigint, e int").withColumn("e", F.expr("cast(e as decimal(15,2))"))
    )
    wh = Warehouse(spark, mini.builders(spark) | {"fact_sales": lambda _: fact}, str(tmp_path))
    written = {w.name: (w.row_count, w.measure_sum) for w in wh.refresh_cuboids("sales")}
    for cuboid in list(LATTICES["sales"].values())[::3]:
        rows = build(wh, cuboid)
        assert written[cuboid.name] == (rows.count(), rows.agg(F.sum("total_quantity")).first()[0])


def test_a_refresh_needs_one_fact_and_leaves_no_passing_table(spark, mini, tmp_path):
    def not_needed(_):
        raise AssertionError("the other fact is not needed")

    wh = Warehouse(spark, mini.builders(spark) | {"fact_inventory": not_needed}, str(tmp_path))
    written = wh.refresh_cuboids("sales")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(("olap_", "sales_"))] == []
    assert all(exists(spark, w.path) for w in written)
    folder = next((tmp_path / "refresh").iterdir())
    assert sorted(f.name.rsplit("-", 1)[0] for f in folder.iterdir()) == sorted(LATTICES["sales"])


def test_sales_are_shuffled_once_to_many_customers(spark, mini, tmp_path):
    wh = Warehouse(spark, mini.builders(spark), str(tmp_path), broadcast_rows=0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = cuboids.sales_with_attributes(wh, 3)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(customer_key" in line]
    assert len(shuffles) == 2 and len(set(line.split(", ")[1] for line in shuffles)) == 1


def below_shuffle(rows, key):
    """The lines of the plan that stand below its shuffle by `key`."""
    lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if f"Exchange hashpartitioning({key}" in line)
    depth = [len(re.match(r"[\s:+-]*", line).group()) for line in lines]
    end = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
    return lines[at + 1 : end]


def test_stock_moves_by_its_keys_in_a_refresh(spark, mini, tmp_path, monkeypatch):
    below = {}

    def seen(df, path, table, **named):
        if table.startswith("olap_inv_base_"):
            below["base"] = below_shuffle(df, "product_key")
        return write_buckets(df, path, table, **named)

    write_buckets = warehouse.write_buckets
    monkeypatch.setattr(warehouse, "write_buckets", seen)
    monkeypatch.setattr(cuboids, "bucket_count", lambda count, parallelism: 3)
    Warehouse(spark, mini.builders(spark), str(tmp_path)).refresh_cuboids("inventory")
    assert [line for line in below["base"] if "Join" in line or "city" in line] == []


def test_stock_of_many_stores_moves_without_their_places(spark, mini, tmp_path):
    few = Warehouse(spark, mini.builders(spark), str(tmp_path), broadcast_rows=6)
    assert few.is_small("dim_location") and not few.is_small("dim_store")
    rows = cuboids.stock_by_product(few, 3)
    assert [line for line in below_shuffle(rows, "product_key") if "city" in line] == []
    assert rows_of(rows, CUBOIDS["olap_inv_base"]) == expected(mini, CUBOIDS["olap_inv_base"])
    few.refresh_cuboids("inventory")
    for cuboid in LATTICES["inventory"].values():
        assert rows_of(few.cuboid(cuboid.name), cuboid) == expected(mini, cuboid)


def test_stock_by_month_and_store_of_a_refresh_comes_from_the_fact(spark, mini, tmp_path, monkeypatch):
    parents_of = {}

    def seen(parent, rows, cuboid, *args, **named):
        parents_of[cuboid.name] = parent.name
        return build_from(parent, rows, cuboid, *args, **named)

    monkeypatch.setattr(cuboids, "build_from", seen)
    Warehouse(spark, mini.builders(spark), str(tmp_path)).refresh_cuboids("inventory")
    assert "olap_inv_time_store" not in parents_of
    assert parents_of["olap_inv_month_city"] == "olap_inv_time_store"


@pytest.mark.parametrize("broadcast_rows", [0, 6, 100])
def test_refresh_where_stores_stand_twice(spark, mini, tmp_path, broadcast_rows):
    stores = spark.createDataFrame(mini.dim_store * 2, mini.SCHEMAS["dim_store"])
    wh = Warehouse(spark, mini.builders(spark) | {"dim_store": lambda _: stores}, str(tmp_path), broadcast_rows=broadcast_rows)
    wh.refresh_cuboids("inventory")
    for name in ("olap_inv_time_store", "olap_inv_month_product_city", "olap_inv_by_time"):
        cuboid = CUBOIDS[name]
        once = Warehouse(spark, mini.builders(spark))
        twice = build(once, cuboid).withColumn("total_quantity_on_hand", F.col("total_quantity_on_hand") * 2)
        assert rows_of(wh.cuboid(name), cuboid) == rows_of(twice, cuboid)


def test_one_scan_lies_in_buckets_where_keys_allow(spark, mini, tmp_path, monkeypatch):
    def not_needed(star):
        raise AssertionError("grouping sets are for keys that do not fit buckets")

    monkeypatch.setattr(cuboids, "sales_roots_from_one_scan", not_needed)
    wh = Warehouse(spark, mini.builders(spark), str(tmp_path))
    wh.refresh_cuboids("sales", one_scan=True)
    for name in ("olap_sales_base_info", "olap_sales_base_loc", "olap_sales_by_time"):
        assert rows_of(wh.cuboid(name), CUBOIDS[name]) == expected(mini, CUBOIDS[name])


def test_buckets_are_of_bounded_rows():
    assert cuboids.bucket_count(None, 8) == cuboids.bucket_count(0, 8) == 1
    assert cuboids.bucket_count(3_600_000, 8) == 8
    assert cuboids.bucket_count(216_000_000, 12) == 216


def test_a_part_of_the_shuffle_has_rows_of_one_bucket():
    assert [cuboids.dividing(n, 200) for n in (1, 9, 11, 36, 101, 200, 216)] == [1, 10, 20, 40, 200, 200, 216]
    assert cuboids.dividing(3, 1) == 3 and cuboids.dividing(9, 211) == 9


@pytest.mark.parametrize("cube, hot, broadcast_rows", [("sales", False, 0), ("sales", True, 100), ("inventory", False, 0)])
def test_changed_years_give_a_whole_refresh(spark, mini, tmp_path, monkeypatch, cube, hot, broadcast_rows):
    """A year comes in part and late: it alone is summed anew, in buckets unless keys are hot, and each fact is cut once for a key."""
    if hot:
        monkeypatch.setattr(warehouse, "HOT_ROWS", 10)
    version = ["first"]
    plain = mini.builders(spark)

    def fact(star, name):
        late = (F.col("time_key") > 202400) & (F.col("product_key") % 3 == 0) & (F.lit(version[0]) == "first")
        return plain[name](star).where(~late)

    names = {"fact_sales", "fact_inventory"}
    wh = Warehouse(
        spark,
        plain | {name: (lambda star, n=name: fact(star, n)) for name in names},
        str(tmp_path),
        views=frozenset(plain),
        broadcast_rows=broadcast_rows,
        version=lambda: version[0],
        changed_years=lambda cube, before: [2024],
    )
    wh.refresh_cuboids(cube)
    version[0] = "second"
    built, build_one = [], cuboids.build
    monkeypatch.setattr(cuboids, "build", lambda star, cuboid: built.append(cuboid.name) or build_one(star, cuboid))
    written = {w.name: w for w in wh.refresh_changed(cube)}
    assert set(written) == set(LATTICES[cube])
    # Before, each cuboid without a parent was summed from the fact for itself.
    assert set(built) <= {cuboids.FROM_MONTHS} or (hot and cube == "sales")
    for cuboid in LATTICES[cube].values():
        rows = expected(mini, cuboid)
        assert rows_of(wh.cuboid(cuboid.name), cuboid) == rows, cuboid.name
        assert written[cuboid.name].row_count == len(rows)
        assert written[cuboid.name].measure_sum == sum(v[0] for v in rows.values())
    left = {f.name.rsplit("-", 1)[0] for f in next((tmp_path / "refresh").iterdir()).iterdir()}
    assert left - {f"{name}-by" for name in LATTICES[cube]} == set(LATTICES[cube])
    assert not spark.catalog.listTables()
