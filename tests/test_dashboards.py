"""Dashboard rules on hand-made rows."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starlattice.functions import paging
from starlattice.operators import filters
from starlattice.operators import inventory as inv
from starlattice.operators import navigate as nav
from starlattice.operators import sales
from starlattice.operators.cuboids import CUBOIDS, LATTICES, build
from starlattice.sources.warehouse import Warehouse

MERGED = "year int, quarter int, month int, total_quantity bigint, sum_amount decimal(24,2), total_quantity_on_hand bigint"


def star_of(spark, sales_rows=(), stock_rows=()):
    """One city, one store, two products; rows are (time_key, product, quantity[, amount])."""
    keys = sorted({r[0] for r in [*sales_rows, *stock_rows]})
    tables = {
        "dim_time": ([(k, k % 100, (k % 100 + 2) // 3, k // 100) for k in keys], "time_key int, month int, quarter int, year int"),
        "dim_location": ([(1, "Austin", "Texas", "x")], "location_key int, city string, state string, office_address string"),
        "dim_store": ([(1, "555", 1)], "store_key int, phone_number string, location_key int"),
        "dim_customer": ([(1, "Ann", "Both", dt.date(2024, 1, 1), 1)], "customer_key int, customer_name string, customer_type string, first_order_date date, location_key int"),
        "dim_product": ([(1, "a", "S", None), (2, "b", "S", None)], "product_key int, description string, size string, weight decimal(10,2)"),
        "fact_sales": ([(k, p, 1, q, Decimal(q)) for k, p, q in sales_rows], "time_key int, product_key int, customer_key int, quantity_ordered int, total_amount decimal(15,2)"),
        "fact_inventory": ([(k, 1, p, q) for k, p, q in stock_rows], "time_key int, store_key int, product_key int, quantity_on_hand int"),
    }
    return Warehouse(spark, {n: (lambda _, d=d, s=s: spark.createDataFrame(d, s)) for n, (d, s) in tables.items()})


def test_snapshot_per_grain(spark):
    wh = star_of(spark, stock_rows=[(202401, 1, 10), (202402, 1, 7), (202403, 1, 4)])
    by_month = build(wh, CUBOIDS["olap_inv_by_time"]).orderBy("month").collect()
    assert [r["total_quantity_on_hand"] for r in by_month] == [10, 7, 4]
    for name in ("olap_inv_by_quarter", "olap_inv_by_year", "olap_inv_all"):
        assert build(wh, CUBOIDS[name]).first()["total_quantity_on_hand"] == 4


def test_forward_coverage(spark):
    merged = spark.createDataFrame(
        [(2024, 1, 1, 5, Decimal(50), 30), (2024, 1, 2, 10, Decimal(100), 20), (2024, 1, 3, 0, Decimal(0), 8)], MERGED
    )
    rows = inv.with_coverage(merged, "month").orderBy("month").collect()
    assert [r["coverage_ratio"] for r in rows] == [3.0, 0.0, 0.0]
    assert [r["total_quantity"] for r in rows] == [10, 0, 0]
    assert [r["sum_amount"] for r in rows] == [Decimal(100), Decimal(0), Decimal(0)]
    assert [r["time_key"] for r in rows] == ["2024-1-1", "2024-1-2", "2024-1-3"]


def test_coverage_rounds_and_skips_missing_periods(spark):
    wh = star_of(spark, [(202401, 1, 3), (202404, 1, 7)], [(202401, 1, 5), (202402, 1, 10)])
    rows = inv.forward_coverage(wh, "month").collect()
    # After February the next period present is April.
    assert [(r["month"], r["total_quantity"], r["coverage_ratio"]) for r in rows] == [(1, 0, 0.0), (2, 7, 1.43), (4, 0, 0.0)]


@pytest.mark.parametrize(
    "stock, sold, status",
    [
        (12, 10, "optimal"), (12.01, 10, "overstock"), (8, 10, "optimal"), (7.99, 10, "understock"),
        (5, 0, "overstock"), (0, 0, "optimal"),
    ],
)
def test_status_edges(spark, stock, sold, status):
    row = spark.createDataFrame([(float(stock), float(sold))], "stock double, sales double")
    assert row.select(inv.stock_status(F.col("stock"), F.col("sales"))).first()[0] == status


def test_scatter_shifts_sales_and_counts_status(spark):
    wh = star_of(spark, [(202404, 1, 10), (202403, 1, 99)], [(202403, 1, 30), (202403, 2, 5)])
    scatter = inv.product_scatter(wh, {"year": 2024, "quarter": 1, "month": 3})
    rows = {r["product_key"]: r for r in scatter.collect()}
    assert (rows[1]["sales"], rows[1]["inventory"], rows[1]["coverage_ratio"]) == (10, 30, 3.0)
    assert (rows[2]["sales"], rows[2]["coverage_ratio"], rows[2]["status"]) == (0, 999.0, "overstock")
    assert inv.status_counts(scatter).first().asDict() == {"optimal": 0, "overstock": 2, "understock": 0}
    assert [r["product_key"] for r in inv.most_over_ordered(scatter, 1).collect()] == [1]
    assert [r["product_key"] for r in inv.most_short(scatter, 1).collect()] == [2]


def test_city_risk_scores(spark):
    wh = star_of(spark, [(202401, 1, 2), (202401, 2, 9)], [(202401, 1, 5)])
    city = inv.city_risk(wh).first()
    assert (city["overstock_count"], city["overstock_score"]) == (1, 2.5)
    # No stock at all: the score is the sales themselves.
    assert (city["understock_count"], city["understock_score"]) == (1, 9.0)
    assert (city["avg_inventory"], city["total_sales"]) == (2.5, 11)
    assert inv.riskiest_cities(inv.city_risk(wh), "overstock").count() == 1
    with pytest.raises(ValueError):
        inv.riskiest_cities(inv.city_risk(wh), "theft")


def test_filtered_stock_is_the_latest_in_the_filter(spark):
    wh = star_of(spark, stock_rows=[(202401, 1, 10), (202402, 1, 7), (202301, 1, 3), (202302, 2, 1)])
    totals = inv.overview(wh, {"quarter": 1}).first()
    assert (totals["total_inventory"], totals["total_stores"], totals["total_products"]) == (8, 1, 2)
    assert nav.answer(wh, "inventory", ["quarter"]).collect() == [(1, 8)]
    assert nav.answer(wh, "inventory", ["year"]).orderBy("year").collect() == [(2023, 4), (2024, 7)]
    assert inv.overview(wh, {"year": 1999}).first()["total_inventory"] == 0


def test_analysis_of_one_period(spark):
    wh = star_of(spark, [(202401, 1, 4)], [(202312, 1, 9)])
    row = inv.product_analysis(wh, 1, "month", {"year": 2023, "quarter": 4, "month": 12}).first()
    assert (row["time_key"], row["total_quantity"], row["total_quantity_on_hand"], row["coverage_ratio"]) == ("2023-4-12", 4, 9, 2.25)
    same = inv.product_analysis(wh, 1, "month", {"year": 2023, "month": 12}).first()
    assert (same["time_key"], same["quarter"], same["total_quantity"]) == ("2023-4-12", 4, 4)
    nothing = inv.product_analysis(wh, 2, "year", {"year": 2023}).first()
    assert (nothing["total_quantity"], nothing["total_quantity_on_hand"], nothing["coverage_ratio"]) == (0, 0, 0.0)


def test_overview_rounds_and_survives_nothing(spark):
    wh = star_of(spark, [(202401, 1, 3), (202402, 2, 4)])
    assert sales.overview(wh).first()["average_price"] == 1.0
    empty = sales.overview(wh, {"year": 1999}).first()
    assert (empty["total_revenue"], empty["total_quantity"], empty["average_price"]) == (Decimal(0), 0, 0.0)


@pytest.mark.parametrize(
    "filters, columns",
    [({}, ("year", "quarter", "month")), ({"year": 2024}, ("quarter", "month")), ({"quarter": 1}, ("month",))],
)
def test_trend_widens_with_missing_parents(filters, columns):
    assert sales.trend_columns("month", filters) == columns


def test_rankings_are_empty_when_the_filter_fixes_them(wh):
    assert sales.ranked_products(wh, {"product_key": 0}).count() == 0
    for fixed in ({"customer_type": "Both"}, {"customer_key": 0}, {"state": "Texas"}, {"city": "Austin"}):
        assert sales.customer_segments(wh, fixed).count() == 0
    shares = [r["percentage"] for r in sales.customer_segments(wh).collect()]
    assert abs(sum(shares) - 100) < 0.05


def test_unknown_customer_has_no_card(wh):
    assert sales.customer_cards(wh, 99).count() == 0
    # Customer 4 lives at a location nobody knows.
    card = sales.customer_cards(wh, 4).first()
    assert (card["city"], card["location"]) == (None, None)
    assert sales.customer_summary(wh, {"customer_key": 4}).first()["order_count"] > 0


# --- navigation -------------------------------------------------------------


def brute_sales(mini, group, filters=None):
    used = {*group, *(filters or {})}
    joined = {"dim_time"} if used & {"year", "quarter", "month"} else set()
    joined |= {"dim_customer"} if used & {"customer_type", "state", "city"} else set()
    joined |= {"dim_location"} if used & {"state", "city"} else set()
    sums = {}
    for row in mini.joined_sales():
        if not all(row["known"][t] for t in joined) or any(row[k] != v for k, v in (filters or {}).items()):
            continue
        key = tuple(row[g] for g in group)
        sums[key] = sums.get(key, 0) + row["amount"]
    return sums


@pytest.mark.parametrize(
    "group, filters",
    [
        (("year", "state"), {"city": "Springfield"}),
        (("customer_type", "state"), {}),
        (("month",), {"customer_key": 3, "state": "Oregon"}),
        (("product_key",), {"quarter": 2, "city": "Austin"}),
    ],
)
@pytest.mark.parametrize("which", ["wh", "wide_wh"])
def test_answers_match_brute_force(request, mini, which, group, filters):
    found = nav.answer(request.getfixturevalue(which), "sales", group, filters, ["sum_amount"]).collect()
    assert {tuple(r[:-1]): r[-1] for r in found} == brute_sales(mini, group, filters)


def test_pages_cover_every_row_group_once(wh):
    spec = nav.Pivot(rows=("product_key",), columns=("state",), page_size=4, sort_column=nav.ROW_TOTAL, sort_order="desc")
    counts = nav.pivot_page_counts(wh, spec).first()
    seen = []
    for page in range(1, counts["total_pages"] + 1):
        rows = nav.pivot(wh, nav.replace(spec, page=page)).collect()
        seen += list(dict.fromkeys(r["product_key"] for r in rows))
    whole = nav.pivot(wh, nav.replace(spec, page=None)).collect()
    assert counts["total_rows"] == len(seen) == len(set(seen))
    assert seen == list(dict.fromkeys(r["product_key"] for r in whole))
    for row in whole:
        assert row[nav.ROW_TOTAL] == sum(r["sum_amount"] for r in whole if r["product_key"] == row["product_key"])


def test_same_city_name_in_two_states_stays_apart(wh):
    rows = nav.pivot(wh, nav.Pivot(rows=("state", "city"), page=None)).collect()
    assert {(r["state"], r["city"]) for r in rows} >= {("Ohio", "Springfield"), ("Texas", "Springfield")}


def test_crosstab_fills_cells_and_totals(wh):
    spec = nav.Pivot(rows=("product_key",), columns=("year", "customer_type"))
    labels = nav.column_labels(wh, spec)
    assert labels[0].startswith("2023 | ") and labels[-1].startswith("2024 | ")
    for row in nav.crosstab(wh, spec, labels).collect():
        assert row[nav.ROW_TOTAL] == sum(row[label] for label in labels)
    with pytest.raises(ValueError):
        nav.column_labels(wh, spec, at_most=2)


def test_crosstab_keeps_what_is_not_listed(wh):
    spec = nav.Pivot(rows=("customer_type",), columns=("year",))
    whole = {r["customer_type"]: r for r in nav.crosstab(wh, spec).collect()}
    listed = {r["customer_type"]: r for r in nav.crosstab(wh, spec, ["2024", "1900"]).collect()}
    assert set(whole) == set(listed)
    for kind, row in listed.items():
        assert row[nav.ROW_TOTAL] == whole[kind][nav.ROW_TOTAL] == row["2024"] + row[nav.REMAINDER]
        assert row["1900"] == 0 and row[nav.REMAINDER] == whole[kind]["2023"]
    with pytest.raises(ValueError, match="more than 1"):
        nav.crosstab(wh, spec, at_most=1)
    with pytest.raises(ValueError, match="named like"):
        nav.crosstab(wh, spec, [nav.REMAINDER])


def test_a_page_of_many_row_groups(wh):
    rows = nav.pivot(wh, nav.Pivot(rows=("product_key",), page_size=5000))
    assert rows.count() == nav.pivot(wh, nav.Pivot(rows=("product_key",), page=None)).count()


@pytest.mark.parametrize("descending", [False, True])
def test_deep_pages_are_those_of_the_sorted_rows(spark, monkeypatch, descending):
    monkeypatch.setattr(paging, "SHALLOW_ROWS", 20)
    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 7, if(id % 50 = 1, null, id % 11)) as v").repartition(7)
    order = [*paging.sort_keys(["v"], descending), *paging.sort_keys(["id"])]
    whole = [r.id for r in rows.orderBy(*paging.sort_columns(["v"], descending), *paging.sort_columns(["id"])).collect()]
    for page in (1, 2, 3, 17, 50, 67, 68):
        found = paging.page_of(rows, order, page, 15)
        assert [r.id for r in found.collect()] == whole[(page - 1) * 15 : page * 15]
    assert found.columns == rows.columns


@pytest.mark.parametrize("descending", [False, True])
def test_pages_after_a_row_and_deep_pages_write_nothing(spark, monkeypatch, tmp_path, descending):
    monkeypatch.setattr(paging, "SHALLOW_ROWS", 20)
    path = str(tmp_path / "rows")
    made = spark.range(1000).selectExpr("id", "if(id % 50 = 1, null, cast(id % 11 as decimal(5,2))) as v", "if(id % 3 = 0, 'é', cast(id % 7 as string)) as s")
    made.write.parquet(path)
    rows = spark.read.parquet(path)
    order = [*paging.sort_keys(["v", "s"], descending), *paging.sort_keys(["id"])]
    whole = rows.orderBy(*paging.sort_columns(["v", "s"], descending), *paging.sort_columns(["id"])).collect()
    for at in (30, 333, 960):
        last = whole[at - 1]
        if last.v is None:
            continue
        found = paging.page_after(rows, order, (last.v, last.s, last.id), 40)
        assert [r.id for r in found.collect()] == [r.id for r in whole[at : at + 40]]
        assert "PushedFilters: [" in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        paging.page_after(rows, order, (None, "x", 1), 10)
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = sum(len(files) for _, _, files in os.walk(shared))
    assert [r.id for r in paging.page_of(rows, order, 40, 10).collect()] == [r.id for r in whole[390:400]]
    assert sum(len(files) for _, _, files in os.walk(shared)) == before


def test_searches_return_what_is_asked_for(wh):
    assert filters.search_customers(wh, limit=100_000).count() == filters.search_customers(wh, limit=12).count()
    for search in (filters.search_customers, filters.search_stores):
        with pytest.raises(ValueError):
            search(wh, limit=0)


def test_results_are_sorted(wh):
    """The checks against SQL do not see order."""
    spec = nav.Pivot(rows=("state",), columns=("year",), sort_column=nav.ROW_TOTAL, sort_order="desc", page=None)
    totals = [r[nav.ROW_TOTAL] for r in nav.pivot(wh, spec).collect()]
    assert totals == sorted(totals, reverse=True)
    alone = nav.replace(spec, columns=())
    totals = [r[nav.ROW_TOTAL] for r in nav.pivot(wh, alone).collect()]
    assert totals == sorted(totals, reverse=True)
    assert nav.pivot(wh, nav.replace(alone, page=2, page_size=1)).first()[nav.ROW_TOTAL] == totals[1]
    years = [r["year"] for r in filters.years(wh).collect()]
    assert years == sorted(years, reverse=True)
    trend = sales.trend(wh, "month").collect()
    assert [(r["year"], r["month"]) for r in trend] == sorted((r["year"], r["month"]) for r in trend)


def test_axes_operators():
    spec = nav.Pivot(rows=("year",), columns=("state",))
    assert nav.swap_axes(spec).rows == ("state",)
    assert nav.drill_down(spec, "quarter").rows == ("year", "quarter")
    assert nav.roll_up(nav.drill_down(spec, "quarter")) == spec
    assert nav.roll_up(nav.Pivot()).rows == ()


def test_requests_are_checked(wh):
    for bad in (nav.Pivot(rows=("planet",)), nav.Pivot(measures=("profit",))):
        with pytest.raises(ValueError):
            nav.pivot(wh, bad)
    with pytest.raises(ValueError):
        nav.drill_through(wh, "sales", {})
    with pytest.raises(ValueError):
        nav.drill_across(wh, [])
    with pytest.raises(ValueError):
        nav.raw_rows(wh, "sales", page=0)


def test_the_stock_cube_has_one_measure(wh):
    assert nav.Pivot(rows=("year",), cube="inventory").measures == ("total_quantity_on_hand",)
    with pytest.raises(ValueError):
        nav.pivot(wh, nav.Pivot(cube="inventory", measures=("profit",)))


def test_drill_across_keeps_one_sided_rows(spark):
    wh = star_of(spark, [(202401, 1, 4)], [(202402, 1, 9)])
    rows = nav.drill_across(wh, ["year", "month"]).orderBy("month").collect()
    assert [tuple(r) for r in rows] == [(2024, 1, Decimal("4.00"), None), (2024, 2, None, 9)]


def test_base_tables_of_the_raw_pages(wh):
    for cube, base in nav.BASE_TABLE.items():
        assert base in LATTICES[cube]
    first = nav.raw_rows(wh, "sales", page_size=3).collect()
    assert [r["sum_amount"] for r in first] == sorted((r["sum_amount"] for r in first), reverse=True)
