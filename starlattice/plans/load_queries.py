"""Extracts, star tables, upserts and load reports."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlattice.operators import star, upsert
from starlattice.operators.conform import conform
from starlattice.plans.registry import on_star, on_tables
from starlattice.schemas import PRIMARY_KEYS, SOURCE_SCHEMAS
from starlattice.sources import given_tables
from starlattice.sources.files import read_csv
from starlattice.sources.warehouse import AS_OF, Warehouse, conformed, open_warehouse

# --- extracts ---------------------------------------------------------------

LINES_SQL = (
    "SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS ordered_quantity, "
    "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS line_amount, "
    "CAST(l_shipdate AS DATE) AS last_updated_time FROM lineitem"
)
EXTRACT_SQL = {
    "representative_office": (
        "SELECT n_nationkey AS city_id, TRIM(n_name) AS city_name, n_name || ', ' || r_name AS office_address, "
        "r_name AS state, DATE '1995-01-01' AS last_updated_time "
        "FROM nation JOIN region ON n_regionkey = r_regionkey"
    ),
    "store": (
        "SELECT s_suppkey AS store_id, s_name AS phone_number, DATE '1995-01-01' AS last_updated_time, "
        "s_nationkey AS city_id FROM supplier"
    ),
    "product": (
        "SELECT p_partkey AS product_id, TRIM(p_name) AS description, UPPER(p_type) AS size, "
        "CAST(p_size AS DOUBLE) AS weight, ROUND(p_retailprice, 2) AS price, "
        "DATE '1995-01-01' AS last_updated_time FROM part"
    ),
    "order": (
        "SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date FROM orders"
    ),
    "order_product": LINES_SQL,
    "stocked_product": (
        "SELECT l_suppkey AS store_id, l_partkey AS product_id, "
        "CAST(SUM(CAST(l_quantity AS INTEGER)) AS INTEGER) AS stock_quantity, "
        "MAX(CAST(l_shipdate AS DATE)) AS last_updated_time FROM lineitem GROUP BY 1, 2"
    ),
    "customer": (
        "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS city_id, first_order_date "
        "FROM customer JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_order_date "
        "FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey"
    ),
    "tourist_customer": (
        "SELECT c_custkey AS customer_id, TRIM(c_name) AS tour_guide, DATE '1995-01-01' AS last_updated_time "
        "FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD')"
    ),
    "mail_order_customer": (
        "SELECT c_custkey AS customer_id, TRIM(c_name || ', ' || c_mktsegment) AS postal_address, "
        "DATE '1995-01-01' AS last_updated_time FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE')"
    ),
}


def _register_extract(table: str) -> None:
    on_tables(f"extract_{table}", lambda spark, folder: conformed(spark, folder, table), EXTRACT_SQL[table])


for _table in EXTRACT_SQL:
    _register_extract(_table)

SECOND_LOAD = date(1999, 1, 1)


def _since(table: str):
    return lambda spark, folder: conform(given_tables.SOURCES[table](spark, folder), table, SECOND_LOAD)


on_tables(
    "extract_order_since_mark",
    _since("order"),
    f"SELECT * FROM ({EXTRACT_SQL['order']}) WHERE order_date >= DATE '1999-01-01'",
)
on_tables(
    "extract_order_product_since_mark",
    _since("order_product"),
    f"SELECT * FROM ({LINES_SQL}) WHERE last_updated_time >= DATE '1999-01-01'",
)

# --- CSV files --------------------------------------------------------------


def through_csv(table: str):
    """The table written as CSV files to the shared folder and read back by its declared schema."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        root = open_warehouse(spark, folder).root
        source = given_tables.SOURCES[table](spark, folder)
        if root is None:
            raise ValueError("CSV files need the shared folder that spark.checkpoint.dir names")
        path = f"{root}/csv/{table}-{uuid.uuid4().hex[:12]}"
        columns = [c.split(" ")[0] for c in SOURCE_SCHEMAS[table].split(", ")]
        quoted = source.select(*columns).write.option("header", True).option("escape", '"')
        quoted.csv(path)
        read = conform(read_csv(spark, path, table), table)
        kinds = dict(conform(source, table).dtypes)
        return read.select(*[F.col(c).cast(kinds[c]).alias(c) for c in read.columns])

    return run


on_tables("csv_order", through_csv("order"), EXTRACT_SQL["order"])
on_tables("csv_quoted_mail_order_customer", through_csv("mail_order_customer"), EXTRACT_SQL["mail_order_customer"])
on_tables("csv_product", through_csv("product"), EXTRACT_SQL["product"])

# --- star tables ------------------------------------------------------------

on_tables(
    "dim_time_of_orders",
    lambda spark, folder: star.dim_time(conformed(spark, folder, "order"), AS_OF),
    "SELECT CAST(YEAR(d) * 100 + MONTH(d) AS INTEGER) AS time_key, CAST(MONTH(d) AS INTEGER) AS month, "
    "CAST(QUARTER(d) AS INTEGER) AS quarter, CAST(YEAR(d) AS INTEGER) AS year "
    "FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT TIMESTAMP '2001-12-31') GROUP BY 1, 2, 3, 4",
)
on_star("dim_time", lambda wh: wh.table("dim_time"), "SELECT time_key, month, quarter, year FROM months")
on_star(
    "dim_location",
    lambda wh: wh.table("dim_location"),
    "SELECT location_key, city, state, office_address FROM location",
)
on_star("dim_store", lambda wh: wh.table("dim_store"), "SELECT store_key, phone_number, location_key FROM store")
on_star(
    "dim_customer",
    lambda wh: wh.table("dim_customer"),
    "SELECT customer_key, customer_name, customer_type, first_order_date, location_key FROM buyer",
)
on_star(
    "dim_product",
    lambda wh: wh.table("dim_product"),
    "SELECT p_partkey AS product_key, p_name AS description, p_type AS size, CAST(p_size AS DOUBLE) AS weight FROM part",
)
FACT_SALES_SQL = (
    "SELECT time_key, product_key, customer_key, CAST(quantity AS BIGINT) AS quantity_ordered, "
    "CAST(amount AS DOUBLE) AS total_amount FROM sales"
)
FACT_INVENTORY_SQL = (
    "SELECT time_key, store_key, product_key, CAST(on_hand AS BIGINT) AS quantity_on_hand FROM stock"
)
on_star("fact_sales", lambda wh: wh.table("fact_sales"), FACT_SALES_SQL)
on_star("fact_inventory_by_month", lambda wh: wh.table("fact_inventory"), FACT_INVENTORY_SQL)
on_tables(
    "fact_inventory_stamped",
    lambda spark, folder: star.fact_inventory(conformed(spark, folder, "stocked_product")),
    "SELECT (SELECT CAST(YEAR(MAX(l_shipdate)) * 100 + MONTH(MAX(l_shipdate)) AS INTEGER) FROM lineitem) AS time_key, "
    "l_suppkey AS store_key, l_partkey AS product_key, "
    "CAST(SUM(CAST(l_quantity AS INTEGER)) AS INTEGER) AS quantity_on_hand FROM lineitem GROUP BY 2, 3",
)

# --- upserts: a first load and a second one that overlaps it ------------------

FIRST_END = date(2000, 1, 1)


def two_order_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = conformed(spark, folder, "order")
    first = orders.where(F.col("order_date") < F.lit(FIRST_END)).withColumn("loaded_by", F.lit("first"))
    second = orders.where(F.col("order_date") >= F.lit(SECOND_LOAD)).withColumn("loaded_by", F.lit("second"))
    return first, second


def orders_loaded_twice(spark: SparkSession, folder: str) -> DataFrame:
    first, second = two_order_loads(spark, folder)
    return upsert.upsert(first, second, "order", PRIMARY_KEYS["order"])


on_tables(
    "upsert_orders_if_absent",
    orders_loaded_twice,
    f"SELECT *, CASE WHEN order_date < DATE '2000-01-01' THEN 'first' ELSE 'second' END AS loaded_by "
    f"FROM ({EXTRACT_SQL['order']})",
)


def two_line_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = conformed(spark, folder, "order_product")
    key = PRIMARY_KEYS["order_product"]
    early = lines.where(F.col("last_updated_time") < F.lit(SECOND_LOAD))
    late = lines.where(F.col("last_updated_time") >= F.lit(SECOND_LOAD))
    return upsert.first_per_key(early, key, ["last_updated_time"]), late


def lines_loaded_twice(spark: SparkSession, folder: str) -> DataFrame:
    first, second = two_line_loads(spark, folder)
    return upsert.upsert(first, second, "order_product", PRIMARY_KEYS["order_product"], ["last_updated_time"])


on_tables(
    "upsert_order_lines_if_absent",
    lines_loaded_twice,
    f"SELECT * FROM ({LINES_SQL}) QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, product_id "
    "ORDER BY last_updated_time, ordered_quantity, line_amount) = 1",
)

REPRICED = date(2002, 1, 1)
FIRST_PRICES = 1500


def two_product_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Products below a price first, then every product dearer, resized and dated later."""
    products = conformed(spark, folder, "product")
    dearer = products.withColumns(
        {
            "price": (F.col("price") + 1).cast("decimal(10,2)"),
            "size": F.lit("RESIZED"),
            "last_updated_time": F.lit(REPRICED),
        }
    )
    return products.where(F.col("price") < FIRST_PRICES), dearer


def products_updated(spark: SparkSession, folder: str) -> DataFrame:
    first, second = two_product_loads(spark, folder)
    return upsert.upsert(first, second, "product", PRIMARY_KEYS["product"], ["last_updated_time"])


on_tables(
    "upsert_product_named_columns",
    products_updated,
    "SELECT p_partkey AS product_id, TRIM(p_name) AS description, "
    "CASE WHEN p_retailprice < 1500 THEN UPPER(p_type) ELSE 'RESIZED' END AS size, "
    "CAST(p_size AS DOUBLE) AS weight, "
    "CAST(CAST(p_retailprice AS DECIMAL(10,2)) + 1 AS DOUBLE) AS price, "
    "DATE '2002-01-01' AS last_updated_time FROM part",
)


def two_sales_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines, orders = conformed(spark, folder, "order_product"), conformed(spark, folder, "order")
    early = lines.where(F.col("last_updated_time") < F.lit(SECOND_LOAD))
    late = lines.where(F.col("last_updated_time") >= F.lit(SECOND_LOAD))
    return star.fact_sales(early, orders), star.fact_sales(late, orders)


def sales_added(spark: SparkSession, folder: str) -> DataFrame:
    first, second = two_sales_loads(spark, folder)
    return upsert.upsert(first, second, "fact_sales", PRIMARY_KEYS["fact_sales"])


on_star("upsert_fact_sales_additive", lambda wh: sales_added(wh.spark, wh.folder), FACT_SALES_SQL)

RESTATED_FROM = 200001


def stock_restated(wh: Warehouse) -> DataFrame:
    """Months from 2000 on arrive again with doubled quantities."""
    stock = wh.table("fact_inventory")
    restated = stock.where(F.col("time_key") >= RESTATED_FROM).withColumn(
        "quantity_on_hand", F.col("quantity_on_hand") * 2
    )
    return upsert.upsert(stock, restated, "fact_inventory", PRIMARY_KEYS["fact_inventory"])


on_star(
    "upsert_fact_inventory_replaced",
    stock_restated,
    "SELECT time_key, store_key, product_key, "
    "CAST(CASE WHEN time_key >= 200001 THEN on_hand * 2 ELSE on_hand END AS BIGINT) AS quantity_on_hand FROM stock",
)


def counts_of_loads(spark: SparkSession, folder: str) -> DataFrame:
    loads = {
        "order": (two_order_loads(spark, folder), False),
        "order_product": (two_line_loads(spark, folder), False),
        "product": (two_product_loads(spark, folder), True),
        "fact_sales": (two_sales_loads(spark, folder), True),
    }
    lines = [
        upsert.load_counts(old, batch, PRIMARY_KEYS[table], updates=updates).select(
            F.lit(table).alias("table_name"), "rows_inserted", "rows_updated"
        )
        for table, ((old, batch), updates) in loads.items()
    ]
    report = lines[0]
    for line in lines[1:]:
        report = report.unionByName(line)
    return report


_EARLY_SALES = (
    "SELECT DISTINCT YEAR(o_orderdate) * 100 + MONTH(o_orderdate), l_partkey, o_custkey "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate {} TIMESTAMP '1999-01-01'"
)
on_tables(
    "upsert_counts",
    counts_of_loads,
    "SELECT 'order' AS table_name, COUNT(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated "
    "FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' "
    "UNION ALL SELECT 'order_product', COUNT(*), 0 FROM ("
    "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' "
    "EXCEPT SELECT l_orderkey, l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01') "
    "UNION ALL SELECT 'product', COUNT(*) FILTER (p_retailprice >= 1500), COUNT(*) FILTER (p_retailprice < 1500) FROM part "
    f"UNION ALL SELECT 'fact_sales', (SELECT COUNT(*) FROM ({_EARLY_SALES.format('>=')} EXCEPT {_EARLY_SALES.format('<')})), "
    f"(SELECT COUNT(*) FROM ({_EARLY_SALES.format('>=')} INTERSECT {_EARLY_SALES.format('<')}))",
)


def marks_of_tables(spark: SparkSession, folder: str) -> DataFrame:
    lines = [
        upsert.high_water_mark(conformed(spark, folder, table), column).select(
            F.lit(table).alias("table_name"), "mark"
        )
        for table, column in CHANGE_COLUMNS.items()
    ]
    report = lines[0]
    for line in lines[1:]:
        report = report.unionByName(line)
    return report


CHANGE_COLUMNS = {
    "order": "order_date",
    "order_product": "last_updated_time",
    "stocked_product": "last_updated_time",
    "customer": "first_order_date",
    "product": "last_updated_time",
}
_NEWEST_SQL = {
    "order": "SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders",
    "order_product": "SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem",
    "stocked_product": "SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem",
    "customer": "SELECT MAX(d) FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS d FROM orders "
    "JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey)",
    "product": "SELECT MAX(DATE '1995-01-01') FROM part",
}
on_tables(
    "high_water_marks",
    marks_of_tables,
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, ({sql}) AS mark" for t, sql in _NEWEST_SQL.items()),
)

FRESH_AS_OF = datetime(2001, 8, 3)


def freshness_of_tables(spark: SparkSession, folder: str) -> DataFrame:
    tables = {t: (conformed(spark, folder, t), c) for t, c in CHANGE_COLUMNS.items()}
    return upsert.freshness(tables, FRESH_AS_OF).withColumn("last_refreshed", F.col("last_refreshed").cast("date"))


on_tables(
    "freshness",
    freshness_of_tables,
    "SELECT data_object, last_refreshed, CASE WHEN last_refreshed IS NULL THEN 'never loaded' "
    "WHEN last_refreshed < TIMESTAMP '2001-08-03' - INTERVAL 2 DAY THEN 'stale (>2d)' ELSE 'fresh' END AS freshness FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS data_object, ({sql}) AS last_refreshed" for t, sql in _NEWEST_SQL.items())
    + ")",
)

STAR_TABLES = ("dim_customer", "dim_location", "dim_product", "dim_store", "dim_time", "fact_inventory", "fact_sales")


def profile(wh: Warehouse) -> DataFrame:
    loaded = {t: conformed(wh.spark, wh.folder, t) for t in EXTRACT_SQL}
    return upsert.table_profile({**loaded, **{t: wh.table(t) for t in STAR_TABLES}})


on_star(
    "table_profile",
    profile,
    " UNION ALL ".join(
        f"SELECT '{name}' AS object_name, COUNT(*) AS row_count FROM ({sql})"
        for name, sql in {
            **EXTRACT_SQL,
            "dim_customer": "FROM buyer",
            "dim_location": "FROM location",
            "dim_product": "FROM part",
            "dim_store": "FROM store",
            "dim_time": "FROM months",
            "fact_inventory": "FROM stock",
            "fact_sales": "FROM sales",
        }.items()
    ),
)

STORED_TABLES = ("dim_customer", "dim_location", "dim_store", "dim_time", "fact_inventory", "fact_sales")


def profile_of_stored(wh: Warehouse) -> DataFrame:
    paths = wh.stored_paths(STORED_TABLES)
    if len(paths) < len(STORED_TABLES):
        return upsert.table_profile({t: wh.table(t) for t in STORED_TABLES})
    return upsert.footer_profile(wh.spark, paths)


on_star(
    "table_profile_from_footers",
    profile_of_stored,
    " UNION ALL ".join(
        f"SELECT '{name}' AS object_name, COUNT(*) AS row_count FROM {source}"
        for name, source in zip(STORED_TABLES, ("buyer", "location", "store", "months", "stock", "sales"))
    ),
)
