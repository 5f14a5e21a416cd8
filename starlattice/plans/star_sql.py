"""Check SQL for the star tables and cuboids, written straight from the given tables.

Amounts are summed as decimals and shown as doubles on both sides.
"""

from __future__ import annotations

from collections.abc import Iterable

STAR = """
WITH location AS (
  SELECT n_nationkey AS location_key, n_name AS city, r_name AS state,
         n_name || ', ' || r_name AS office_address
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
store AS (
  SELECT s_suppkey AS store_key, s_name AS phone_number, s_nationkey AS location_key
  FROM supplier WHERE s_nationkey IN (SELECT location_key FROM location)
),
buyer AS (
  SELECT c_custkey AS customer_key, c_name AS customer_name,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Both' WHEN 'FURNITURE' THEN 'MailOrder'
              WHEN 'AUTOMOBILE' THEN 'Tourist' WHEN 'BUILDING' THEN 'Tourist'
              ELSE 'Unknown' END AS customer_type,
         first_order_date, c_nationkey AS location_key
  FROM customer
  JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_order_date
        FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
),
sales AS (
  SELECT CAST(YEAR(o_orderdate) * 100 + MONTH(o_orderdate) AS INTEGER) AS time_key,
         l_partkey AS product_key, o_custkey AS customer_key,
         SUM(CAST(l_quantity AS INTEGER)) AS quantity,
         SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2, 3
),
stock AS (
  SELECT CAST(YEAR(l_shipdate) * 100 + MONTH(l_shipdate) AS INTEGER) AS time_key,
         l_suppkey AS store_key, l_partkey AS product_key,
         SUM(CAST(l_quantity AS INTEGER)) AS on_hand
  FROM lineitem GROUP BY 1, 2, 3
),
months AS (
  SELECT time_key, CAST(time_key // 100 AS INTEGER) AS year,
         CAST((time_key % 100 + 2) // 3 AS INTEGER) AS quarter,
         CAST(time_key % 100 AS INTEGER) AS month
  FROM (SELECT time_key FROM sales UNION SELECT time_key FROM stock UNION SELECT 200112)
),
sold AS (
  SELECT year, quarter, month, time_key, product_key, customer_key, customer_name, customer_type,
         state, city, quantity, amount
  FROM sales JOIN months USING (time_key) JOIN buyer USING (customer_key) JOIN location USING (location_key)
),
kept AS (
  SELECT year, quarter, month, time_key, product_key, store_key, state, city, on_hand
  FROM stock JOIN months USING (time_key) JOIN store USING (store_key) JOIN location USING (location_key)
)
"""

TIME = ("year", "quarter", "month")
SALES_SUMS = "CAST(SUM(quantity) AS BIGINT) AS total_quantity, CAST(SUM(amount) AS DOUBLE) AS sum_amount"
STOCK_SUM = "CAST(SUM(on_hand) AS BIGINT) AS total_quantity_on_hand"


def listed(columns: Iterable[str], after: str = "") -> str:
    return "".join(f"{c}, " for c in columns) + after


def grouped(columns: Iterable[str]) -> str:
    columns = list(columns)
    return f" GROUP BY {', '.join(columns)}" if columns else ""


def clause(where: str | None) -> str:
    return f" WHERE {where}" if where else ""


def sales_by(columns: Iterable[str], where: str | None = None) -> str:
    """A select of sales sums, to follow the star's common table expressions."""
    columns = tuple(columns)
    if set(columns) & {"customer_type", "state", "city", "customer_name"} or (where and "city" in where):
        source = "sold"
    else:
        source = "sales JOIN months USING (time_key)" if set(columns) & set(TIME) or where else "sales"
    if where and any(w in where for w in ("state", "customer_type")):
        source = "sold"
    return f"SELECT {listed(columns, SALES_SUMS)} FROM {source}{clause(where)}{grouped(columns)}"


def stock_by(columns: Iterable[str], where: str | None = None) -> str:
    """A select of the latest stock per product, store and selected time, summed."""
    columns = tuple(columns)
    grain = ", ".join(["product_key", "store_key", *[c for c in columns if c in TIME]])
    latest = (
        f"SELECT * FROM kept{clause(where)} "
        f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {grain} ORDER BY time_key DESC) = 1"
    )
    return f"SELECT {listed(columns, STOCK_SUM)} FROM ({latest}){grouped(columns)}"
