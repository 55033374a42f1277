"""The same KPIs as Spark SQL text, written apart from the DataFrame path.

Tables are passed to spark.sql by name, so no global views are needed. Orders are summed before
they are counted, which replaces two distinct aggregates by plain ones. Global ranks and the
median are not written as windows over everything but added by the numbering operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.model import Warehouse
from orderloom.operators.numbering import (
    Rank,
    median,
    row_positions,
    top_rows,
    with_ranks,
)

EXECUTIVE_SUMMARY = """
WITH orders AS (
    SELECT customer_key, transaction_id,
        sum(revenue) AS revenue, sum(profit) AS profit, sum(quantity) AS quantity
    FROM {fact_sales}
    GROUP BY customer_key, transaction_id
), customers AS (
    SELECT customer_key, count(*) AS order_count,
        sum(revenue) AS revenue, sum(profit) AS profit, sum(quantity) AS quantity
    FROM orders
    GROUP BY customer_key
)
SELECT
    double(sum(revenue)) AS total_revenue,
    double(sum(profit)) AS total_profit,
    double(sum(profit)) / nullif(double(sum(revenue)), 0) AS gross_margin,
    coalesce(sum(order_count), 0) AS transactions,
    sum(quantity) AS units_sold,
    double(sum(revenue)) / nullif(sum(order_count), 0) AS average_order_value,
    double(sum(revenue)) / nullif(count(*), 0) AS average_revenue_per_customer,
    count(*) AS unique_customers,
    count_if(order_count >= 2) AS repeat_customers,
    double(count_if(order_count >= 2)) / nullif(count(*), 0) AS repeat_customer_rate
FROM customers
"""



def _growth(totals: str, segment: str, shown: list[str], order: str) -> str:
    """Text that pairs each year's totals with those of the segment's sales year before.

    `totals` selects segment, sales_year, earned and kept (whole sums of revenue and profit).
    """
    change = "(now.{0} - past.{0}) / nullif(past.{0}, 0)"
    columns = {
        "segment": f"now.segment AS {segment}",
        "year": "now.sales_year AS year",
        "revenue": "now.earned AS revenue",
        "profit": "now.kept AS profit",
        "gross_margin": "now.kept / nullif(now.earned, 0) AS gross_margin",
        "revenue_yoy_growth": change.format("earned") + " AS revenue_yoy_growth",
        "profit_yoy_growth": change.format("kept") + " AS profit_yoy_growth",
    }
    return f"""
WITH totals AS ({totals}), placed AS (
    SELECT segment, sales_year, double(earned) AS earned, double(kept) AS kept,
        row_number() OVER (PARTITION BY segment ORDER BY sales_year) AS place
    FROM totals
)
SELECT {", ".join(columns[name] for name in shown)}
FROM placed AS now
LEFT JOIN placed AS past ON past.segment = now.segment AND past.place = now.place - 1
ORDER BY {order}
"""


_GROWTHS = ["revenue_yoy_growth", "profit_yoy_growth"]

# Days are summed before the calendar is joined, keys before their names.
ANNUAL = _growth(
    """
    SELECT 'all' AS segment, year AS sales_year, sum(earned) AS earned, sum(kept) AS kept
    FROM (
        SELECT date_key, sum(revenue) AS earned, sum(profit) AS kept
        FROM {fact_sales} GROUP BY date_key
    ) JOIN {dim_date} USING (date_key)
    GROUP BY year""",
    "segment",
    ["year", "revenue", "profit", "gross_margin", *_GROWTHS],
    "year",
)

CATEGORY_ANNUAL = _growth(
    """
    SELECT category_name AS segment, sales_year, sum(earned) AS earned, sum(kept) AS kept
    FROM (
        SELECT product_key, year AS sales_year, sum(revenue) AS earned, sum(profit) AS kept
        FROM {fact_sales} JOIN {dim_date} USING (date_key)
        GROUP BY product_key, year
    ) JOIN {dim_product} USING (product_key) JOIN {dim_category} USING (category_key)
    GROUP BY category_name, sales_year""",
    "category_name",
    ["segment", "year", "revenue", "profit", "revenue_yoy_growth"],
    "category_name, year",
)

REGION_ANNUAL = _growth(
    """
    SELECT region AS segment, sales_year, sum(earned) AS earned, sum(kept) AS kept
    FROM (
        SELECT customer_key, year AS sales_year, sum(revenue) AS earned, sum(profit) AS kept
        FROM {fact_sales} JOIN {dim_date} USING (date_key)
        GROUP BY customer_key, year
    ) JOIN {dim_customer} USING (customer_key)
    GROUP BY region, sales_year""",
    "region",
    ["segment", "year", "revenue", "profit", "gross_margin", *_GROWTHS],
    "year, revenue_yoy_growth DESC NULLS LAST",
)

MONTHLY = """
WITH orders AS (
    SELECT transaction_id, date_key, sum(revenue) AS revenue, sum(profit) AS profit
    FROM {fact_sales}
    GROUP BY transaction_id, date_key
)
SELECT trunc(dates.full_date, 'MM') AS month,
    double(sum(revenue)) AS revenue,
    double(sum(profit)) AS profit,
    double(sum(profit)) / nullif(double(sum(revenue)), 0) AS gross_margin,
    count(*) AS transactions
FROM orders
JOIN {dim_date} AS dates USING (date_key)
GROUP BY 1
ORDER BY month
"""

PRODUCTS = """
WITH sums AS (
    SELECT product_key, sum(revenue) AS revenue, sum(profit) AS profit, sum(quantity) AS quantity
    FROM {fact_sales}
    GROUP BY product_key
)
SELECT products.product_id, products.product_name, categories.category_name,
    double(revenue) AS revenue,
    double(profit) AS profit,
    double(profit) / nullif(double(revenue), 0) AS gross_margin,
    quantity AS units_sold
FROM sums
JOIN {dim_product} AS products USING (product_key)
JOIN {dim_category} AS categories USING (category_key)
"""

PRODUCT_SUMS = """
SELECT product_key, sum(revenue) AS revenue, sum(profit) AS profit
FROM {fact_sales}
GROUP BY product_key
"""

WEAK_MARGINS = """
SELECT products.product_id, products.product_name,
    double(sums.revenue) AS revenue,
    double(sums.profit) AS profit,
    double(sums.profit) / nullif(double(sums.revenue), 0) AS margin
FROM {sums} AS sums
JOIN {dim_product} AS products USING (product_key)
WHERE double(sums.revenue) >= (SELECT median FROM {middle})
  AND double(sums.profit) / nullif(double(sums.revenue), 0) < (
      SELECT double(sum(profit)) / nullif(double(sum(revenue)), 0) FROM {fact_sales}
  )
ORDER BY margin, revenue DESC
"""

CHANNELS = """
WITH orders AS (
    SELECT channel_key, customer_key, transaction_id,
        sum(revenue) AS revenue, sum(profit) AS profit, sum(quantity) AS quantity
    FROM {fact_sales}
    GROUP BY channel_key, customer_key, transaction_id
)
SELECT channels.channel_name,
    double(sum(revenue)) AS revenue,
    double(sum(profit)) AS profit,
    double(sum(profit)) / nullif(double(sum(revenue)), 0) AS gross_margin,
    count(*) AS transactions,
    double(sum(revenue)) / nullif(count(*), 0) AS average_order_value,
    sum(quantity) AS units_sold,
    count(DISTINCT customer_key) AS unique_customers
FROM orders
JOIN {dim_channel} AS channels USING (channel_key)
GROUP BY channels.channel_name
ORDER BY revenue DESC
"""

CUSTOMERS = """
WITH orders AS (
    SELECT customer_key, transaction_id, sum(revenue) AS revenue, sum(profit) AS profit
    FROM {fact_sales}
    GROUP BY customer_key, transaction_id
), sums AS (
    SELECT customer_key, sum(revenue) AS revenue, sum(profit) AS profit, count(*) AS transactions
    FROM orders
    GROUP BY customer_key
)
SELECT customers.customer_id, customers.region,
    double(sums.revenue) AS lifetime_revenue,
    double(sums.profit) AS lifetime_profit,
    sums.transactions,
    double(sums.revenue)
        / nullif((SELECT double(sum(revenue)) FROM {fact_sales}), 0) AS revenue_share
FROM sums
JOIN {dim_customer} AS customers USING (customer_key)
"""

CUSTOMER_REVENUE = """
SELECT customer_key, sum(revenue) AS revenue FROM {fact_sales} GROUP BY customer_key
"""

CONCENTRATION = """
SELECT double(sum(revenue)) AS top_revenue,
    double(sum(revenue))
        / nullif((SELECT double(sum(revenue)) FROM {fact_sales}), 0) AS top_revenue_share
FROM {best}
"""


def _run(warehouse: Warehouse, text: str, **frames: DataFrame) -> DataFrame:
    used = {name: table for name, table in warehouse.tables().items() if f"{{{name}}}" in text}
    return warehouse.spark.sql(text, **used, **frames)


def executive_summary(warehouse: Warehouse) -> DataFrame:
    return _run(warehouse, EXECUTIVE_SUMMARY)


def annual(warehouse: Warehouse) -> DataFrame:
    return _run(warehouse, ANNUAL)


def monthly(warehouse: Warehouse) -> DataFrame:
    return _run(warehouse, MONTHLY)


def category_annual(warehouse: Warehouse) -> DataFrame:
    return _run(warehouse, CATEGORY_ANNUAL)


def products(warehouse: Warehouse) -> DataFrame:
    ranks = [
        Rank("revenue_rank", "revenue", dense=False),
        Rank("profit_rank", "profit", dense=False),
        Rank("bottom_profit_rank", "profit", descending=False, dense=False),
    ]
    ranked = with_ranks(_run(warehouse, PRODUCTS), ranks)
    return ranked.orderBy("revenue_rank", "product_id")


def weak_margins(warehouse: Warehouse) -> DataFrame:
    sums = _run(warehouse, PRODUCT_SUMS)
    middle = median(sums, "revenue")
    return _run(warehouse, WEAK_MARGINS, sums=sums, middle=middle)


def region_annual(warehouse: Warehouse) -> DataFrame:
    return _run(warehouse, REGION_ANNUAL)


def channels(warehouse: Warehouse) -> DataFrame:
    return _run(warehouse, CHANNELS)


def customers(warehouse: Warehouse) -> DataFrame:
    order = [F.col("lifetime_revenue").desc(), F.col("customer_id").asc()]
    ranked = row_positions(_run(warehouse, CUSTOMERS), order, "revenue_rank")
    return ranked.orderBy("revenue_rank")


def concentration(warehouse: Warehouse, n: int = 10) -> DataFrame:
    sums = _run(warehouse, CUSTOMER_REVENUE)
    best = top_rows(sums, [F.col("revenue").desc(), F.col("customer_key")], n)
    return _run(warehouse, CONCENTRATION, best=best)
