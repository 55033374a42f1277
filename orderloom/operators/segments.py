"""Segment aggregates shared by every KPI, and year-over-year growth."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import dates, money
from orderloom.operators.model import Warehouse
from orderloom.sources.staging import stage

SUMS = ["revenue", "profit", "quantity"]


# The keys by which a customer's sales are split, and GROUPING_ID of (year, month, channel_key).
CUSTOMER_PARTS = {(): 7, ("year",): 3, ("month",): 5, ("channel_key",): 6}


@dataclass(frozen=True)
class CustomerGrain(Warehouse):
    """A warehouse whose fact holds one row per customer; `parts` has the sums behind every segment.

    A part is a customer's sales in all, in a year, in a month or through a channel, in cents.
    """

    parts: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: table for name, table in super().tables().items() if name != "parts"}


def customer_grain(warehouse: Warehouse) -> CustomerGrain:
    """Roll the fact up once for all KPIs that do not look at products.

    Lines shrink to orders, and orders to customers by grouping sets: one scan and two exchanges with
    map-side partial sums serve the overview, years, months, channels, regions and customers.
    """
    days = warehouse.dim_date.select(
        "date_key", "year", dates.month_start(F.col("full_date")).alias("month")
    )
    keys = ["transaction_id", "date_key", "customer_key", "channel_key"]
    orders = warehouse.fact_sales.groupBy(*keys).agg(*_cent_sums())
    # Sales on unknown days count in all but their year and month.
    orders = orders.join(days, "date_key", "left")
    columns = ["year", "month", "channel_key"]
    sets = [["customer_key", *part] for part in CUSTOMER_PARTS]
    parts = orders.groupingSets(sets, "customer_key", *columns).agg(
        F.grouping_id().cast("int").alias("part"),
        *_sums(),
        F.count(F.lit(1)).alias("transactions"),
    )
    staged = stage(parts, "customer-parts")
    tables = warehouse.tables()
    return CustomerGrain(**{**tables, "fact_sales": _part(staged, ())}, parts=staged)


def _part(parts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    dated = [name for name in keys if name in DATE_ATTRIBUTES]
    rows = parts.where(F.col("part") == CUSTOMER_PARTS[keys]).dropna(subset=dated or ["part"])
    return _in_dollars(rows.select("customer_key", *keys, *SUMS, "transactions"))


DATE_ATTRIBUTES = ["year", "month"]
CUSTOMER_ATTRIBUTES = ["customer_id", "region"]


def _cent_sums() -> list[Column]:
    amounts = [money.sum_cents(name) for name in ("revenue", "profit")]
    return [*amounts, F.sum("quantity").alias("quantity")]


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in SUMS]


def _in_dollars(sums: DataFrame) -> DataFrame:
    return sums.withColumns({name: money.dollars(F.col(name)) for name in ("revenue", "profit")})


def _early_keys(warehouse: Warehouse, by: list[str]) -> tuple[DataFrame, list[str]]:
    """Fact lines with the narrow columns that stand for all but the customer attributes."""
    lines = warehouse.fact_sales
    keys = [name for name in by if name in DATE_ATTRIBUTES]
    if keys:
        days = warehouse.dim_date.select(
            "date_key", "year", dates.month_start(F.col("full_date")).alias("month")
        )
        lines = lines.join(days.select("date_key", *keys), "date_key")
    if "product_id" in by:
        keys.append("product_key")
    elif "category_name" in by:
        products = warehouse.dim_product.select("product_key", "category_key")
        lines = lines.join(products, "product_key")
        keys.append("category_key")
    if "channel_name" in by:
        keys.append("channel_key")
    return lines, keys


def customer_totals(warehouse: Warehouse, by: list[str] | None = None) -> DataFrame:
    """One row per customer key and segment key: sums and number of orders.

    Lines shrink to orders and orders to customers, each step with map-side partial sums, so a hot
    order, customer or segment costs one row per task. An order has exactly one customer, which
    makes both counts exact without a distinct aggregate.
    """
    if isinstance(warehouse, CustomerGrain):
        named = {"channel_name": "channel_key"}
        wanted = [named.get(name, name) for name in by or [] if name not in CUSTOMER_ATTRIBUTES]
        return _part(warehouse.parts, tuple(wanted))
    lines, keys = _early_keys(warehouse, by or [])
    orders = lines.groupBy("transaction_id", "customer_key", *keys).agg(*_cent_sums())
    customers = orders.groupBy("customer_key", *keys).agg(
        *_sums(), F.count(F.lit(1)).alias("transactions")
    )
    return _in_dollars(customers)


def segment_totals(warehouse: Warehouse, by: list[str]) -> DataFrame:
    """Exact decimal sums and distinct counts per segment.

    Only integer keys travel through the shuffles of the fact; names are joined to the totals. The
    customer dimension, which may be large, meets one row per customer.
    """
    late = [name for name in by if name in CUSTOMER_ATTRIBUTES]
    if not late and {"product_id", "category_name"} & {*by}:
        return _totals_of_products(warehouse, by)
    customers = customer_totals(warehouse, by)
    if late:
        customers = customers.join(
            warehouse.dim_customer.select("customer_key", *late), "customer_key"
        )
    keys = [c for c in customers.columns if c not in ("customer_key", "transactions", *SUMS)]
    totals = customers.groupBy(*keys).agg(
        *_sums(),
        F.sum("transactions").alias("transactions"),
        F.count(F.lit(1)).alias("unique_customers"),
    )
    return _named(warehouse, totals, by).select(*by, *SUMS, "transactions", "unique_customers")


def _totals_of_products(warehouse: Warehouse, by: list[str]) -> DataFrame:
    """The same totals for segments of which an order has about as many as it has lines.

    Lines do not shrink to orders there, so only keys go through the two steps that count orders and
    customers. Sums go straight to their segment and meet the counts there.
    """
    lines, keys = _early_keys(warehouse, by)
    sums = _in_dollars(lines.groupBy(*keys).agg(*_cent_sums()))
    orders = lines.select("transaction_id", "customer_key", *keys).distinct()
    customers = orders.groupBy("customer_key", *keys).agg(F.count(F.lit(1)).alias("transactions"))
    counts = customers.groupBy(*[F.col(name).alias(f"_{name}") for name in keys]).agg(
        F.sum("transactions").alias("transactions"),
        F.count(F.lit(1)).alias("unique_customers"),
    )
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys])
    totals = sums.join(counts, same)
    return _named(warehouse, totals, by).select(*by, *SUMS, "transactions", "unique_customers")


def _named(warehouse: Warehouse, totals: DataFrame, by: list[str]) -> DataFrame:
    """Totals by key with the names of their keys."""
    if "product_key" in totals.columns:
        totals = totals.join(warehouse.dim_product, "product_key")
    if "category_name" in by:
        totals = totals.join(warehouse.dim_category, "category_key")
    if "channel_key" in totals.columns:
        totals = totals.join(warehouse.dim_channel, "channel_key")
    return totals


def segment_sums(warehouse: Warehouse, by: list[str]) -> DataFrame:
    """Exact decimal sums per segment, without counts of orders and customers.

    Lines go straight to their segment with map-side partial sums: a few rows per task travel.
    Customer attributes are joined to one row per customer, as the dimension may be large.
    """
    if isinstance(warehouse, CustomerGrain):
        return segment_totals(warehouse, by).select(*by, *SUMS)
    lines, keys = _early_keys(warehouse, by)
    late = [name for name in by if name in CUSTOMER_ATTRIBUTES]
    if late:
        customers = lines.groupBy("customer_key", *keys).agg(*_cent_sums())
        named = customers.join(
            warehouse.dim_customer.select("customer_key", *late), "customer_key"
        )
        totals = named.groupBy(*keys, *late).agg(*_sums())
    else:
        totals = lines.groupBy(*keys).agg(*_cent_sums())
    return _named(warehouse, _in_dollars(totals), by).select(*by, *SUMS)


def segment_amounts(warehouse: Warehouse, by: list[str]) -> DataFrame:
    """Revenue, profit, units and margin per segment, from sums alone."""
    revenue, profit = F.col("revenue"), F.col("profit")
    return segment_sums(warehouse, by).select(
        *by,
        revenue.cast("double").alias("revenue"),
        profit.cast("double").alias("profit"),
        F.col("quantity").cast("bigint").alias("units_sold"),
        money.ratio(profit, revenue).alias("gross_margin"),
    )


def measures(totals: DataFrame, keys: list[str]) -> DataFrame:
    """Totals as KPI columns; ratios are recomputed from the totals and null when undefined."""
    revenue, profit = F.col("revenue"), F.col("profit")
    return totals.select(
        *keys,
        revenue.cast("double").alias("revenue"),
        profit.cast("double").alias("profit"),
        F.col("quantity").cast("bigint").alias("units_sold"),
        F.col("transactions").cast("bigint").alias("transactions"),
        F.col("unique_customers").cast("bigint").alias("unique_customers"),
        money.ratio(profit, revenue).alias("gross_margin"),
        money.ratio(revenue, F.col("transactions")).alias("average_order_value"),
    )


def segment_performance(warehouse: Warehouse, by: list[str]) -> DataFrame:
    return measures(segment_totals(warehouse, by), by)


def with_yoy(frame: DataFrame, segment: list[str] | None = None) -> DataFrame:
    """Growth against the segment's previous year with sales.

    A segment has at most one row per calendar year, so its window is always small.
    """
    order = Window.partitionBy(*(segment or [F.lit(0)])).orderBy("year")
    return frame.select(
        "*",
        *[
            money.growth(F.col(name), F.lag(name).over(order)).alias(f"{name}_yoy_growth")
            for name in ("revenue", "profit")
        ],
    )


def latest_yoy(annual: DataFrame, segment: str) -> DataFrame:
    """Growth in the last year in which the segment sold anything."""
    growths = ["revenue_yoy_growth", "profit_yoy_growth"]
    return (
        annual.groupBy(segment)
        .agg(F.max_by(F.struct(*growths), "year").alias("latest"))
        .select(segment, *[F.col(f"latest.{name}").alias(name) for name in growths])
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
