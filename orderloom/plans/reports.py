"""The frames behind each report view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import money
from orderloom.operators.filters import filter_warehouse
from orderloom.operators.model import Warehouse
from orderloom.operators.numbering import few_ranks
from orderloom.operators.segments import segment_amounts
from orderloom.plans import kpis

HISTOGRAM_BINS = 35
TOP_PRODUCTS = 10
TOP_CUSTOMERS = 15


def _cards(frame: DataFrame, first: int, cards: dict[str, Column]) -> DataFrame:
    """One row of KPIs to (position, label, value) rows."""
    entries = [
        F.struct(
            F.lit(position).alias("position"), F.lit(label).alias("label"), value.alias("value")
        )
        for position, (label, value) in enumerate(cards.items(), first)
    ]
    return frame.select(F.inline(F.array(*entries)))


def headline_cards(overview: DataFrame, concentration: DataFrame) -> DataFrame:
    """Seven overview cards, then four customer cards."""
    summary = _cards(
        overview,
        1,
        {
            "Total Revenue": money.short_money(F.col("total_revenue")),
            "Total Profit": money.short_money(F.col("total_profit")),
            "Gross Margin": money.percent(F.col("gross_margin")),
            "Transactions": money.grouped(F.col("transactions")),
            "Average Order Value": money.exact_money(F.col("average_order_value")),
            "Unique Customers": money.grouped(F.col("unique_customers")),
            "Repeat Customer Rate": money.percent(F.col("repeat_customer_rate")),
        },
    )
    customers = _cards(
        overview,
        8,
        {
            "Unique Customers": money.grouped(F.col("unique_customers")),
            "Repeat Customer Rate": money.percent(F.col("repeat_customer_rate")),
            "Revenue per Customer": money.short_money(F.col("average_revenue_per_customer")),
        },
    )
    share = _cards(
        concentration,
        11,
        {"Top 10 Revenue Share": money.percent(F.col("top_customer_revenue_share"))},
    )
    return summary.unionByName(customers).unionByName(share)


def long_form(frame: DataFrame, key: str) -> DataFrame:
    """Revenue and profit as (key, metric, usd) rows."""
    return frame.unpivot(key, ["revenue", "profit"], "metric", "usd")


def monthly_long(warehouse: Warehouse) -> DataFrame:
    return long_form(segment_amounts(warehouse, ["month"]), "month")


def annual_long(warehouse: Warehouse) -> DataFrame:
    return long_form(segment_amounts(warehouse, ["year"]), "year")


def category_long(warehouse: Warehouse) -> DataFrame:
    return long_form(segment_amounts(warehouse, ["category_name"]), "category_name")


def region_long(warehouse: Warehouse) -> DataFrame:
    return long_form(segment_amounts(warehouse, ["region"]), "region")


def channel_long(warehouse: Warehouse) -> DataFrame:
    return long_form(segment_amounts(warehouse, ["channel_name"]), "channel_name")


def product_margin_scatter(warehouse: Warehouse) -> DataFrame:
    """Revenue, margin and profit per product with the portfolio margin as reference line."""
    products = segment_amounts(warehouse, kpis.PRODUCT)
    return products.select(
        *kpis.PRODUCT,
        "revenue",
        "profit",
        "gross_margin",
        kpis.portfolio_margin(warehouse).scalar().alias("portfolio_margin"),
    )


def top_products(warehouse: Warehouse, metric: str, n: int = TOP_PRODUCTS) -> DataFrame:
    """The n best products by dense rank of the metric, ties by id.

    Every product that outranks a listed one is listed too, so ranks within the list are global.
    """
    products = segment_amounts(warehouse, kpis.PRODUCT).orderBy(F.desc(metric), "product_id")
    rank = kpis.Rank(f"{metric}_rank", metric)
    return few_ranks(products.limit(n), [rank]).select(
        f"{metric}_rank", "product_id", "product_name", metric
    )


def category_revenue_series(warehouse: Warehouse) -> DataFrame:
    yearly = segment_amounts(warehouse, ["category_name", "year"])
    return yearly.select("category_name", "year", "revenue")


def product_table(warehouse: Warehouse) -> DataFrame:
    return segment_amounts(warehouse, kpis.PRODUCT).select(
        "product_name", "category_name", "revenue", "profit", "gross_margin"
    )


def bars(frame: DataFrame, label: str, metric: str) -> DataFrame:
    """Label and metric in ascending order of the metric."""
    return frame.select(label, metric).orderBy(metric)


def top_customers(warehouse: Warehouse, n: int = TOP_CUSTOMERS) -> DataFrame:
    return kpis.top_customers(warehouse, n).select("customer_id", "region", "lifetime_revenue")


def customer_revenue_histogram(warehouse: Warehouse, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Customers per equal-width revenue bin; one bin when all revenues are equal."""
    customers = kpis.customer_revenue(warehouse).select(F.col("revenue").cast("double"))
    edges = customers.agg(F.struct(F.min("revenue").alias("low"), F.max("revenue").alias("high")))
    placed = customers.withColumn("edges", edges.scalar())
    low, high = F.col("edges.low"), F.col("edges.high")
    # The maximum falls just past the last bin.
    number = F.least(F.width_bucket("revenue", low, high, F.lit(bins)), F.lit(bins))
    width = (high - low) / bins
    return (
        placed.withColumn("bin", F.when(low == high, 1).otherwise(number).cast("bigint"))
        .groupBy("bin", "edges")
        .agg(F.count(F.lit(1)).alias("customers"))
        .select(
            "bin",
            (low + (F.col("bin") - 1) * width).alias("bin_start"),
            (low + F.col("bin") * width).alias("bin_end"),
            "customers",
        )
    )


def filtered_overview(warehouse: Warehouse, **filters) -> DataFrame:
    """Overview of one filter context; `has_sales` is false when nothing matches."""
    overview = kpis.executive_overview(filter_warehouse(warehouse, **filters))
    return overview.withColumn("has_sales", F.col("transactions") > 0)
