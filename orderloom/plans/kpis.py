"""KPI frames with the DataFrame API."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import money
from orderloom.operators.model import Warehouse
from orderloom.operators.numbering import (
    Rank,
    median,
    row_positions,
    top_rows,
    with_ranks,
)
from orderloom.operators.segments import (
    customer_totals,
    latest_yoy,
    measures,
    customer_grain,
    segment_amounts,
    segment_performance,
    segment_sums,
    with_yoy,
)
from orderloom.sources.staging import stage

TOP_CUSTOMERS = 10


@dataclass(frozen=True)
class KPIResults:
    """All KPI frames of one filter context; scalars are one-row frames."""

    overview: DataFrame
    annual: DataFrame
    monthly: DataFrame
    products: DataFrame
    categories: DataFrame
    category_annual: DataFrame
    regions: DataFrame
    channels: DataFrame
    customers: DataFrame
    concentration: DataFrame


def executive_overview(warehouse: Warehouse) -> DataFrame:
    """One row; without sales the sums and ratios are null and the counts zero."""
    repeat = F.count_if(F.col("transactions") >= 2)
    totals = customer_totals(warehouse).agg(
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
        F.sum("quantity").alias("quantity"),
        F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions"),
        F.count(F.lit(1)).alias("customers"),
        repeat.alias("repeat_customers"),
    )
    revenue, profit = F.col("revenue"), F.col("profit")
    return totals.select(
        revenue.cast("double").alias("total_revenue"),
        profit.cast("double").alias("total_profit"),
        money.ratio(profit, revenue).alias("gross_margin"),
        "transactions",
        F.col("quantity").cast("bigint").alias("units_sold"),
        money.ratio(revenue, F.col("transactions")).alias("average_order_value"),
        money.ratio(revenue, F.col("customers")).alias("average_revenue_per_customer"),
        F.col("customers").alias("unique_customers"),
        "repeat_customers",
        money.ratio(F.col("repeat_customers"), F.col("customers")).alias("repeat_customer_rate"),
    )


def customer_orders(warehouse: Warehouse) -> DataFrame:
    """Distinct orders of every customer with sales."""
    orders = warehouse.fact_sales.select("customer_key", "transaction_id").distinct()
    counts = orders.groupBy("customer_key").agg(F.count(F.lit(1)).alias("order_count"))
    return counts.join(
        warehouse.dim_customer.select("customer_key", "customer_id"), "customer_key"
    ).select("customer_id", "order_count")


def repeat_customers(warehouse: Warehouse, least: int = 2) -> DataFrame:
    return customer_orders(warehouse).where(F.col("order_count") >= least)


def repeat_customer_rate(warehouse: Warehouse) -> DataFrame:
    counts = customer_orders(warehouse).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("order_count") >= 2).alias("repeat_customers"),
    )
    rate = money.ratio(F.col("repeat_customers"), F.col("customers"))
    return counts.select("customers", "repeat_customers", rate.alias("repeat_customer_rate"))


def revenue_by_year(warehouse: Warehouse) -> DataFrame:
    lines = warehouse.fact_sales.join(warehouse.dim_date.select("date_key", "year"), "date_key")
    return lines.groupBy("year").agg(
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("profit").cast("double").alias("profit"),
    )


def annual_performance(warehouse: Warehouse) -> DataFrame:
    return with_yoy(segment_performance(warehouse, ["year"])).orderBy("year")


def monthly_trend(warehouse: Warehouse) -> DataFrame:
    return segment_performance(warehouse, ["month"]).orderBy("month")


def category_annual(warehouse: Warehouse) -> DataFrame:
    yearly = segment_performance(warehouse, ["category_name", "year"])
    return with_yoy(yearly, ["category_name"])


def region_annual(warehouse: Warehouse) -> DataFrame:
    yearly = with_yoy(segment_performance(warehouse, ["region", "year"]), ["region"])
    return yearly.orderBy("year", F.desc_nulls_last("revenue_yoy_growth"))


def _with_latest_yoy(warehouse: Warehouse, segment: str, annual: DataFrame) -> DataFrame:
    totals = segment_performance(warehouse, [segment])
    return totals.join(latest_yoy(annual, segment), segment, "left")


def category_performance(warehouse: Warehouse, annual: DataFrame | None = None) -> DataFrame:
    """Category measures, growth in the last year and ranks; growth needs sums only."""
    if annual is None:
        annual = with_yoy(segment_amounts(warehouse, ["category_name", "year"]), ["category_name"])
    ranks = [Rank("revenue_rank", "revenue"), Rank("profit_rank", "profit")]
    frame = _with_latest_yoy(warehouse, "category_name", annual)
    return with_ranks(frame, ranks)


def region_growth(warehouse: Warehouse) -> DataFrame:
    """Growth of every region in its last year."""
    yearly = segment_amounts(warehouse, ["region", "year"])
    return latest_yoy(with_yoy(yearly, ["region"]), "region")


def region_performance(warehouse: Warehouse) -> DataFrame:
    totals = segment_performance(warehouse, ["region"])
    return totals.join(region_growth(warehouse), "region", "left").orderBy(F.desc("revenue"), "region")


def channel_performance(warehouse: Warehouse) -> DataFrame:
    """Channels by revenue, best first."""
    return segment_performance(warehouse, ["channel_name"]).orderBy(F.desc("revenue"), "channel_name")


PRODUCT = ["product_id", "product_name", "category_name"]


def product_performance(warehouse: Warehouse, *, dense: bool = True) -> DataFrame:
    """Product measures with revenue, profit and bottom-profit ranks, plain or dense."""
    ranks = [
        Rank("revenue_rank", "revenue", dense=dense),
        Rank("profit_rank", "profit", dense=dense),
        Rank("bottom_profit_rank", "profit", descending=False, dense=dense),
    ]
    frame = segment_performance(warehouse, PRODUCT)
    return with_ranks(frame, ranks).orderBy("revenue_rank", "product_id")


def product_sums(warehouse: Warehouse) -> DataFrame:
    """Revenue, profit and margin per product key, before any join."""
    sums = warehouse.fact_sales.groupBy("product_key").agg(
        money.sum_cents("revenue"), money.sum_cents("profit")
    )
    sums = sums.select(
        "product_key",
        money.dollars(F.col("revenue")).alias("revenue"),
        money.dollars(F.col("profit")).alias("profit"),
    )
    return sums.withColumn("margin", money.ratio(F.col("profit"), F.col("revenue")))


def portfolio_margin(warehouse: Warehouse) -> DataFrame:
    return _margin(warehouse.fact_sales)


def _margin(amounts: DataFrame) -> DataFrame:
    margin = money.ratio(F.sum("profit"), F.sum("revenue"))
    return amounts.agg(margin.alias("margin"))


def median_product_revenue(warehouse: Warehouse) -> DataFrame:
    return median(product_sums(warehouse), "revenue")


def weak_margin_products(warehouse: Warehouse) -> DataFrame:
    """Products at or above the median revenue whose margin is below the portfolio's."""
    # The median takes several passes: over one row per product, not over the lines.
    sums = stage(product_sums(warehouse), "product-sums")
    middle = median(sums, "revenue").scalar()
    portfolio = _margin(sums).scalar()
    chosen = sums.where(
        (F.col("revenue").cast("double") >= middle) & (F.col("margin") < portfolio)
    )
    names = warehouse.dim_product.select("product_key", "product_id", "product_name")
    return chosen.join(names, "product_key").select(
        "product_id",
        "product_name",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("profit").cast("double").alias("profit"),
        "margin",
    ).orderBy("margin", F.desc("revenue"))


CUSTOMER = ["customer_id", "region"]


def customer_performance(warehouse: Warehouse) -> DataFrame:
    """Measures per customer with lifetime names, unranked."""
    totals = customer_totals(warehouse).join(warehouse.dim_customer, "customer_key")
    totals = totals.withColumn("unique_customers", F.lit(1))
    return measures(totals, CUSTOMER).withColumnsRenamed(
        {"revenue": "lifetime_revenue", "profit": "lifetime_profit"}
    )


def _by_revenue() -> list[Column]:
    return [F.col("lifetime_revenue").desc(), F.col("customer_id").asc()]


def customer_value(warehouse: Warehouse) -> DataFrame:
    """Customers with their revenue position (ties by id) and share of all revenue."""
    total = warehouse.fact_sales.agg(F.sum("revenue")).scalar()
    ranked = row_positions(customer_performance(warehouse), _by_revenue(), "revenue_rank")
    shares = ranked.withColumn("revenue_share", money.ratio(F.col("lifetime_revenue"), total))
    return shares.orderBy("revenue_rank")


def customer_revenue(warehouse: Warehouse) -> DataFrame:
    """Revenue per customer key."""
    cents = warehouse.fact_sales.groupBy("customer_key").agg(money.sum_cents("revenue"))
    return cents.select("customer_key", money.dollars(F.col("revenue")).alias("revenue"))


def top_customers(warehouse: Warehouse, n: int) -> DataFrame:
    """The n best customers with their revenue: customer_id, region, lifetime_revenue."""
    revenues = customer_revenue(warehouse).join(warehouse.dim_customer, "customer_key")
    named = revenues.select(*CUSTOMER, F.col("revenue").cast("double").alias("lifetime_revenue"))
    return top_rows(named, _by_revenue(), n)


def top_customer_concentration(warehouse: Warehouse, n: int = TOP_CUSTOMERS) -> DataFrame:
    """Revenue of the n best customers and its share; n is clamped to the customers there are."""
    customers = customer_revenue(warehouse)
    order = [F.col("revenue").desc(), F.col("customer_key")]
    top = top_rows(customers, order, max(n, 0)).agg(
        F.count(F.lit(1)).alias("top_customer_count"), F.sum("revenue").alias("top_revenue")
    )
    total = customers.agg(F.sum("revenue")).scalar()
    top_revenue = F.when(
        F.col("total").isNotNull(), F.coalesce(F.col("top_revenue"), F.lit(0))
    ).cast("double")
    return top.withColumn("total", total).select(
        "top_customer_count",
        top_revenue.alias("top_customer_revenue"),
        money.ratio(top_revenue, F.col("total")).alias("top_customer_revenue_share"),
    )


def repeat_vs_onetime(warehouse: Warehouse) -> DataFrame:
    """Customers and revenue of repeat and one-time buyers."""
    kind = F.when(F.col("transactions") >= 2, "Repeat").otherwise("One-time")
    return (
        customer_totals(warehouse)
        .groupBy(kind.alias("customer_type"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("revenue").cast("double").alias("revenue"),
        )
    )


def segment_reconciliation(warehouse: Warehouse) -> DataFrame:
    """Sums over categories, regions and channels against the plain totals of the fact."""
    overall = warehouse.fact_sales.agg(
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
        F.sum("quantity").alias("quantity"),
    )
    result = None
    for segment in ("category_name", "region", "channel_name"):
        sums = segment_sums(warehouse, [segment]).agg(
            F.lit(segment).alias("segment"),
            *[F.sum(name).alias(name) for name in ("revenue", "profit", "quantity")],
        )
        result = sums if result is None else result.unionByName(sums)
    totals = {name: overall.select(name).scalar() for name in ("revenue", "profit", "quantity")}
    return result.select(
        "segment",
        F.col("revenue").cast("double").alias("segment_revenue"),
        totals["revenue"].cast("double").alias("total_revenue"),
        (
            F.col("revenue").eqNullSafe(totals["revenue"])
            & F.col("profit").eqNullSafe(totals["profit"])
            & F.col("quantity").eqNullSafe(totals["quantity"])
        ).alias("reconciled"),
    )


def calculate_kpis(warehouse: Warehouse, *, top_customer_count: int = TOP_CUSTOMERS) -> KPIResults:
    """All KPI frames of a filter context.

    Seven of the ten need no products, so they share one staged roll-up of the fact to customers.
    Frames that several reports and rules read are staged as well.
    """
    orders = customer_grain(warehouse)
    by_category = stage(category_annual(warehouse), "category-annual")
    products = stage(product_performance(warehouse), "products")
    return KPIResults(
        overview=executive_overview(orders),
        annual=annual_performance(orders),
        monthly=monthly_trend(orders),
        products=products,
        categories=category_performance(warehouse, by_category),
        category_annual=by_category,
        regions=region_performance(orders),
        channels=channel_performance(orders),
        customers=customer_value(orders),
        concentration=top_customer_concentration(orders, top_customer_count),
    )
