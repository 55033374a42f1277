"""Rule-based findings on KPI frames, at most one row per rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import money
from orderloom.operators.numbering import median
from orderloom.operators.segments import union_all
from orderloom.plans.kpis import KPIResults

# Thresholds of the rules here, conditions and evidence sentences in the rules below.
PROFIT_GAP = 0.03
MARGIN_LOSS = 0.005
WEAK_MARGIN_GAP = 0.10
ORDER_VALUE_FACTOR = 1.5
TOP_SHARE = 0.20

COLUMNS = ["rule_no", "condition", "evidence_value", "evidence_subject", "evidence"]


def _finding(
    frame: DataFrame, number: int, condition: str, value: Column, subject: Column, text: Column
) -> DataFrame:
    return frame.select(
        F.lit(number).alias("rule_no"),
        F.lit(condition).alias("condition"),
        value.cast("double").alias("evidence_value"),
        subject.cast("string").alias("evidence_subject"),
        text.alias("evidence"),
    )


def profit_trails_revenue(results: KPIResults) -> DataFrame:
    """Latest year with both growth rates: profit grew clearly less than revenue."""
    growths = ["revenue_yoy_growth", "profit_yoy_growth"]
    latest = results.annual.dropna(subset=growths).orderBy(F.col("year").desc()).limit(1)
    gap = F.col("revenue_yoy_growth") - F.col("profit_yoy_growth")
    return _finding(
        latest.where(gap >= PROFIT_GAP),
        1,
        "Profit growth trails revenue growth",
        gap,
        F.col("year"),
        F.concat(F.lit("Latest YoY growth gap: "), money.percent(gap), F.lit(".")),
    )


def margin_compression(results: KPIResults) -> DataFrame:
    """Revenue never fell from year to year while the margin ended lower than it began."""
    span = results.annual.agg(
        F.count(F.lit(1)).alias("years"),
        F.min("revenue_yoy_growth").alias("least_growth"),
        F.min_by("gross_margin", "year").alias("first_margin"),
        F.max_by("gross_margin", "year").alias("last_margin"),
        F.max("year").alias("last_year"),
    )
    growing = F.coalesce(F.col("least_growth") > 0, F.lit(True))
    lower = F.col("last_margin") < F.col("first_margin") - MARGIN_LOSS
    loss = F.col("first_margin") - F.col("last_margin")
    return _finding(
        span.where((F.col("years") >= 2) & growing & lower),
        2,
        "Revenue is growing while margin is compressing",
        loss,
        F.col("last_year"),
        F.concat(
            F.lit("Gross margin decreased "),
            money.percent(loss),
            F.lit(" from the first to the latest year."),
        ),
    )


def weak_major_product(results: KPIResults) -> DataFrame:
    """Lowest margin among the products at or above the median revenue."""
    products = results.products
    middle = median(products, "revenue").scalar()
    overall = results.overview.select("gross_margin").scalar()
    weakest = (
        products.where(F.col("revenue") >= middle)
        .orderBy(F.col("gross_margin").asc_nulls_last(), "product_id")
        .limit(1)
        .withColumn("overall", overall)
    )
    return _finding(
        weakest.where(F.col("gross_margin") <= F.col("overall") - WEAK_MARGIN_GAP),
        3,
        "Major product has weak margin",
        F.col("gross_margin"),
        F.col("product_name"),
        F.concat(
            F.col("product_name"),
            F.lit(" margin is "),
            money.percent(F.col("gross_margin")),
            F.lit(" versus "),
            money.percent(F.col("overall")),
            F.lit(" overall."),
        ),
    )


def _growth_text(name: str) -> Column:
    return F.concat(
        F.col(name),
        F.lit(" latest YoY revenue growth is "),
        money.percent(F.col("revenue_yoy_growth")),
        F.lit("."),
    )


def declining_category(results: KPIResults) -> DataFrame:
    steepest = (
        results.categories.where(F.col("revenue_yoy_growth") < 0)
        .orderBy("revenue_yoy_growth", "category_name")
        .limit(1)
    )
    return _finding(
        steepest,
        4,
        "Category revenue is declining",
        F.col("revenue_yoy_growth"),
        F.col("category_name"),
        _growth_text("category_name"),
    )


def fastest_region(results: KPIResults) -> DataFrame:
    fastest = (
        results.regions.where(F.col("revenue_yoy_growth").isNotNull())
        .orderBy(F.col("revenue_yoy_growth").desc(), "region")
        .limit(1)
    )
    return _finding(
        fastest,
        5,
        "Fastest-growing region",
        F.col("revenue_yoy_growth"),
        F.col("region"),
        _growth_text("region"),
    )


def channel_order_values(results: KPIResults) -> DataFrame:
    """Highest against lowest average order value of the channels."""
    value = F.col("average_order_value")
    spread = results.channels.agg(
        F.count(F.lit(1)).alias("channels"),
        F.max(F.struct(value.alias("value"), F.col("channel_name").alias("name"))).alias("high"),
        F.min(
            F.when(
                value.isNotNull(),
                F.struct(value.alias("value"), F.col("channel_name").alias("name")),
            )
        ).alias("low"),
    )
    factor = money.ratio(F.col("high.value"), F.col("low.value"))
    apart = (F.col("channels") > 1) & (F.col("low.value") > 0) & (factor >= ORDER_VALUE_FACTOR)
    return _finding(
        spread.where(apart),
        6,
        "Channel order values differ materially",
        factor,
        F.col("high.name"),
        F.concat(
            F.col("high.name"),
            F.format_string(" AOV is %.1fx ", factor),
            F.col("low.name"),
            F.lit("."),
        ),
    )


def concentrated_revenue(results: KPIResults) -> DataFrame:
    share = F.col("top_customer_revenue_share")
    return _finding(
        results.concentration.where(share >= TOP_SHARE),
        7,
        "Revenue is concentrated among top customers",
        share,
        F.col("top_customer_count"),
        F.concat(
            F.format_string("Top %d customers contribute ", F.col("top_customer_count")),
            money.percent(share),
            F.lit(" of revenue."),
        ),
    )


RULES = [
    profit_trails_revenue,
    margin_compression,
    weak_major_product,
    declining_category,
    fastest_region,
    channel_order_values,
    concentrated_revenue,
]


def generate_insights(results: KPIResults) -> DataFrame:
    """Findings in rule order."""
    return union_all([rule(results) for rule in RULES]).orderBy("rule_no")
