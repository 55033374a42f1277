"""SQL path against DataFrame path, and raw lines against the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.model import Warehouse, typed_lines
from orderloom.operators.numbering import Rank, with_ranks
from orderloom.operators.segments import customer_grain, segment_amounts, union_all
from orderloom.plans import kpis, sqlkpis

RELATIVE = 1e-8
ABSOLUTE = 0.01

OVERVIEW_METRICS = [
    "total_revenue",
    "total_profit",
    "gross_margin",
    "transactions",
    "units_sold",
    "average_order_value",
    "unique_customers",
    "repeat_customers",
    "repeat_customer_rate",
]
# Compared exactly.
COUNTS = ["transactions", "units_sold", "unique_customers", "repeat_customers", "revenue_rank"]
CHANNEL_METRICS = ["revenue", "profit", "gross_margin", "average_order_value"]


def _entries(frame: DataFrame, area: str, segment: str | None, metrics: list[str]) -> DataFrame:
    """(area, segment, metric, value) rows."""
    name = F.col(segment).cast("string") if segment else F.lit("all")
    wide = frame.select(
        F.lit(area).alias("area"),
        name.alias("segment"),
        *[F.col(metric).cast("double").alias(metric) for metric in metrics],
    )
    return wide.unpivot(["area", "segment"], metrics, "metric", "value")


def _sql_entries(warehouse: Warehouse) -> DataFrame:
    money = ["revenue", "profit"]
    share = sqlkpis.concentration(warehouse).withColumnRenamed("top_revenue_share", "share")
    regions = sqlkpis.region_annual(warehouse).withColumn(
        "segment", F.concat_ws("/", "region", "year")
    )
    return union_all(
        [
            _entries(sqlkpis.executive_summary(warehouse), "overview", None, OVERVIEW_METRICS),
            _entries(sqlkpis.annual(warehouse), "annual", "year", money),
            _entries(sqlkpis.products(warehouse), "products", "product_id", [*money, "revenue_rank"]),
            _entries(regions, "regions", "segment", money),
            _entries(sqlkpis.channels(warehouse), "channels", "channel_name", CHANNEL_METRICS),
            _entries(share, "concentration", None, ["share"]),
        ]
    )


def _frame_entries(warehouse: Warehouse) -> DataFrame:
    money = ["revenue", "profit"]
    orders = customer_grain(warehouse)
    share = kpis.top_customer_concentration(orders).withColumnRenamed(
        "top_customer_revenue_share", "share"
    )
    regions = segment_amounts(orders, ["region", "year"]).withColumn(
        "segment", F.concat_ws("/", "region", "year")
    )
    products = with_ranks(
        segment_amounts(warehouse, kpis.PRODUCT), [Rank("revenue_rank", "revenue", dense=False)]
    )
    return union_all(
        [
            _entries(kpis.executive_overview(orders), "overview", None, OVERVIEW_METRICS),
            _entries(segment_amounts(orders, ["year"]), "annual", "year", money),
            _entries(products, "products", "product_id", [*money, "revenue_rank"]),
            _entries(regions, "regions", "segment", money),
            _entries(
                kpis.channel_performance(orders), "channels", "channel_name", CHANNEL_METRICS
            ),
            _entries(share, "concentration", None, ["share"]),
        ]
    )


def reconcile_kpis(warehouse: Warehouse) -> DataFrame:
    """Every metric of both paths side by side; counts must agree exactly."""
    left = _sql_entries(warehouse).withColumnRenamed("value", "sql_value")
    right = _frame_entries(warehouse).withColumnRenamed("value", "df_value")
    difference = F.abs(F.col("sql_value") - F.col("df_value"))
    allowed = F.when(F.col("metric").isin(COUNTS), 0.0).otherwise(
        F.greatest(F.abs("df_value") * RELATIVE, F.lit(ABSOLUTE))
    )
    both_missing = F.col("sql_value").isNull() & F.col("df_value").isNull()
    return left.join(right, ["area", "segment", "metric"], "full").select(
        "area",
        "segment",
        "metric",
        "sql_value",
        "df_value",
        difference.alias("abs_diff"),
        F.coalesce(difference <= allowed, both_missing).alias("within_tolerance"),
    )


def reconcile_raw_vs_fact(raw: DataFrame, warehouse: Warehouse) -> DataFrame:
    """Row counts and totals of raw lines and fact: (measure, raw_value, fact_value, difference)."""
    names = ["rows", "quantity", "revenue", "total_cost", "profit"]

    def totals(lines: DataFrame, value: str) -> DataFrame:
        sums = lines.agg(
            F.count(F.lit(1)).cast("decimal(38,2)").alias("rows"),
            *[
                F.coalesce(F.sum(name), F.lit(0)).cast("decimal(38,2)").alias(name)
                for name in names[1:]
            ],
        )
        return sums.unpivot([], names, "measure", value)

    joined = totals(typed_lines(raw), "raw_value").join(
        totals(warehouse.fact_sales, "fact_value"), "measure"
    )
    return joined.select(
        "measure",
        F.col("raw_value").cast("double").alias("raw_value"),
        F.col("fact_value").cast("double").alias("fact_value"),
        (F.col("raw_value") - F.col("fact_value")).cast("double").alias("difference"),
    )
