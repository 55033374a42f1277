"""Totals of segments of which an order has as many as it has lines."""

import pytest
from order_lines import changed, frame
from pyspark.sql import functions as F

from orderloom.operators import model, segments
from orderloom.plans import kpis


@pytest.mark.parametrize("by", [["category_name"], ["category_name", "year"], kpis.PRODUCT])
def test_amounts_do_not_travel_with_orders_to_their_products(spark, by):
    """Also a day without a year and a line without a product keep their places."""
    lines = model.typed_lines(frame(spark, changed(5, product_id="PROD003")))
    built = model.build_warehouse(lines)
    days = built.dim_date.withColumn("year", F.when(F.col("year") != 2023, F.col("year")))
    fact = built.fact_sales.withColumn("product_key", F.when(F.col("line_number") < 3, F.col("product_key")))
    odd = model.Warehouse(**{**built.tables(), "dim_date": days, "fact_sales": fact})
    totals = segments.segment_totals(odd, by)
    whole = fact.join(days, "date_key").join(built.dim_product, "product_key").join(built.dim_category, "category_key")
    whole = whole.groupBy(*by).agg(
        F.sum("revenue"), F.sum("profit"), F.sum("quantity"),
        F.countDistinct("transaction_id"), F.countDistinct("customer_key"),
    )
    assert sorted(map(repr, map(tuple, totals.collect()))) == sorted(map(repr, map(tuple, whole.collect())))
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    steps = [line for line in plan.splitlines() if "Aggregate [" in line and "transaction_id" in line]
    assert steps and not any("revenue" in line for line in steps)
