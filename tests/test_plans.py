"""Plans that must not depend on one task or read more than they need."""

import re

import pytest

from orderloom import registry
from orderloom.operators import numbering
from orderloom.plans import kpis
from orderloom.sources import testdata


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


ONE_ROW = re.compile(r"SinglePartition")


@pytest.mark.parametrize("name", ["channel_performance", "region_performance", "monthly_trend",
                                  "category_performance", "sql_channels", "sql_region_annual"])
def test_no_cartesian_product_and_no_distinct_expand(sample, name):
    text = plan(registry.ALL[name](sample))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Expand" not in text


def test_scan_reads_only_the_needed_columns(sample):
    text = plan(kpis.channel_performance(sample.warehouse))
    scans = [set(re.findall(r"(\w+)#", scan)) for scan in re.findall(r"FileScan parquet \[([^]]*)", text)]
    assert {"transaction_id", "customer_key", "channel_key", "quantity", "revenue", "profit"} in [
        scan - {"sale_year"} for scan in scans
    ]


SUMS_ONLY = [
    "monthly_long", "annual_long", "category_long", "region_long", "channel_long",
    "product_margin_scatter", "top_products_revenue", "top_products_profit",
    "category_revenue_series", "product_table", "regions_by_revenue", "regions_by_growth",
    "regions_by_margin", "channels_by_revenue", "channels_by_margin", "top_customers_15",
    "segment_totals_reconcile",
]


def order_shuffles(frame) -> int:
    return len(re.findall(r"Exchange hashpartitioning\([^)]*transaction_id", plan(frame)))


@pytest.mark.parametrize("name", SUMS_ONLY)
def test_sums_need_no_orders(sample, name):
    assert order_shuffles(registry.ALL[name](sample)) == 0


def test_growth_costs_no_second_shuffle_of_orders(sample):
    assert order_shuffles(kpis.region_performance(sample.warehouse)) <= 1


def test_filter_options_are_one_small_plan(sample):
    assert "Window" in plan(registry.ALL["filter_options"](sample))


def test_top_customers_are_not_globally_sorted(sample):
    assert "TakeOrderedAndProject" in plan(kpis.top_customers(sample.warehouse, 15))


def test_large_numbering_has_no_single_partition_over_rows(spark, sample):
    customers = kpis.customer_performance(sample.warehouse)
    ranked = numbering.row_positions(customers, kpis._by_revenue(), "n")
    text = plan(ranked)
    # The one single-task step sums row counts per sorted block.
    assert len(ONE_ROW.findall(text)) == 1 and "_rows" in text


def test_no_python_in_any_plan(sample):
    for name in ("fact_sales", "insights", "product_performance", "val_source_dirty"):
        assert "Python" not in plan(registry.ALL[name](sample))


def test_places_meet_orders_and_not_lines(spark, sample):
    """Lines are exchanged by order and by part, never by customer."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for lines in (testdata.raw_sales, testdata.dirty_raw_sales):
            text = lines(spark, sample.folder)._jdf.queryExecution().optimizedPlan().toString()
            on_customer = [line for line in text.splitlines() if "Join" in line and "c_custkey" in line]
            on_order = [line for line in text.splitlines() if "Join" in line and "l_orderkey" in line]
            assert on_customer and on_order
            depth = lambda line: len(line) - len(line.lstrip(" :+-"))
            assert depth(on_customer[0]) > depth(on_order[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_source_checks_send_no_values_of_keys(sample):
    text = plan(registry.ALL["val_source_clean"](sample))
    assert "SortAggregate" not in text


def test_median_of_products_reads_the_lines_once(sample, monkeypatch):
    read = []
    sums = kpis.product_sums
    monkeypatch.setattr(kpis, "product_sums", lambda warehouse: read.append(1) or sums(warehouse))
    frame = kpis.weak_margin_products(sample.warehouse)
    assert len(read) == 1 and "transaction_id" not in plan(frame) and "fact_sales" not in plan(frame)
