import re
from datetime import date

import pytest

from order_lines import frame, good_lines, line
from orderloom.operators.filters import filter_options, filter_warehouse
from orderloom.operators.model import build_warehouse
from orderloom.plans import kpis, reports, sqlkpis
from orderloom.plans.reconcile import reconcile_kpis, reconcile_raw_vs_fact


def by(frame_, key):
    return {r[key]: r for r in frame_.collect()}


@pytest.fixture(scope="module")
def special(spark):
    """A channel without revenue, a category with a gap year, equal products and customers."""
    def of(number, day, customer, product, quantity, discount="0.00", channel="Online"):
        return line(f"TXN{number:07d}", 1, day, f"CUST{customer:05d}", "North", channel, product,
                    quantity, discount)

    return build_warehouse(frame(spark, [
        of(1, "2021-01-01", 1, "PROD003", 10),
        of(2, "2021-06-01", 2, "PROD003", 10),
        of(3, "2023-01-01", 1, "PROD003", 40),
        of(4, "2022-01-01", 3, "PROD002", 1, "1.00", "Free"),
        of(5, "2023-01-01", 3, "PROD002", 3),
        of(6, "2023-02-01", 4, "PROD001", 1, "0.25"),
    ]))


def test_overview(warehouse):
    row = kpis.executive_overview(warehouse).first()
    assert row.total_revenue == 737.13
    assert (row.transactions, row.unique_customers, row.repeat_customers) == (3, 2, 1)
    assert row.units_sold == 19
    assert row.average_order_value == pytest.approx(737.13 / 3)
    assert row.average_revenue_per_customer == pytest.approx(737.13 / 2)
    assert row.repeat_customer_rate == 0.5
    assert row.gross_margin == pytest.approx(row.total_profit / row.total_revenue)


def test_overview_without_sales(warehouse):
    row = kpis.executive_overview(filter_warehouse(warehouse, years=[])).first()
    assert (row.transactions, row.unique_customers, row.repeat_customers) == (0, 0, 0)
    assert row.total_revenue is None and row.gross_margin is None
    assert row.average_order_value is None and row.repeat_customer_rate is None


def test_growth_and_first_year(warehouse):
    years = by(kpis.annual_performance(warehouse), "year")
    assert years[2023].revenue_yoy_growth is None
    assert years[2024].revenue_yoy_growth == pytest.approx(457.13 / 280.0 - 1)


def test_growth_uses_the_previous_year_with_sales(special):
    rows = {(r.category_name, r.year): r for r in kpis.category_annual(special).collect()}
    assert rows["Office", 2023].revenue_yoy_growth == pytest.approx(1.0)
    assert rows["Furniture", 2022].gross_margin is None
    assert rows["Furniture", 2023].revenue_yoy_growth is None


def test_latest_growth_of_each_category(special):
    rows = by(kpis.category_performance(special), "category_name")
    assert rows["Office"].revenue_yoy_growth == pytest.approx(1.0)
    assert rows["Furniture"].revenue_yoy_growth is None
    assert rows["Furniture"].profit_yoy_growth == pytest.approx((15 + 30 - -45) / -45)


def test_zero_revenue_gives_null_ratios(special):
    free = by(kpis.channel_performance(special), "channel_name")["Free"]
    assert (free.revenue, free.gross_margin, free.average_order_value) == (0.0, None, 0.0)


def test_ranks_plain_and_dense(special):
    # Lamp and Desk both earn 150.00.
    plain = by(kpis.product_performance(special, dense=False), "product_id")
    dense = by(kpis.product_performance(special), "product_id")
    assert [plain[p].revenue_rank for p in ("PROD001", "PROD002", "PROD003")] == [1, 1, 1]
    assert {dense[p].profit_rank for p in dense} == {1, 2, 3}
    assert dense["PROD003"].bottom_profit_rank == 3


def test_frames_come_in_their_order(special):
    products = kpis.product_performance(special).collect()
    assert [r.revenue_rank for r in products] == sorted(r.revenue_rank for r in products)
    channels = [r.revenue for r in kpis.channel_performance(special).collect()]
    regions = [r.revenue for r in kpis.region_performance(special).collect()]
    assert channels == sorted(channels, reverse=True) and regions == sorted(regions, reverse=True)
    ranks = [r.revenue_rank for r in kpis.customer_value(special).collect()]
    assert ranks == list(range(1, len(ranks) + 1))
    margins = [r.margin for r in kpis.weak_margin_products(special).collect()]
    assert margins == sorted(margins)


def test_monthly_trend_is_first_of_month(warehouse):
    months = [r.month for r in kpis.monthly_trend(warehouse).collect()]
    assert months == [date(2023, 1, 1), date(2023, 6, 1), date(2024, 2, 1)]


def test_customer_order_ties_go_by_id(special):
    rows = kpis.customer_value(special).orderBy("revenue_rank").collect()
    expected = [("CUST00003", 150.0), ("CUST00004", 150.0), ("CUST00001", 125.0), ("CUST00002", 25.0)]
    assert [(r.customer_id, r.lifetime_revenue) for r in rows] == expected
    assert sum(r.revenue_share for r in rows) == pytest.approx(1.0)


def test_concentration_is_clamped(warehouse):
    many = kpis.top_customer_concentration(warehouse, 10).first()
    assert (many.top_customer_count, many.top_customer_revenue_share) == (2, 1.0)
    none = kpis.top_customer_concentration(warehouse, 0).first()
    assert (none.top_customer_count, none.top_customer_revenue) == (0, 0.0)
    negative = kpis.top_customer_concentration(warehouse, -3).first()
    assert negative.top_customer_count == 0
    empty = kpis.top_customer_concentration(filter_warehouse(warehouse, regions=[])).first()
    assert (empty.top_customer_count, empty.top_customer_revenue_share) == (0, None)


def test_repeat_and_one_time(warehouse):
    rows = by(kpis.repeat_vs_onetime(warehouse), "customer_type")
    assert (rows["Repeat"].customers, rows["Repeat"].revenue) == (1, 662.13)
    assert (rows["One-time"].customers, rows["One-time"].revenue) == (1, 75.0)


def test_segments_add_up(warehouse, special):
    for one in (warehouse, special):
        assert all(r.reconciled for r in kpis.segment_reconciliation(one).collect())


def test_customer_grain_changes_nothing(sample):
    from orderloom.operators.segments import customer_grain

    orders = customer_grain(sample.warehouse)
    for make in (
        kpis.executive_overview, kpis.annual_performance, kpis.monthly_trend, kpis.channel_performance,
        kpis.region_performance, kpis.region_annual, kpis.customer_value, kpis.top_customer_concentration,
    ):
        lines = sorted(map(tuple, make(sample.warehouse).collect()), key=repr)
        assert lines == sorted(map(tuple, make(orders).collect()), key=repr), make.__name__


def test_customer_grain_with_unknown_days(warehouse):
    """Sales on days that the calendar lacks count in all but their year and month."""
    from dataclasses import replace

    from orderloom.operators.segments import customer_grain

    broken = replace(warehouse, dim_date=warehouse.dim_date.where("date_key <> 20230105"))
    orders = customer_grain(broken)
    for make in (kpis.executive_overview, kpis.annual_performance, kpis.monthly_trend, kpis.region_annual):
        lines = sorted(map(tuple, make(broken).collect()), key=repr)
        assert lines == sorted(map(tuple, make(orders).collect()), key=repr), make.__name__


def test_one_scan_of_the_fact_serves_the_customer_grain(sample, monkeypatch):
    from orderloom.operators import segments

    plans = []
    real = segments.stage
    monkeypatch.setattr(segments, "stage", lambda f, n: plans.append(f) or real(f, n))
    orders = segments.customer_grain(sample.warehouse)
    assert len(plans) == 1
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert text.count("Expand") == 1 and len(set(re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text))) == 2
    for make in (kpis.annual_performance, kpis.channel_performance, kpis.region_performance, kpis.customer_value):
        scans = make(orders)._jdf.queryExecution().executedPlan().toString()
        assert "transaction_id" not in scans


def test_sql_and_frames_agree(special):
    rows = reconcile_kpis(special).collect()
    assert len(rows) > 20
    assert [r for r in rows if not r.within_tolerance] == []


def test_reconciliation_sees_a_difference(spark, warehouse):
    raw = frame(spark, good_lines()[1:])
    rows = by(reconcile_raw_vs_fact(raw, warehouse), "measure")
    assert (rows["rows"].difference, rows["revenue"].difference) == (-1.0, -180.0)


# ------------------------------------------------------------------ filters


def test_no_filter_is_the_identity(warehouse):
    assert filter_warehouse(warehouse).fact_sales.count() == 6


def test_filters_combine(warehouse):
    got = filter_warehouse(
        warehouse, years=[2024], regions=["North", "South"], categories=["Furniture"],
        channels=["Online"],
    )
    assert sorted(r.sales_key for r in got.fact_sales.collect()) == [4, 5]
    assert got.dim_product is warehouse.dim_product
    assert filter_warehouse(warehouse, categories=[]).fact_sales.count() == 0
    assert filter_warehouse(warehouse, years=[1990]).fact_sales.count() == 0


def test_stored_fact_is_pruned_by_year(sample):
    plan = filter_warehouse(sample.warehouse, years=[1996]).fact_sales._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*sale_year", text)


def test_filter_options_come_from_dimensions(warehouse):
    got = [(r.facet, r.position, r.value) for r in filter_options(warehouse).collect()]
    assert ("years", 1, "2023") in got and ("years", 2, "2024") in got
    assert [v for f, _, v in sorted(got) if f == "categories"] == ["Furniture", "Office"]


# ------------------------------------------------------------------ reports


def test_money_texts(spark):
    from pyspark.sql import functions as F

    from orderloom.functions import money

    values = spark.createDataFrame(
        [(1, 1_234_567.0), (2, -2_500_000.0), (3, 1_011.88), (4, 999.5), (5, None), (6, 0.0)],
        "n int, v double",
    )
    got = by(values.select("n", money.short_money(F.col("v")).alias("s"),
                           money.exact_money(F.col("v")).alias("e"),
                           money.percent(F.col("v")).alias("p")), "n")
    assert [got[i].s for i in range(1, 7)] == [
        "$1.23M", "$-2.50M", "$1.0K", "$999.50", "—", "$0.00"]
    assert got[3].e == "$1,011.88" and got[5].e == "—" and got[5].p == "—"


def test_headline_cards(warehouse):
    cards = reports.headline_cards(
        kpis.executive_overview(warehouse), kpis.top_customer_concentration(warehouse)
    ).orderBy("position").collect()
    assert [c.label for c in cards[:3]] == ["Total Revenue", "Total Profit", "Gross Margin"]
    assert [c.value for c in cards][:4] == ["$737.13", "$229.13", "31.1%", "3"]
    assert cards[-1].value == "100.0%"


def test_histogram_bins(warehouse, special):
    rows = reports.customer_revenue_histogram(warehouse).collect()
    assert {r.bin for r in rows} == {1, 35} and sum(r.customers for r in rows) == 2
    one = filter_warehouse(warehouse, regions=["South"])
    (only,) = reports.customer_revenue_histogram(one).collect()
    assert (only.bin, only.bin_start, only.bin_end, only.customers) == (1, 75.0, 75.0, 1)
    assert sum(r.customers for r in reports.customer_revenue_histogram(special).collect()) == 4


def test_top_products_have_global_ranks(special):
    rows = reports.top_products(special, "revenue", 2).collect()
    assert sorted((r.revenue_rank, r.product_id) for r in rows) == [(1, "PROD001"), (1, "PROD002")]


def test_filtered_overview_flags_no_sales(warehouse):
    assert reports.filtered_overview(warehouse, channels=["Retail"]).first().has_sales
    assert not reports.filtered_overview(warehouse, channels=["Fax"]).first().has_sales


def test_calculate_kpis_has_every_frame(warehouse):
    results = kpis.calculate_kpis(warehouse, top_customer_count=1)
    assert results.overview.first().transactions == 3
    assert results.concentration.first().top_customer_count == 1
    assert results.products.count() == 3 and results.customers.count() == 2
    assert results.category_annual.count() == 4 and results.monthly.count() == 3
