"""Every rule just over and just under its threshold."""

import pytest

from orderloom.operators.filters import filter_warehouse
from orderloom.plans import insights, kpis
from orderloom.plans.kpis import KPIResults


@pytest.fixture(scope="module")
def results(spark):
    def make(**changes):
        frames = {
            "annual": [(2021, 0.30, None, None), (2022, 0.30, 0.10, 0.10)],
            "products": [("P1", "Desk", 100.0, 0.30), ("P2", "Lamp", 50.0, 0.05)],
            "categories": [("Furniture", 0.10), ("Office", 0.0)],
            "regions": [("North", None)],
            "channels": [("Online", 100.0), ("Retail", 90.0)],
            "overview": [(0.30,)],
            "concentration": [(10, 0.1)],
            **changes,
        }
        schemas = {
            "annual": "year int, gross_margin double, revenue_yoy_growth double, "
                      "profit_yoy_growth double",
            "products": "product_id string, product_name string, revenue double, "
                        "gross_margin double",
            "categories": "category_name string, revenue_yoy_growth double",
            "regions": "region string, revenue_yoy_growth double",
            "channels": "channel_name string, average_order_value double",
            "overview": "gross_margin double",
            "concentration": "top_customer_count long, top_customer_revenue_share double",
        }
        made = {name: spark.createDataFrame(frames[name], schemas[name]) for name in schemas}
        return KPIResults(monthly=None, category_annual=None, customers=None, **made)

    return make


def found(results_):
    return {r.rule_no: r for r in insights.generate_insights(results_).collect()}


def test_nothing_to_report(results):
    assert found(results()) == {}


CASES = [
    (1, {"annual": [(2021, 0.3, None, None), (2022, 0.3, 0.10, 0.0625)]}, 0.0375, "2022",
     "Latest YoY growth gap: 3.8%."),
    (2, {"annual": [(2021, 0.30, None, None), (2022, 0.29, 0.10, 0.10)]}, 0.01, "2022",
     "Gross margin decreased 1.0% from the first to the latest year."),
    (3, {"products": [("P1", "Desk", 100.0, 0.15), ("P2", "Lamp", 50.0, 0.01)]}, 0.15, "Desk",
     "Desk margin is 15.0% versus 30.0% overall."),
    (4, {"categories": [("Furniture", -0.02), ("Office", -0.07)]}, -0.07, "Office",
     "Office latest YoY revenue growth is -7.0%."),
    (5, {"regions": [("North", -0.2), ("South", -0.1)]}, -0.1, "South",
     "South latest YoY revenue growth is -10.0%."),
    (6, {"channels": [("Online", 50.0), ("Retail", 75.0)]}, 1.5, "Retail",
     "Retail AOV is 1.5x Online."),
    (7, {"concentration": [(10, 0.2)]}, 0.2, "10",
     "Top 10 customers contribute 20.0% of revenue."),
]


@pytest.mark.parametrize("number, changes, value, subject, text", CASES)
def test_rule_fires(results, number, changes, value, subject, text):
    rows = found(results(**changes))
    assert set(rows) == {number}
    row = rows[number]
    assert row.evidence_value == pytest.approx(value)
    assert (row.evidence_subject, row.evidence) == (subject, text)


@pytest.mark.parametrize("changes", [
    {"annual": [(2021, 0.30, None, None), (2022, 0.30, 0.10, 0.0703125)]},
    {"annual": [(2021, 0.30, None, None), (2022, 0.296, 0.10, 0.10)]},
    {"annual": [(2021, 0.30, None, None), (2022, 0.20, -0.01, -0.01)]},
    {"annual": [(2022, 0.30, None, None)]},
    {"products": [("P1", "Desk", 100.0, 0.201), ("P2", "Lamp", 50.0, 0.0)]},
    {"products": [("P1", "Desk", 100.0, None)]},
    {"channels": [("Online", 50.0), ("Retail", 74.0)]},
    {"channels": [("Online", 0.0), ("Retail", 74.0)]},
    {"channels": [("Online", 10.0)]},
    {"concentration": [(10, 0.199)]},
    {"concentration": [(0, None)]},
])
def test_rule_stays_silent(results, changes):
    assert found(results(**changes)) == {}


def test_margin_rule_without_any_growth(results):
    rows = found(results(annual=[(2021, 0.3, None, None), (2022, 0.2, None, None)]))
    assert set(rows) == {2}


def test_rules_come_in_order(results):
    changes = {**CASES[6][1], **CASES[4][1], **CASES[2][1]}
    rows = insights.generate_insights(results(**changes)).collect()
    assert [r.rule_no for r in rows] == [3, 5, 7]


def test_empty_context(warehouse):
    none = kpis.calculate_kpis(filter_warehouse(warehouse, years=[]))
    assert insights.generate_insights(none).collect() == []
