import re
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from order_lines import frame, good_lines, raw_frame
from orderloom.operators.model import build_warehouse, enrich_sales, line_measures, typed_lines
from orderloom.schema import FACT_COLUMNS, TABLES


def rows(table):
    return sorted(map(tuple, table.collect()))


def test_dimensions_are_sorted_and_dense(warehouse):
    assert rows(warehouse.dim_customer) == [(1, "CUST00001", "North"), (2, "CUST00002", "South")]
    assert rows(warehouse.dim_category) == [(1, "Furniture"), (2, "Office")]
    assert rows(warehouse.dim_product) == [
        (1, "PROD001", "Desk", 1), (2, "PROD002", "Lamp", 1), (3, "PROD003", "Pen", 2)]
    assert rows(warehouse.dim_channel) == [(1, "Online"), (2, "Retail")]


def test_calendar_has_no_gaps(warehouse):
    days = warehouse.dim_date.orderBy("date_key").collect()
    assert len(days) == (date(2024, 2, 3) - date(2023, 1, 5)).days + 1
    first = days[0]
    assert tuple(first) == (20230105, date(2023, 1, 5), 5, 1, "January", 1, 2023, "Thursday", False)
    assert [d.is_weekend for d in days[:4]] == [False, False, True, True]


def test_fact_is_sorted_and_typed(warehouse):
    fact = warehouse.fact_sales
    assert fact.columns == FACT_COLUMNS
    assert [f.dataType for f in fact.schema] == [f.dataType for f in TABLES["fact_sales"]]
    got = [
        (r.sales_key, r.transaction_id, r.line_number) for r in fact.orderBy("sales_key").collect()
    ]
    assert got == [
        (i, row["transaction_id"], int(row["line_number"]))
        for i, row in enumerate(good_lines(), 1)
    ]
    first = fact.where("sales_key = 1").first()
    assert (first.revenue, first.total_cost, first.profit) == (
        Decimal("180.00"), Decimal("120.00"), Decimal("60.00"))
    assert first.discount == Decimal("0.1000")


def test_row_order_and_partitioning_do_not_matter(spark, warehouse):
    shuffled = frame(spark, good_lines()[::-1]).repartition(5)
    again = build_warehouse(shuffled)
    for name, table in warehouse.tables().items():
        assert rows(table) == rows(again.tables()[name]), name


def test_stored_money_rounds_half_even(spark):
    lines = good_lines()
    lines[0]["unit_price"], lines[1]["unit_price"] = "2.345", "2.355"
    fact = build_warehouse(frame(spark, lines)).fact_sales.orderBy("sales_key").collect()
    assert [r.unit_price for r in fact[:2]] == [Decimal("2.34"), Decimal("2.36")]


def test_line_measures_match_the_raw_amounts(spark):
    lines = typed_lines(raw_frame(spark))
    again = line_measures(lines.drop("revenue", "total_cost", "profit"))
    columns = ["transaction_id", "line_number", "revenue", "total_cost", "profit"]
    assert rows(again.select(columns)) == rows(lines.select(columns))


def test_enrich_keeps_the_grain(warehouse):
    enriched = enrich_sales(warehouse)
    assert enriched.count() == warehouse.fact_sales.count()
    assert {"year", "region", "category_name", "channel_name"} <= set(enriched.columns)
    assert enriched.agg(F.sum("revenue")).first()[0] == Decimal("737.13")


def test_repeated_dimension_keys_are_an_error(warehouse):
    from dataclasses import replace

    import pytest

    from orderloom.schema import WarehouseError

    twice = replace(warehouse, dim_channel=warehouse.dim_channel.union(warehouse.dim_channel))
    with pytest.raises(WarehouseError, match="dim_channel"):
        enrich_sales(twice)


def test_amounts_that_differ_from_their_formulas_are_stored_as_they_are(spark):
    lines = good_lines()
    lines[0] |= {"revenue": "1.23", "total_cost": "999999999999.99", "profit": "-7.00"}
    lines[1] |= {"unit_price": None}
    lines[2] |= {"revenue": None, "profit": "5.00"}
    lines[3] |= {"unit_cost": "9999999999.99", "quantity": "2000000000"}
    stored = {r.transaction_id + str(r.line_number): r for r in build_warehouse(frame(spark, lines)).fact_sales.collect()}
    assert len(stored) == len(lines)
    for line in lines:
        row = stored[line["transaction_id"] + str(int(line["line_number"]))]
        for name in ("unit_price", "revenue", "total_cost", "profit"):
            assert row[name] == (None if line[name] is None else Decimal(line[name])), (name, line)


def test_the_numbered_lines_are_narrow(warehouse):
    """Names are keys and amounts are differences before the lines are sorted and staged."""
    plan = warehouse.fact_sales._jdf.queryExecution().optimizedPlan().toString()
    assert "sales_key" in plan and "Join LeftOuter" not in plan
    assert not {"customer_id", "product_id", "sales_channel"} & set(re.findall(r"(\w+)#", plan))
