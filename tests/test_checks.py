from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from orderloom.operators.constraints import constraint_report, row_constraints
from orderloom.operators.integrity import fact_row_count, integrity_report, orphan_lines
from orderloom.schema import Limits


def violations(report):
    name, count = report.columns[-2:]
    return {r[name]: r[count] for r in report.collect() if r[count]}


def test_clean_warehouse_has_thirteen_zero_checks(warehouse):
    report = integrity_report(warehouse).collect()
    assert len(report) == 13
    assert {r.violation_count for r in report} == {0}
    assert violations(constraint_report(warehouse)) == {}
    assert fact_row_count(warehouse).first()[0] == 6


def test_orphans(warehouse):
    broken = replace(
        warehouse,
        dim_date=warehouse.dim_date.where("date_key <> 20230105"),
        dim_customer=warehouse.dim_customer.where("customer_key <> 2"),
        dim_product=warehouse.dim_product.where("product_key <> 3"),
        dim_channel=warehouse.dim_channel.where("channel_key <> 1"),
        dim_category=warehouse.dim_category.where("category_key <> 1"),
    )
    assert violations(integrity_report(broken)) == {
        "orphan_date_keys": 2,
        "orphan_customer_keys": 1,
        "orphan_product_keys": 2,
        "orphan_channel_keys": 5,
        "orphan_category_keys": 2,
    }
    rows = {(r.check_name, r.key_value): r.line_count for r in orphan_lines(broken).collect()}
    assert rows["orphan_product_keys", 3] == 2


def test_null_key_is_an_orphan_and_a_null(warehouse):
    fact = warehouse.fact_sales.withColumn(
        "customer_key", F.when(F.col("sales_key") > 1, F.col("customer_key"))
    )
    assert violations(integrity_report(replace(warehouse, fact_sales=fact))) == {
        "orphan_customer_keys": 1,
        "unexpected_fact_nulls": 1,
    }


def test_duplicates_count_groups(warehouse):
    thrice = warehouse.fact_sales.union(warehouse.fact_sales.where("sales_key = 1"))
    thrice = thrice.union(warehouse.fact_sales.where("sales_key <= 2"))
    broken = replace(
        warehouse,
        fact_sales=thrice,
        dim_customer=warehouse.dim_customer.union(warehouse.dim_customer),
    )
    assert violations(integrity_report(broken)) == {
        "duplicate_customer_ids": 2,
        "duplicate_sales_lines": 2,
    }


FACT_FAULTS = {
    "quantity": ("0", {"quantity_positive", "revenue_calculation", "cost_calculation"}),
    "unit_price": ("CAST(0 AS DECIMAL(12,2))", {"unit_price_positive", "revenue_calculation"}),
    "unit_cost": (
        "CAST(-1 AS DECIMAL(12,2))", {"unit_cost_nonnegative", "cost_calculation"}),
    "discount": ("CAST(1.5 AS DECIMAL(5,4))", {"discount_range", "revenue_calculation"}),
    "revenue": (
        "CAST(-5 AS DECIMAL(14,2))",
        {"revenue_nonnegative", "revenue_calculation", "profit_calculation"},
    ),
    "total_cost": (
        "CAST(-5 AS DECIMAL(14,2))",
        {"total_cost_nonnegative", "cost_calculation", "profit_calculation"},
    ),
    "profit": ("CAST(10000000000000 AS DECIMAL(20,2))", {"profit_precision", "profit_calculation"}),
    "transaction_id": ("'ORDER1'", {"transaction_id_format"}),
    "line_number": ("-1", {"line_number_positive"}),
    "sales_key": ("0", {"sales_key_positive"}),
}


@pytest.mark.parametrize("column", FACT_FAULTS)
def test_fact_constraints(warehouse, column):
    value, expected = FACT_FAULTS[column]
    fact = warehouse.fact_sales.where("sales_key = 3").withColumn(column, F.expr(value))
    found = violations(row_constraints("fact_sales", fact, Limits()))
    assert set(found) == expected


def test_dimension_constraints(warehouse):
    broken = replace(
        warehouse,
        dim_date=warehouse.dim_date.withColumns(
            {"day": F.lit(32), "month": F.lit(13), "quarter": F.lit(5), "year": F.lit(1999),
             "full_date": F.date_add("full_date", 1), "month_name": F.lit("Septembrist")}
        ),
        dim_customer=warehouse.dim_customer.withColumns(
            {"customer_id": F.concat(F.lit("C"), F.col("customer_key")), "region": F.lit(None)}
        ),
        dim_product=warehouse.dim_product.withColumn("product_id", F.lit("PROD001")),
        dim_category=warehouse.dim_category.withColumn("category_name", F.repeat(F.lit("x"), 101)),
    )
    days = warehouse.dim_date.count()
    assert violations(constraint_report(broken)) == {
        "day_range": days,
        "month_range": days,
        "quarter_range": days,
        "year_range": days,
        "date_key_matches_date": days,
        "month_name_length": days,
        "customer_id_format": 2,
        "region_not_null": 2,
        "product_id_unique": 1,
        "category_name_length": 2,
        "category_name_unique": 1,
    }


def test_unresolved_reference(warehouse):
    fact = warehouse.fact_sales.withColumn("channel_key", F.lit(99))
    assert violations(constraint_report(replace(warehouse, fact_sales=fact))) == {
        "channel_key_reference": 6
    }


def test_bounds_are_parameters(warehouse):
    limits = Limits(min_year=2024, product_id="^X")
    assert set(violations(row_constraints("dim_date", warehouse.dim_date, limits))) == {"year_range"}
    assert violations(row_constraints("dim_product", warehouse.dim_product, limits)) == {
        "product_id_format": 3
    }


def test_repeated_keys_against_counting(spark):
    """Whole numbers of any sign and bucket, dates, texts, and orders with many, repeated and null lines."""
    import datetime
    import random
    from collections import Counter

    from orderloom.operators.keys import repeated_key_counts

    rnd = random.Random(4)
    numbers = [rnd.choice([-1, 1]) * rnd.randrange(90_000) for _ in range(3000)] + [None, None, 0, 0, 32_768, 32_768]
    days = [datetime.date(1960, 1, 1) + datetime.timedelta(rnd.randrange(40_000)) for _ in range(900)] + [None]
    names = [rnd.choice(["", "a", "A", None, *map(str, range(300))]) for _ in range(400)]
    lines = [(f"T{k}", n) for k in range(40) for n in range(k * 3)]
    lines += [("T9", 4), ("T9", 4), ("T30", 70), ("T31", 5), (None, 1), (None, 1), ("T3", None), ("T3", None), ("T4", -2), ("T4", -2)]
    tables = {
        "numbers": spark.createDataFrame([(n,) for n in numbers], "n long"),
        "days": spark.createDataFrame([(d,) for d in days], "d date"),
        "names": spark.createDataFrame([(n,) for n in names], "s string"),
        "lines": spark.createDataFrame(lines, "t string, l int").repartition(5),
    }
    rules = {"n": ("numbers", ["n"]), "d": ("days", ["d"]), "s": ("names", ["s"]), "l": ("lines", ["t", "l"])}
    rows = {"n": [(n,) for n in numbers], "d": [(d,) for d in days], "s": [(n,) for n in names], "l": lines}
    for ignore in (True, False):
        found = {r.rule: r.violations for r in repeated_key_counts(tables, rules, ignore_null=ignore).collect()}
        wanted = {
            rule: sum(n > 1 for n in Counter(k for k in keys if not (ignore and None in k)).values())
            for rule, keys in rows.items()
        }
        assert found == wanted


def test_keys_of_the_fact_are_not_shuffled_one_by_one(sample):
    """A clean fact sends a bit per key and a row per order; keys travel in their own types."""
    from orderloom.operators.constraints import key_constraints

    plan = key_constraints(sample.warehouse)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan and "bit_or" in plan


FAMILIES = {
    "day_range", "month_range", "quarter_range", "year_range", "date_key_matches_date", "month_name_length",
    "day_of_week_length", "full_date_unique", "customer_key_positive", "customer_id_format", "customer_id_length",
    "region_length", "customer_key_unique", "customer_id_unique", "category_key_positive", "category_name_length",
    "product_key_positive", "product_id_format", "product_id_length", "product_name_length", "product_name_not_null",
    "channel_key_positive", "channel_name_length", "sales_key_positive", "transaction_id_format",
    "transaction_id_length", "line_number_positive", "line_number_range", "quantity_positive", "unit_price_positive",
    "discount_range", "revenue_nonnegative", "unit_cost_nonnegative", "total_cost_nonnegative", "revenue_calculation",
    "cost_calculation", "profit_calculation", "unit_price_precision", "discount_precision", "revenue_precision",
    "unit_cost_precision", "total_cost_precision", "profit_precision", "sales_key_unique",
    "transaction_id_line_number_unique", "date_key_reference", "customer_key_reference", "product_key_reference",
    "channel_key_reference", "category_key_reference", "channel_key_not_null",
}


def test_every_family_fires_on_the_broken_warehouse(sample):
    from orderloom.sources import testdata

    assert FAMILIES <= set(violations(constraint_report(sample.dirty, testdata.LIMITS)))


def test_unfit_rows_have_reasons_and_nothing_is_cast(warehouse):
    from orderloom.operators.constraints import unfit_rows

    fact = warehouse.fact_sales.select(
        "*", F.expr("CASE sales_key WHEN 2 THEN 40000 ELSE line_number END AS far"),
        F.expr("CASE sales_key WHEN 2 THEN 1e12BD WHEN 4 THEN -1e12BD ELSE CAST(revenue AS DECIMAL(20, 2)) END AS large"),
    ).drop("line_number", "revenue").withColumnsRenamed({"far": "line_number", "large": "revenue"})
    found = {r.row: r for r in unfit_rows("fact_sales", fact).collect()}
    assert len(found) == 2 and {r.table_name for r in found.values()} == {"fact_sales"}
    reasons = sorted(tuple(r.reasons) for r in found.values())
    assert reasons == [
        ("line_number = 40000 does not fit smallint", "revenue = 1000000000000.00 does not fit decimal(14,2)"),
        ("revenue = -1000000000000.00 does not fit decimal(14,2)",),
    ]
    assert unfit_rows("dim_date", warehouse.dim_date).count() == 0
