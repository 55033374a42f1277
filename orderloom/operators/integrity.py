"""The thirteen zero-violation checks of a warehouse."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import money
from orderloom.operators import keys
from orderloom.operators.model import Warehouse
from orderloom.schema import FACT_COLUMNS, FOREIGN_KEYS, NATURAL_KEYS

# Report names of the checks on keys.
DUPLICATE_CHECKS = {
    "duplicate_customer_ids": "dim_customer",
    "duplicate_product_ids": "dim_product",
    "duplicate_category_names": "dim_category",
    "duplicate_channel_names": "dim_channel",
    "duplicate_sales_lines": "fact_sales",
}

ORPHAN_CHECKS = {f"orphan_{key}s": (table, key, owner) for table, key, owner in FOREIGN_KEYS}

# Dimension columns covered by the null check.
DIMENSION_NULL_COLUMNS = {
    "dim_date": ["full_date", "month", "year"],
    "dim_customer": ["customer_id", "region"],
    "dim_category": ["category_name"],
    "dim_product": ["product_id", "product_name", "category_key"],
    "dim_channel": ["channel_name"],
}


def _null_in(columns: list[str]) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in columns])


def _named(counts: DataFrame) -> DataFrame:
    return counts.withColumnsRenamed({"rule": "check_name", "violations": "violation_count"})


def check_orphans(warehouse: Warehouse) -> DataFrame:
    """Rows whose key is null or unknown, per reference."""
    return _named(keys.unresolved_row_counts(warehouse.tables(), ORPHAN_CHECKS))


def check_duplicates(warehouse: Warehouse) -> DataFrame:
    """Number of repeated natural keys, not of surplus rows."""
    rules = {name: (table, NATURAL_KEYS[table]) for name, table in DUPLICATE_CHECKS.items()}
    return _named(keys.repeated_key_counts(warehouse.tables(), rules))


def line_mismatch() -> Column:
    """Stored amounts that differ from their formulas; null when a part is null."""
    quantity = F.col("quantity")
    revenue = money.line_revenue(F.col("unit_price"), quantity, F.col("discount"))
    return (
        (F.col("revenue") != revenue)
        | (F.col("total_cost") != money.line_cost(F.col("unit_cost"), quantity))
        | (F.col("profit") != F.col("revenue") - F.col("total_cost"))
    )


def check_fact_rows(warehouse: Warehouse) -> DataFrame:
    """Financial and null checks of the fact, both from one scan."""
    columns = [name for name in FACT_COLUMNS if name != "sales_key"]
    rules = {
        "financial_reconciliation_failures": line_mismatch(),
        "unexpected_fact_nulls": _null_in(columns),
    }
    counts = warehouse.fact_sales.agg(
        *[F.count_if(rule).alias(name) for name, rule in rules.items()]
    )
    return counts.unpivot([], list(rules), "check_name", "violation_count")


def check_dimension_nulls(warehouse: Warehouse) -> DataFrame:
    parts = [
        warehouse.tables()[name].agg(F.count_if(_null_in(columns)).alias("n"))
        for name, columns in DIMENSION_NULL_COLUMNS.items()
    ]
    return reduce(DataFrame.unionByName, parts).agg(
        F.lit("unexpected_dimension_nulls").alias("check_name"),
        F.sum("n").alias("violation_count"),
    )


def integrity_report(warehouse: Warehouse) -> DataFrame:
    """(check_name, violation_count) of all checks; each reads only the columns it needs."""
    checks = [
        check_orphans(warehouse),
        check_duplicates(warehouse),
        check_fact_rows(warehouse),
        check_dimension_nulls(warehouse),
    ]
    return reduce(DataFrame.unionByName, checks)


def orphan_lines(warehouse: Warehouse) -> DataFrame:
    """What the orphan checks count: reference, key value and the rows that use it."""
    return keys.unresolved_keys(warehouse.tables(), ORPHAN_CHECKS).select(
        F.col("rule").alias("check_name"),
        F.col("key").cast("bigint").alias("key_value"),
        F.col("rows").alias("line_count"),
    )


def fact_row_count(warehouse: Warehouse) -> DataFrame:
    return warehouse.fact_sales.agg(F.count(F.lit(1)).alias("fact_row_count"))
